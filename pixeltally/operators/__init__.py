"""DataFrame in, DataFrame out: operators to chain with ``DataFrame.transform``."""
