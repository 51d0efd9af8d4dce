"""Sales analytics as composable Spark DataFrame operators and pipelines."""
