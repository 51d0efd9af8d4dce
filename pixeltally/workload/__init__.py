"""The registered queries: the library's operators over the driver's tables, with their SQL oracles."""
