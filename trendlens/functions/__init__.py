"""Column -> Column scalar functions (native Spark expressions only)."""
