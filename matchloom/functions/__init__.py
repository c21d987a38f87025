"""Column expressions; all built-in Spark functions, no UDFs."""
