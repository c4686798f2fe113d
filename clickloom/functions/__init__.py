"""Column expressions. Everything here stays a native Spark expression."""
