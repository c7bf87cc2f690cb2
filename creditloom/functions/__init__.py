"""Column builders: every one returns a built-in Spark expression."""
