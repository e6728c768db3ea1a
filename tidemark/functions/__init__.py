"""Column functions. Every one returns a built-in Spark expression."""
