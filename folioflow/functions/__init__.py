"""Column functions: everything here is a Spark expression, no Python per row."""
