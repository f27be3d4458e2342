"""Column functions: all are built-in expressions except deep_diff, an Arrow UDF."""
