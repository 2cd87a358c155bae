"""Column functions: plain expressions on built-in Spark functions."""
