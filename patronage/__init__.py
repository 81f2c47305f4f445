"""Customer and campaign analytics as plain Spark DataFrame functions."""
