"""Column builders. Nothing here is a UDF."""
