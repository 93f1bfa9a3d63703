"""Column-level helpers built only from Spark SQL functions."""
