"""Column functions. All of them stay inside Spark SQL expressions."""
