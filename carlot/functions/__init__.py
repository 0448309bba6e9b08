"""Column functions (Column -> Column), all built-in Spark SQL expressions."""
