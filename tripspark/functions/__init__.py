"""Column expressions. All of them are built-in Spark expressions; none is a UDF."""
