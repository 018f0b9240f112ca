"""Trip-analytics lakehouse on PySpark: bronze files, a silver star schema and gold queries."""
