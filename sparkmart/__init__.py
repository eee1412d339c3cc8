"""sparkmart: build, maintain and query a sales star schema with PySpark."""
