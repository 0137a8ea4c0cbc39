"""Road-incident analytics as lazy Spark DataFrame operators."""
