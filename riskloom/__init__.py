"""Clinical risk analytics as Spark DataFrame operators and MLlib pipelines."""
