"""Record integration and identity resolution as Spark DataFrame operators."""
