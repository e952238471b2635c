"""Campaign and transaction analytics as Spark DataFrame operators."""
