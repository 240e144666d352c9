"""Commerce analytics as composable Spark DataFrame operators."""
