"""Customer-retention analytics as composable Spark DataFrame operators."""
