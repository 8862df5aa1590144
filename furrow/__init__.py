"""furrow: environmental sensor analytics as composable Spark DataFrame operators."""
