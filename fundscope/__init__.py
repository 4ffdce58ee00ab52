"""Funding-landscape analytics as composable Spark DataFrame operators."""
