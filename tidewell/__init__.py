"""Composable DataFrame operators for everyday analytics on Spark."""
