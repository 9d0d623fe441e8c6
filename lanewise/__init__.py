"""Delivery, cost and supplier analytics as composable Spark DataFrame operators."""
