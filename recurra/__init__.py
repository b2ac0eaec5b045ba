"""Subscription-revenue analytics as composable PySpark DataFrame operators."""
