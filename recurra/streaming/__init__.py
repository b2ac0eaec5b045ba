"""Structured Streaming jobs over the billing topic."""
