"""Whole jobs: building the marts and the registered queries."""
