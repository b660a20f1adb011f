"""Cohort-shaped tables derived from the given tables, and the registered queries."""
