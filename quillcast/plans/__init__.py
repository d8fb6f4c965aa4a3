"""Whole plans: scoring to published manifest, and the registered queries."""
