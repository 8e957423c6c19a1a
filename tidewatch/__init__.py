"""Vulnerability-feed analytics as plain PySpark DataFrame operators."""
