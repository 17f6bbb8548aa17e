"""Retail and bank analytics as PySpark DataFrame operators."""
