"""Pluvio: climate analytics as plain PySpark DataFrame transformations."""
