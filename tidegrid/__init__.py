"""Spatial layer analytics on PySpark: points, areas, and the tables between them."""
