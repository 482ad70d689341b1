"""Catalogue and corpus analytics on PySpark."""
