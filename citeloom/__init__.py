"""Catalogue of national research datasets out of bulk DOI metadata, on Spark."""

__version__ = "0.1.0"
