"""Vitrine: product-recommendation precompute as Spark DataFrame plans."""

__version__ = "0.1.0"
