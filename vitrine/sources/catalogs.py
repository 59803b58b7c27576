"""Scans of the product catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def dataset(catalog: DataFrame, retailer_id: int, dataset_id: int) -> DataFrame:
    return catalog.where((F.col("retailer_id") == retailer_id) & (F.col("dataset_id") == dataset_id))


def latest(catalog: DataFrame, expiration: DataFrame) -> DataFrame:
    """Catalog rows refreshed since their dataset's cutoff."""
    cutoffs = expiration.select("dataset_id", "cutoff_time")
    fresh = catalog.join(cutoffs, "dataset_id").where(F.col("update_time") >= F.col("cutoff_time"))
    return fresh.select(*catalog.columns)


def in_stock(catalog: DataFrame, availability: str = "In Stock") -> DataFrame:
    return catalog.where(F.lower("availability") == availability.lower())
