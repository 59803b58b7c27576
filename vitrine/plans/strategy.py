"""Inputs of a run: strategies, account settings and the tables they read."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Algorithm names by family.
RANKINGS = ("view", "most_popular", "purchase", "purchase_value", "trending")
PAIRINGS = (
    "purchase_also_purchase",
    "bought_together",
    "subsequently_purchased",
    "view_also_view",
    "similar_products_v2",
)
SOURCES = ("online", "offline", "online_offline")


@dataclass(frozen=True)
class Strategy:
    id: int
    algorithm: str
    retailer_id: int
    catalog_id: int | None  # None: the default catalog of the output account
    lookback_days: int = 30
    filter_json: str = '{"type": "and", "filters": []}'
    geo_target: str = "none"
    source: str = "online"
    account_id: int | None = None
    market_id: int | None = None
    whole_retailer: bool = False

    def __post_init__(self) -> None:
        if self.algorithm not in RANKINGS + PAIRINGS:
            raise ValueError(f"unknown algorithm {self.algorithm!r}")
        if self.source not in SOURCES:
            raise ValueError(f"unknown purchase source {self.source!r}")


@dataclass(frozen=True)
class AccountSettings:
    """Per-account options that apply to all its strategies."""

    filter_json: str = '{"type": "or", "filters": []}'
    similarity_weights: tuple[tuple[str, float | None], ...] | None = None
    minimum_purchases: int = 1
    has_point_of_sale: bool = True


@dataclass(frozen=True)
class Tables:
    """The logical tables of a deployment (see vitrine.schemas)."""

    catalog: DataFrame
    expiration: DataFrame
    accounts: DataFrame
    product_views: DataFrame | None = None
    purchase_lines: DataFrame | None = None
    sessions: DataFrame | None = None
    pos_lines: DataFrame | None = None
    exchange_rates: DataFrame | None = None
    settings: DataFrame | None = None
    market_accounts: DataFrame | None = None
    catalog_fields: dict[str, str] = field(default_factory=dict)
