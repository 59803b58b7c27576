"""Item-to-item lists: bought, viewed, bought afterwards, similar."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from vitrine.functions import filters
from vitrine.functions.times import lookback_window
from vitrine.operators import collab, pairs, ranking, similarity
from vitrine.plans.rankings import scope_of
from vitrine.plans.strategy import AccountSettings, Strategy, Tables
from vitrine.sources import catalogs, facts
from vitrine.storage import materialise

# Fixed value: purchases a pair needs when an account asks for a threshold.
MINIMUM_PURCHASES = 3
MINIMUM_VIEWS = 2


def effective_source(source: str, has_point_of_sale: bool) -> str:
    """Without point-of-sale data sets an item-to-item strategy runs on online data."""
    return source if has_point_of_sale else "online"


def purchases(
    strategy: Strategy, tables: Tables, as_of: datetime, settings: AccountSettings = AccountSettings(), until: datetime | None = None
) -> tuple[DataFrame | None, DataFrame | None]:
    """Purchases on devices and at points of sale, written; None for a source that the strategy has not."""
    accounts = scope_of(strategy, tables)
    begin, _ = lookback_window(as_of, strategy.lookback_days)
    datasets = facts.account_datasets(tables.settings, accounts) if tables.settings is not None else None
    source = effective_source(strategy.source, settings.has_point_of_sale and datasets is not None)
    online = bought = None
    if source != "offline":
        lines = facts.with_valid_product(facts.facts_since(tables.purchase_lines, accounts, begin, until))
        online = materialise(pairs.last_purchases(lines), "last-purchases")
    if source != "online":
        bought = materialise(facts.point_of_sale(tables.pos_lines, datasets, tables.expiration, begin, until), "pos-purchases")
    return online, bought


def product_pairs(
    strategy: Strategy,
    tables: Tables,
    as_of: datetime,
    settings: AccountSettings = AccountSettings(),
    until: datetime | None = None,
    sequence_merge: str = "source_count",
    monthly_view_cap: float = 1000,
) -> DataFrame:
    """Scored product pairs (account_id, pid1, pid2, score) of a purchase or view algorithm.

    Baskets and scored pairs are written to the shared folder: facts are read once, and the range of scores and the
    lists start from the same pairs. Of symmetric pairs one half is counted and written, and mirrored when read.
    """
    accounts = scope_of(strategy, tables)
    begin, _ = lookback_window(as_of, strategy.lookback_days)

    if strategy.algorithm == "view_also_view":
        views = facts.with_valid_product(facts.facts_since(tables.product_views, accounts, begin, until))
        first = materialise(pairs.earliest_views(views), "first-views")
        usual = pairs.without_outliers(first, strategy.lookback_days, monthly_view_cap)
        return pairs.mirrored(pairs.unordered(usual, pairs.DEVICE, MINIMUM_VIEWS))

    minimum = settings.minimum_purchases
    online, bought = purchases(strategy, tables, as_of, settings, until)
    merges = minimum > 1 and online is not None and bought is not None  # two tables of pairs meet
    kept = (lambda df: materialise(df, "pairs")) if merges else (lambda df: df)
    if strategy.algorithm != "subsequently_purchased":
        if online is not None and bought is not None:
            return pairs.mirrored(kept(pairs.unordered_of_both(online, bought, minimum)))
        return pairs.mirrored(pairs.unordered(bought, pairs.CUSTOMER, minimum) if online is None else pairs.unordered(online, pairs.DEVICE, minimum))
    if online is not None and bought is not None:
        return kept(pairs.in_sequence_of_both(online, bought, sequence_merge, minimum))
    return pairs.in_sequence(bought, pairs.CUSTOMER, minimum) if online is None else pairs.in_sequence(online, pairs.DEVICE, minimum)


def ranked_products(scored_pairs: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    """Pairs as lookup_key, product_id, score, normalized_score."""
    return ranking.normalised(pairs.as_lookup(scored_pairs), ranking.score_ends(scored_pairs, per), per)


def _split(strategy: Strategy, settings: AccountSettings, tables: Tables):
    own = filters.with_algorithm_filter(strategy.filter_json, strategy.algorithm)
    return (
        filters.split_for_pairs(own, tables.catalog_fields),
        filters.split_for_pairs(settings.filter_json, tables.catalog_fields),
    )


def sku_lists(
    strategy: Strategy,
    tables: Tables,
    scored_pairs: DataFrame,
    settings: AccountSettings = AccountSettings(),
    per: tuple[str, ...] = (),
) -> DataFrame:
    """Scored pairs to ranked SKU lists under the filters of one strategy."""
    own, shared = _split(strategy, settings, tables)
    stock = catalogs.dataset(tables.catalog, strategy.retailer_id, strategy.catalog_id)
    fresh = catalogs.latest(stock, tables.expiration)
    lists = collab.explode_pairs(pairs.as_lookup(scored_pairs), fresh, own, shared, tables.catalog_fields, per)
    return ranking.normalised(lists, ranking.score_ends(scored_pairs, per), per)


def similar_products(
    strategy: Strategy, tables: Tables, settings: AccountSettings, in_stock: str = "In Stock"
) -> DataFrame:
    """SKU lists by weighted attribute agreement."""
    if settings.similarity_weights is None:
        raise ValueError(f"strategy {strategy.id} needs similarity weights")
    own, shared = _split(strategy, settings, tables)
    stock = catalogs.dataset(tables.catalog, strategy.retailer_id, strategy.catalog_id)
    return similarity.similar_skus(
        catalogs.in_stock(stock, in_stock),
        catalogs.latest(stock, tables.expiration),
        settings.similarity_weights,
        own,
        shared,
        tables.catalog_fields,
    )


def _lists_of_purchases(
    strategy: Strategy, tables: Tables, as_of: datetime, settings: AccountSettings, until: datetime | None
) -> DataFrame:
    """`sku_lists` of the `product_pairs` of a purchase algorithm, straight from the baskets."""
    own, shared = _split(strategy, settings, tables)
    fresh = catalogs.latest(catalogs.dataset(tables.catalog, strategy.retailer_id, strategy.catalog_id), tables.expiration)
    found = zip(purchases(strategy, tables, as_of, settings, until), (pairs.DEVICE, pairs.CUSTOMER))
    sources = [(rows, key) for rows, key in found if rows is not None]
    timed = strategy.algorithm == "subsequently_purchased"
    by = "source_count" if timed and len(sources) > 1 else "sum"
    lists, ends = collab.lists_of_baskets(sources, timed, fresh, own, shared, tables.catalog_fields, settings.minimum_purchases, by)
    return ranking.normalised(lists, ends)


def recommend(
    strategy: Strategy,
    tables: Tables,
    as_of: datetime,
    settings: AccountSettings = AccountSettings(),
    until: datetime | None = None,
) -> DataFrame:
    """Ranked SKU lists of an item-to-item strategy."""
    if strategy.algorithm == "similar_products_v2":
        return similar_products(strategy, tables, settings)
    own, shared = _split(strategy, settings, tables)
    if strategy.algorithm != "view_also_view" and not (own.bucketed or shared.bucketed):
        return _lists_of_purchases(strategy, tables, as_of, settings, until)
    scored = product_pairs(strategy, tables, as_of, settings, until)
    return sku_lists(strategy, tables, scored, settings)
