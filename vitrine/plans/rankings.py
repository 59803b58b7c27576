"""Global rankings: most viewed, most purchased, highest revenue, trending."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from vitrine.functions import filters
from vitrine.functions.sharding import geo_columns
from vitrine.functions.times import lookback_window, session_window
from vitrine.operators import metrics, ranking, representatives, scopes
from vitrine.plans.strategy import AccountSettings, Strategy, Tables
from vitrine.sources import catalogs, facts

TREND_DAYS = 30


def scope_of(strategy: Strategy, tables: Tables) -> DataFrame:
    return scopes.fact_accounts(
        tables.accounts,
        tables.market_accounts,
        strategy.account_id,
        strategy.market_id,
        strategy.retailer_id,
        strategy.whole_retailer,
    )


def _pos(strategy: Strategy, tables: Tables, accounts: DataFrame, begin: datetime) -> DataFrame:
    if tables.settings is None or tables.pos_lines is None:
        raise ValueError(f"strategy {strategy.id} needs point-of-sale data sets")
    pairs = facts.account_datasets(tables.settings, accounts)
    return facts.point_of_sale(tables.pos_lines, pairs, tables.expiration, begin)


def metric(strategy: Strategy, tables: Tables, as_of: datetime, pos_history: str = "lookback") -> DataFrame:
    """The metric table of a strategy for its purchase source.

    `pos_history` is how far the point-of-sale side of a trend reaches back:
    "lookback" (the strategy's own window) or "30d".
    """
    accounts = scope_of(strategy, tables)
    window = lookback_window(as_of, strategy.lookback_days)
    starts = session_window(window)
    long = lookback_window(as_of, TREND_DAYS)

    if strategy.algorithm in ("view", "most_popular"):
        return metrics.views(tables.product_views, tables.sessions, accounts, window, starts)

    online = pos = None
    if strategy.source != "offline":
        lines, sessions = tables.purchase_lines, tables.sessions
        if strategy.algorithm == "purchase":
            online = metrics.units_online(lines, sessions, accounts, window, starts)
        elif strategy.algorithm == "purchase_value":
            online = metrics.revenue_online(lines, sessions, accounts, tables.exchange_rates, window, starts)
        else:
            online = metrics.trend_online(lines, sessions, accounts, window, starts, long, session_window(long))
    if strategy.source != "online":
        begin = window[0]
        if strategy.algorithm == "trending" and pos_history == "30d":
            begin = min(begin, long[0])
        bought = _pos(strategy, tables, accounts, begin)
        if strategy.algorithm == "purchase":
            pos = metrics.units_pos(bought, window)
        elif strategy.algorithm == "purchase_value":
            pos = metrics.revenue_pos(bought, accounts, tables.exchange_rates, window)
        else:
            pos = metrics.trend_pos(bought, starts, session_window(long))
    if online is None:
        return pos
    return online if pos is None else metrics.merged(online, pos)


def rank(
    strategy: Strategy,
    tables: Tables,
    settings: AccountSettings,
    metric_table: DataFrame,
    per_account: bool = False,
) -> DataFrame:
    """Metric table to ranked SKUs: id, rank, score [, geo columns] [, product-type bucket].

    `per_account` ranks every account of the metric separately in the same job.
    """
    fields = tables.catalog_fields
    own = filters.split_for_ranking(strategy.filter_json, fields)
    shared = filters.split_for_ranking(settings.filter_json, fields)
    geo = geo_columns(strategy.geo_target)
    per = ("account_id",) if per_account else ()

    stock = catalogs.dataset(tables.catalog, strategy.retailer_id, strategy.catalog_id)
    fresh = catalogs.latest(stock, tables.expiration)
    for tree in (own.early, shared.early):
        if tree["filters"]:
            fresh = fresh.where(filters.compile_tree(tree, lambda f: filters.field_column(fresh, f, fields)))
    skus = representatives.representatives(fresh, [own.late, shared.late])

    scores = ranking.scaled(metrics.rolled_up(metric_table, geo, per), per)
    return _ranked_skus(scores, skus, stock, [*per, *geo], own.bucketed or shared.bucketed)


def _ranked_skus(scores: DataFrame, skus: DataFrame, stock: DataFrame, partition: list[str], bucketed: bool) -> DataFrame:
    """SKUs meet their product types (or buckets) before the scores of their product, which are a row per place."""
    if not bucketed:
        rows = ranking.to_skus(scores, ranking.with_product_type(skus, stock))
        return ranking.ranked(rows, partition).select(*partition, "id", "rank", "score")
    rows = ranking.to_skus(scores, ranking.with_buckets(skus, stock)).withColumn(ranking.BUCKET, F.explode(ranking.BUCKET))
    return ranking.ranked(rows, [ranking.BUCKET, *partition]).select(*partition, ranking.BUCKET, "id", "rank", "score")


def rank_for_many(
    metric_table: DataFrame,
    tables: Tables,
    retailer_id: int,
    catalog_id: int,
    geo: tuple[str, ...],
    renderings: list[tuple[filters.RankingFilters, filters.RankingFilters]],
    bucketed: bool,
) -> DataFrame:
    """`rank` for many filters (strategy's and account's) over one metric and catalog, all in one plan.

    The number of the rendering is a column and in all keys. All must be with buckets, or all without.
    """
    fields = tables.catalog_fields
    stock = catalogs.dataset(tables.catalog, retailer_id, catalog_id)
    fresh = catalogs.latest(stock, tables.expiration)
    early = [[part.early for part in both if part.early["filters"]] for both in renderings]
    late = [[part.late for part in both] for both in renderings]
    variants = representatives.variants_for_many(fresh, early, late, lambda f: filters.field_column(fresh, f, fields))
    skus = representatives.capped(variants, ("rendering",))
    scores = ranking.scaled(metrics.rolled_up(metric_table, geo))
    return _ranked_skus(scores, skus, stock, ["rendering", *geo], bucketed)


def recommend(
    strategy: Strategy,
    tables: Tables,
    as_of: datetime,
    settings: AccountSettings = AccountSettings(),
    pos_history: str = "lookback",
) -> DataFrame:
    """Ranked SKUs of a global strategy."""
    return rank(strategy, tables, settings, metric(strategy, tables, as_of, pos_history))
