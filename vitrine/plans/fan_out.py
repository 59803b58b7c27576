"""Many strategies in one run: shared intermediates are computed once, all documents form one result."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame

from vitrine.functions import filters
from vitrine.functions.sharding import geo_columns
from vitrine.operators import collab, documents, pairs, ranking, representatives, scopes, similarity
from vitrine.plans import pairings, rankings
from vitrine.plans.strategy import RANKINGS, AccountSettings, Strategy, Tables
from vitrine.sources import catalogs
from vitrine.storage import materialise

# Algorithms that start from the same pairs (and differ by a filter) or from the same metric.
_SAME_START = {"bought_together": "purchase_also_purchase", "most_popular": "view"}

# Features of accounts that get documents, and of those that get the unified feed, too.
DOCUMENTS, UNIFIED = "recommendations", "unified_feed"


@dataclass(frozen=True)
class Output:
    """One strategy rendered for one account, in the older feed and optionally the unified one."""

    strategy: Strategy
    account_id: int
    settings: AccountSettings = AccountSettings()
    unified: bool = False


def shared_key(output: Output) -> tuple:
    """Outputs with equal keys start from the same metric or pair table."""
    s = output.strategy
    minimum = 1 if s.algorithm in RANKINGS else output.settings.minimum_purchases
    return (
        _SAME_START.get(s.algorithm, s.algorithm),
        s.lookback_days,
        s.source,
        s.account_id,
        s.market_id,
        s.retailer_id if s.whole_retailer else None,
        minimum,
        output.settings.has_point_of_sale,
    )


def select(
    strategies: Iterable[Strategy],
    accounts: DataFrame,
    features: DataFrame,
    active: DataFrame | None = None,
    settings: Mapping[int, AccountSettings] = {},
    default_catalogs: Mapping[int, int] = {},
) -> list[Output]:
    """Outputs of a run: each active strategy for each account it writes for.

    `active` holds the ids in use (see scopes.active_strategies); without it all count. A strategy that names no catalog
    uses the account's default one, and has no output for an account without. Only configuration is collected: the
    strategies' own ids, and accounts with their features.
    """
    strategies = list(strategies)
    if active is not None:
        used = {r.id for r in active.where(active["id"].isin([s.id for s in strategies])).select("id").distinct().collect()}
        strategies = [s for s in strategies if s.id in used]
    unified = {r.account_id for r in features.where(features["feature"] == UNIFIED).select("account_id").collect()}
    writes: dict[tuple, list[int]] = {}
    outputs = []
    for strategy in strategies:
        scope = (strategy.account_id, strategy.retailer_id)
        if scope not in writes:
            chosen = scopes.output_accounts(accounts, features, DOCUMENTS, *scope)
            writes[scope] = sorted(r.account_id for r in chosen.select("account_id").distinct().collect())
        for account in writes[scope]:
            catalog = strategy.catalog_id if strategy.catalog_id is not None else default_catalogs.get(account)
            if catalog is not None:
                own = settings.get(account, AccountSettings())
                outputs.append(Output(replace(strategy, catalog_id=catalog), account, own, account in unified))
    return outputs


def _start(output: Output, tables: Tables, as_of: datetime) -> DataFrame | None:
    strategy = output.strategy
    if strategy.algorithm in RANKINGS:
        return rankings.metric(strategy, tables, as_of)
    if strategy.algorithm == "similar_products_v2":
        return None  # depends on the account's catalog and weights
    return pairings.product_pairs(strategy, tables, as_of, output.settings)


@dataclass(frozen=True)
class _Family:
    """Outputs that one plan renders: they start from the same metric or pairs and rank over the same keys."""

    start: tuple
    retailer_id: int
    catalog_id: int
    geo_target: str
    bucketed: bool
    merged_text: bool
    weights: tuple | None


Filters = tuple[filters.RankingFilters, filters.RankingFilters] | tuple[filters.PairFilters, filters.PairFilters]


def _rendering(output: Output, tables: Tables) -> tuple[_Family, Filters]:
    """The family of an output, and its own and its account's filters."""
    s, fields = output.strategy, tables.catalog_fields
    if s.algorithm in RANKINGS:
        both = (filters.split_for_ranking(s.filter_json, fields), filters.split_for_ranking(output.settings.filter_json, fields))
        shape = s.geo_target, any(f.bucketed for f in both), any(representatives.needs_text([f.late]) for f in both), None
    else:
        own = filters.with_algorithm_filter(s.filter_json, s.algorithm)
        both = (filters.split_for_pairs(own, fields), filters.split_for_pairs(output.settings.filter_json, fields))
        weights = output.settings.similarity_weights if s.algorithm == "similar_products_v2" else None
        if s.algorithm == "similar_products_v2" and weights is None:
            raise ValueError(f"strategy {s.id} needs similarity weights")
        shape = "none", any(f.bucketed for f in both), False, weights
    return _Family(shared_key(output), s.retailer_id, s.catalog_id, *shape), both


def ranks(family: _Family, algorithm: str, renderings: list[Filters], tables: Tables, start: DataFrame | None) -> DataFrame:
    """Ranked lists of all renderings of a family, numbered in column `rendering`."""
    if algorithm in RANKINGS:
        return rankings.rank_for_many(start, tables, family.retailer_id, family.catalog_id, geo_columns(family.geo_target), renderings, family.bucketed)
    stock = catalogs.dataset(tables.catalog, family.retailer_id, family.catalog_id)
    fresh = catalogs.latest(stock, tables.expiration)
    if start is None:
        return similarity.similar_skus_for_many(catalogs.in_stock(stock), fresh, family.weights, renderings, tables.catalog_fields, family.bucketed)
    lists = collab.explode_pairs_for_many(pairs.as_lookup(start), fresh, renderings, tables.catalog_fields, family.bucketed)
    return ranking.normalised(lists, ranking.score_ends(start))


def all_documents(outputs: Iterable[Output], tables: Tables, as_of: datetime, sent: datetime) -> DataFrame:
    """Documents of all outputs as one DataFrame, ready for `documents.write`.

    Strategies are rows: outputs that start from the same metric or pairs and rank over the same keys (geo target, with
    or without buckets) are one plan, however many they are. Equal filters are one rendering, which is addressed to its
    strategies and accounts at the end. What several plans start from is written to the shared folder.
    """
    families: dict[_Family, list[tuple[Filters, list[Output]]]] = {}
    for output in outputs:
        family, both = _rendering(output, tables)
        members = families.setdefault(family, [])
        known = next((group for other, group in members if other == both), None)
        if known is None:
            members.append((both, [output]))
        else:
            known.append(output)
    rendered: list[DataFrame] = []
    starts: dict[tuple, DataFrame | None] = {}
    for number, (family, members) in enumerate(families.items()):
        first = members[0][1][0]
        if family.start not in starts:
            start = _start(first, tables, as_of)
            shared = sum(f.start == family.start for f in families) > 1
            starts[family.start] = materialise(start, f"start-{number}") if start is not None and shared and first.strategy.algorithm in RANKINGS else start
        rows = ranks(family, first.strategy.algorithm, [both for both, _ in members], tables, starts[family.start])
        everyone = [(n, o.account_id, o.strategy.id, o.unified) for n, (_, group) in enumerate(members) for o in group]
        addresses = tables.accounts.sparkSession.createDataFrame(everyone, "rendering int, account_id bigint, strategy_id int, unified boolean")
        geo, unified = geo_columns(family.geo_target), addresses.where("unified").drop("unified")
        if any(row[-1] for row in everyone):
            rows = materialise(rows, f"ranks-{number}")
            rendered.append(documents.unified_documents(rows, geo, unified, None, sent))
        older = documents.global_documents(rows, geo, addresses.drop("unified"), None, sent) if first.strategy.algorithm in RANKINGS else documents.pair_documents(rows, addresses.drop("unified"), None, sent)
        rendered.append(older)
    if not rendered:
        raise ValueError("nothing to render")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rendered)
