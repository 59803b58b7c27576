"""One registered query per operator, over the whole stored tables.

Look-back windows cover all order days and all event days.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.functions import filters, sharding
from vitrine.functions.times import lookback_window, session_window
from vitrine.operators import collab, documents, metrics, pairs, publish, ranking, representatives, scopes, sessions
from vitrine.plans import fan_out, pairings, rankings
from vitrine.plans.strategy import AccountSettings, Strategy
from vitrine.sources import catalogs, facts
from vitrine.storage import materialise, shared_folder
from vitrine.sources.star_schema import CATALOG, CATALOG_FIELDS, EVENTS_AS_OF, ORDERS_AS_OF, RETAILER, StarSchema

Query = Callable[[SparkSession, str], DataFrame]
BASE = filters.BASE_ITEM
ALL_ORDER_DAYS, VIEW_DAYS = 2405, 30
ORDER_WINDOW = lookback_window(ORDERS_AS_OF, ALL_ORDER_DAYS)
WEEK, MONTH = lookback_window(ORDERS_AS_OF, 7), lookback_window(ORDERS_AS_OF, 30)
VIEW_WINDOW = lookback_window(EVENTS_AS_OF, VIEW_DAYS)


def leaf(op: str, field: str, value, function: bool = False) -> dict:
    return {
        "type": op,
        "left": {"type": "field", "field": field},
        "right": {"type": "function" if function else "value", "value": value},
    }


def tree(kind: str, *leaves: dict) -> str:
    return json.dumps({"type": kind, "filters": list(leaves)})


CART = leaf("startswith", "product_type", "any_item_in_cart", function=True)

# Filters by query name, applied to the whole catalog.
CATALOG_FILTERS = {
    "filter_startswith": tree("and", leaf("startswith", "title", ["small", "red wid"])),
    "filter_startswith_product_type": tree("and", leaf("startswith", "product_type", ["ECONOMY", " small"])),
    "filter_not_startswith": tree("and", leaf("not startswith", "title", ["small", None, "red"])),
    "filter_startswith_wildcard": tree("and", leaf("startswith", "title", ["s_all%g"])),
    "filter_contains": tree("and", leaf("contains", "title", ["RING", "gizmo"])),
    "filter_not_contains": tree("and", leaf("not contains", "title", ["ring"])),
    "filter_in": tree("and", leaf("in", "color", ["RED", "blue"])),
    "filter_not_in": tree("and", leaf("not in", "brand", ["brand#1", "Brand#2"])),
    "filter_eq": tree("and", leaf("==", "brand", "Brand#3")),
    "filter_eq_list": tree("and", leaf("==", "brand", ["Brand#3", "Brand#4", None])),
    "filter_ne_list": tree("and", leaf("!=", "brand", ["Brand#3", "Brand#4"])),
    "filter_ne": tree("and", leaf("!=", "color", "red")),
    "filter_gt": tree("and", leaf(">", "price", 950.1)),
    "filter_ge": tree("and", leaf(">=", "price", 950.1)),
    "filter_lt": tree("and", leaf("<", "price", 950.1)),
    "filter_le": tree("and", leaf("<=", "price", 950.1)),
    "filter_not_in_null": tree("and", leaf("not in", "grade", ["GRADE 1"])),
    "filter_not_contains_null": tree("and", leaf("not contains", "grade", [2])),
    "filter_unknown_dropped": tree("and", leaf("==", "no_such_field", 1), leaf("==", "update_time", "2001-01-01"), leaf("==", "brand", "Brand#3")),
    "filter_boolean_value": tree("and", leaf("==", "is_bundle", True)),
    "filter_empty_list": tree("and", leaf("startswith", "title", [])),
    "filter_and": tree("and", leaf("==", "is_bundle", True), leaf("in", "color", ["red"]), leaf(">", "price", 950)),
    "filter_or": tree("or", leaf("==", "is_bundle", True), leaf("in", "color", ["red"])),
    "filter_and_empty": tree("and"),
    "filter_custom_string": tree("and", leaf("==", "size_class", "class 3")),
    "filter_custom_number": tree("and", leaf(">=", "size_value", 25), leaf("<", "size_value", 40)),
}


def _filtered(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        catalog = StarSchema(spark, folder).catalog()
        split = filters.split_for_pairs(CATALOG_FILTERS[name], CATALOG_FIELDS)
        nothing = filters.split_for_pairs(filters.no_filter(), CATALOG_FIELDS)
        return collab.static_part(catalog, split, nothing, CATALOG_FIELDS).select("id", "item_group_id")

    return query


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines print them alike."""
    return df.select(
        *[F.col(n).cast("double").alias(n) if t.startswith("decimal") else F.col(n) for n, t in df.dtypes]
    )


def _strategy(algorithm: str, days: int, filter_json: str = tree("and"), **more) -> Strategy:
    if "market_id" not in more and "account_id" not in more:
        more["whole_retailer"] = True
    return Strategy(1, algorithm, RETAILER, CATALOG, days, filter_json, **more)


def _metric(algorithm: str, source: str = "online", days: int = ALL_ORDER_DAYS, pos_history: str = "lookback") -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        views = algorithm == "view"
        tables = StarSchema(spark, folder).tables(views)
        as_of = EVENTS_AS_OF if views else ORDERS_AS_OF
        return _plain(rankings.metric(_strategy(algorithm, days, source=source), tables, as_of, pos_history))

    return query


def _ranking(algorithm: str, days: int, filter_json: str = tree("and"), settings=AccountSettings(), **more) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        views = algorithm in ("view", "most_popular")
        tables = StarSchema(spark, folder).tables(views)
        as_of = EVENTS_AS_OF if views else ORDERS_AS_OF
        return _plain(rankings.recommend(_strategy(algorithm, days, filter_json, **more), tables, as_of, settings))

    return query


def _pairs(
    algorithm: str, source: str = "online", merge: str = "source_count", cap: float = 1000, settings=AccountSettings()
) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        views = algorithm == "view_also_view"
        days, as_of = (VIEW_DAYS, EVENTS_AS_OF) if views else (ALL_ORDER_DAYS, ORDERS_AS_OF)
        tables = StarSchema(spark, folder).tables(views)
        strategy = _strategy(algorithm, days, source=source)
        found = pairings.product_pairs(strategy, tables, as_of, settings, sequence_merge=merge, monthly_view_cap=cap)
        return found.withColumn("score", F.col("score").cast("bigint"))

    return query


def _pairing(algorithm: str, filter_json: str = tree("and"), settings=AccountSettings(), **more) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        views = algorithm == "view_also_view"
        days, as_of = (VIEW_DAYS, EVENTS_AS_OF) if views else (ALL_ORDER_DAYS, ORDERS_AS_OF)
        tables = StarSchema(spark, folder).tables(views)
        return _plain(pairings.recommend(_strategy(algorithm, days, filter_json, **more), tables, as_of, settings))

    return query


def _ranked_products(spark: SparkSession, folder: str) -> DataFrame:
    tables = StarSchema(spark, folder).tables(True)
    return pairings.ranked_products(pairings.product_pairs(_strategy("view_also_view", VIEW_DAYS), tables, EVENTS_AS_OF))


def session_join(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    inside = facts.facts_between(star.product_views(), star.accounts(), VIEW_WINDOW)
    places = facts.sessions_between(star.view_sessions(), star.accounts(), session_window(VIEW_WINDOW))
    return sessions.join_sessions(inside, places, VIEW_WINDOW).select(
        "account_id", "mid_ts", "product_id", "country_code", "region", F.unix_micros("fact_time").alias("fact_micros")
    )


def latest_catalog(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    return catalogs.latest(star.catalog(), star.expiration()).select("id", "item_group_id", "product_type")


def in_stock_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return catalogs.in_stock(StarSchema(spark, folder).catalog()).select("id", "item_group_id")


def offline_purchases(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    datasets = facts.account_datasets(star.settings(), star.accounts())
    pos = facts.point_of_sale(star.pos_lines(), datasets, star.expiration(), ORDER_WINDOW[0])
    return _plain(pos.withColumn("fact_time", F.date_format("fact_time", "yyyy-MM-dd")))


def valid_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of valid products of the market's accounts, per product."""
    star = StarSchema(spark, folder)
    accounts = scopes.fact_accounts(star.accounts(), star.market_accounts(), market_id=7)
    lines = facts.with_valid_product(facts.facts_since(star.purchase_lines(), accounts, ORDER_WINDOW[0]))
    return lines.groupBy("account_id", "product_id").agg(F.count(F.lit(1)).alias("n"))


def scope_accounts(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    market = scopes.fact_accounts(star.accounts(), star.market_accounts(), market_id=7).withColumn("scope", F.lit("market"))
    retailer = scopes.fact_accounts(
        star.accounts(), star.market_accounts(), retailer_id=RETAILER, whole_retailer=True
    ).withColumn("scope", F.lit("retailer"))
    return market.unionByName(retailer).select("scope", "account_id")


def _last_purchases(spark: SparkSession, folder: str) -> DataFrame:
    lines = facts.with_valid_product(StarSchema(spark, folder).purchase_lines())
    last = pairs.last_purchases(lines)
    return last.select("account_id", "mid_ts", "product_id", F.date_format("fact_time", "yyyy-MM-dd").alias("day"))


def _earliest_views(cap: float = 1000) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        views = facts.with_valid_product(StarSchema(spark, folder).product_views())
        usual = pairs.without_outliers(pairs.earliest_views(views), VIEW_DAYS, cap)
        return usual.select("account_id", "mid_ts", "product_id", F.unix_micros("fact_time").alias("fact_micros"))

    return query


def geo_rollup(target: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables = StarSchema(spark, folder).tables()
        metric = rankings.metric(_strategy("purchase", ALL_ORDER_DAYS), tables, ORDERS_AS_OF)
        return _plain(ranking.scaled(metrics.rolled_up(metric, sharding.geo_columns(target))))

    return query


def merged_product_types(spark: SparkSession, folder: str) -> DataFrame:
    return representatives.merged_product_types(StarSchema(spark, folder).catalog())


LATE = tree("and", leaf("not startswith", "product_type", ["small"]), leaf("contains", "product_type", ["ring", "BOLT"]))


def representative_skus(spark: SparkSession, folder: str) -> DataFrame:
    return representatives.representatives(StarSchema(spark, folder).catalog(), [json.loads(LATE)])


def product_type_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.exploded(StarSchema(spark, folder).catalog().select("id", "product_type"))


def context_items(spark: SparkSession, folder: str) -> DataFrame:
    return collab.context_items(StarSchema(spark, folder).catalog(), ["color", "size_class"], CATALOG_FIELDS)


def recommendable_items(spark: SparkSession, folder: str) -> DataFrame:
    return collab.recommendable(StarSchema(spark, folder).catalog(), ["size_class"], CATALOG_FIELDS, False)


def pid_ranks_normalised(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(_ranked_products(spark, folder))


def pair_feed(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(ranking.pair_ordinals(_ranked_products(spark, folder)))


def pair_feed_short(spark: SparkSession, folder: str) -> DataFrame:
    """The feed cut to five products per key, a limit that most keys reach."""
    return _plain(ranking.pair_ordinals(_ranked_products(spark, folder), limit=5))


def result_count(spark: SparkSession, folder: str) -> DataFrame:
    ranks = _ranking("view", VIEW_DAYS, tree("and", CART))(spark, folder)
    return ranks.agg(F.count(F.lit(1)).alias("n"))


def active_strategies(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    return scopes.active_strategies(
        star.strategies(), star.action_inputs(), star.actions(), star.placements(), star.campaigns(),
        star.campaign_groups(), ORDERS_AS_OF,
    ).select("id", "is_component")


def shard_keys(spark: SparkSession, folder: str) -> DataFrame:
    customers = StarSchema(spark, folder).read("customer")
    key = sharding.shard_key(F.col("c_custkey"))
    return customers.select(
        "c_custkey", key.alias("shard_key"), sharding.shard_low(key).alias("low"), sharding.shard_high(key).alias("high")
    )


# ---------------------------------------------------------------- documents, unfolded for comparison


def _unfolded(docs: DataFrame, *fields: str) -> DataFrame:
    entries = docs.select(
        *[F.col(f"document.{f}").alias(f) for f in fields],
        F.col("account.id").alias("account"),
        F.col("schema.feed_type").alias("feed_type"),
        "shard_key",
        "sent_time",
        F.col("schema.id").alias("strategy"),
        F.explode("document.data").alias("entry"),
    )
    envelope = ["account", "feed_type", "shard_key", "sent_time", "strategy"]
    return _plain(entries.select(*fields, *envelope, "entry.id", "entry.rank", "entry.normalized_score"))


def doc_global(spark: SparkSession, folder: str) -> DataFrame:
    ranks = _ranking("purchase", ALL_ORDER_DAYS, tree("and", CART), geo_target="region")(spark, folder)
    docs = documents.global_documents(ranks, sharding.geo_columns("region"), 3, 1, ORDERS_AS_OF)
    return _unfolded(docs, "pushdown_filter_hash")


def doc_unified(spark: SparkSession, folder: str) -> DataFrame:
    ranks = _ranking("purchase", ALL_ORDER_DAYS, tree("and", CART), geo_target="country")(spark, folder)
    docs = documents.unified_documents(ranks, sharding.geo_columns("country"), 3, 1, ORDERS_AS_OF)
    return _unfolded(docs, "pushdown_filter_hash", "lookup_key", "pushdown_filter_json")


def doc_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _unfolded(documents.pair_documents(_pairing("view_also_view")(spark, folder), 3, 1, EVENTS_AS_OF), "lookup_key")


def doc_pairs_unified(spark: SparkSession, folder: str) -> DataFrame:
    ranks = _pairing("view_also_view", tree("and", CART))(spark, folder)
    docs = documents.unified_documents(ranks, (), 3, 1, EVENTS_AS_OF)
    return _unfolded(docs, "pushdown_filter_hash", "lookup_key", "pushdown_filter_json")


def doc_products(spark: SparkSession, folder: str) -> DataFrame:
    ordinals = ranking.pair_ordinals(_ranked_products(spark, folder))
    docs = documents.product_documents(ordinals, EVENTS_AS_OF, "view_also_view", VIEW_DAYS, retailer_id=RETAILER)
    entries = docs.select(
        F.col("account.id").alias("account"), "document.lookup_key", "schema.feed_type", "schema.algorithm", F.posexplode("document.data").alias("at", "entry")
    )
    return _plain(entries.select("account", "lookup_key", "feed_type", "algorithm", "at", "entry.*"))


def scope_single_account(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    return scopes.fact_accounts(star.accounts(), star.market_accounts(), account_id=3).select("account_id")


def output_accounts(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    chosen = scopes.output_accounts(star.accounts(), star.features(), fan_out.DOCUMENTS, retailer_id=RETAILER).select("account_id")
    unified = star.features().where(F.col("feature") == fan_out.UNIFIED).select("account_id", F.lit(True).alias("unified"))
    return chosen.join(unified, "account_id", "left").select("account_id", F.coalesce("unified", F.lit(False)).alias("unified"))


def _run(spark: SparkSession, folder: str) -> DataFrame:
    """Three strategies over four accounts, selected and rendered in one run; a fourth is not active."""
    star = StarSchema(spark, folder)
    everyone = dict(whole_retailer=True)
    strategies = [
        Strategy(1, "most_popular", RETAILER, None, VIEW_DAYS, **everyone),
        Strategy(2, "purchase", RETAILER, CATALOG, ALL_ORDER_DAYS, tree("and", leaf("==", "is_bundle", True)), **everyone),
        Strategy(3, "view_also_view", RETAILER, CATALOG, VIEW_DAYS, **everyone),
        Strategy(4, "view", RETAILER, CATALOG, VIEW_DAYS, **everyone),
    ]
    outputs = fan_out.select(
        strategies, star.accounts(), star.features(), active=star.strategies().where("id < 4"),
        default_catalogs={n: CATALOG for n in range(5)},
    )
    views = [o for o in outputs if o.strategy.algorithm != "purchase"]
    bought = [o for o in outputs if o.strategy.algorithm == "purchase"]
    sent = ORDERS_AS_OF
    return fan_out.all_documents(views, star.tables(True), EVENTS_AS_OF, sent).unionByName(
        fan_out.all_documents(bought, star.tables(), ORDERS_AS_OF, sent), allowMissingColumns=True
    )


def _entries(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(
        F.col("account.id").alias("account"), F.col("schema.id").cast("int").alias("strategy"),
        F.col("schema.feed_type").alias("feed_type"), F.col("document.lookup_key").alias("lookup_key"), *more,
        F.explode("document.data").alias("e"),
    ).select("account", "strategy", "feed_type", "lookup_key", *more, "e.id", F.col("e.rank").cast("long").alias("rank"), F.col("e.normalized_score").cast("double").alias("normalized_score"))


def fan_out_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _entries(_run(spark, folder))


def _output_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/documents-{uuid.uuid4().hex}"


def written_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The same documents published twice for one minute, and read back: the second run replaces the first."""
    path = _output_folder(spark)
    docs = materialise(_run(spark, folder), "documents")
    publish.publish(docs, path, ORDERS_AS_OF)
    publish.publish(docs, path, ORDERS_AS_OF)
    back = publish.published(spark, path, docs.schema)
    return _entries(back, "name", "minute", "shard_low", "shard_high", "output", "unified")


def published_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Two product feeds and the lists of a run, published one after the other for one minute, all read back."""
    path = _output_folder(spark)
    for algorithm in ("view_also_view", "purchase_also_purchase"):
        views = algorithm == "view_also_view"
        days, as_of = (VIEW_DAYS, EVENTS_AS_OF) if views else (ALL_ORDER_DAYS, ORDERS_AS_OF)
        scored = pairings.product_pairs(_strategy(algorithm, days), StarSchema(spark, folder).tables(views), as_of)
        ordinals = ranking.pair_ordinals(pairings.ranked_products(scored), limit=20)
        publish.publish(documents.product_documents(ordinals, ORDERS_AS_OF, algorithm, days, retailer_id=RETAILER), path, ORDERS_AS_OF)
    publish.publish(_run(spark, folder), path, ORDERS_AS_OF)
    back = publish.published(spark, path)
    entries = back.select("name", "minute", "output", "unified", F.col("account.id").alias("account"), F.explode("document.data").alias("e"))
    totals = entries.groupBy("name", "minute", "output", "unified", "account").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("e.normalized_score") * 100).cast("long")).alias("hundredths"))
    return totals


def run_counts(spark: SparkSession, folder: str) -> DataFrame:
    """List entries of each account and strategy, as the write of the documents counts them."""
    outputs = [(account, strategy) for account in range(1, 5) for strategy in range(1, 4)]
    manifest = publish.publish(_run(spark, folder), _output_folder(spark), ORDERS_AS_OF, outputs)
    return spark.createDataFrame(manifest["entries"], "account bigint, strategy int, n bigint")


MANY_RANKINGS, MANY_LISTS = 150, 50


def fan_out_many(spark: SparkSession, folder: str) -> DataFrame:
    """200 strategies of different filters over the views, rendered by one plan of rankings and one of lists."""
    outputs = []
    for n in range(MANY_RANKINGS):
        leaves = [leaf(">", "price", 900 + 4 * n)] + [leaf("startswith", "product_type", ["ECONOMY"])] * (n % 3 == 0)
        outputs.append(fan_out.Output(Strategy(n, "most_popular", RETAILER, CATALOG, VIEW_DAYS, tree("and", *leaves), whole_retailer=True), 1 + n % 4))
    for n in range(MANY_RANKINGS, MANY_RANKINGS + MANY_LISTS):
        leaves = [leaf(">", "price", 900 + 10 * (n - MANY_RANKINGS))] + [leaf("in", "color", BASE, function=True)] * (n % 2)
        outputs.append(fan_out.Output(Strategy(n, "view_also_view", RETAILER, CATALOG, VIEW_DAYS, tree("and", *leaves), whole_retailer=True), 1 + n % 4))
    return _entries(fan_out.all_documents(outputs, StarSchema(spark, folder).tables(True), EVENTS_AS_OF, ORDERS_AS_OF))


SIMILAR_BY_FOUR = AccountSettings(
    similarity_weights=(("color", 0.5), ("brand", 0.25), ("size_class", 0.125), ("grade", None))
)
SIMILAR = AccountSettings(similarity_weights=(("color", 0.5), ("brand", 0.25)))
SIMILAR_BY_FREQUENCY = AccountSettings(similarity_weights=(("color", None), ("size_class", None)))
SAME_COLOUR = tree("and", leaf("in", "color", BASE, function=True))
STATIC = tree("and", leaf("contains", "title", ["ring", "bolt", "gear"]), leaf(">", "price", 920))
SHARED = AccountSettings(filter_json=tree("or", leaf("==", "is_bundle", True)))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {name: _filtered(name) for name in CATALOG_FILTERS}
    found |= {
        "latest_catalog": latest_catalog,
        "in_stock_catalog": in_stock_catalog,
        "offline_purchases": offline_purchases,
        "valid_purchases_in_market": valid_purchases,
        "scope_accounts": scope_accounts,
        "session_join": session_join,
        "metric_view": _metric("view", days=VIEW_DAYS),
        "metric_purchase_online": _metric("purchase"),
        "metric_purchase_offline": _metric("purchase", "offline"),
        "metric_purchase_both": _metric("purchase", "online_offline"),
        "metric_value_online": _metric("purchase_value"),
        "metric_value_offline": _metric("purchase_value", "offline"),
        "metric_value_both": _metric("purchase_value", "online_offline"),
        "metric_trending_online": _metric("trending", days=7),
        "metric_trending_offline": _metric("trending", "offline", days=7),
        "metric_trending_offline_30d": _metric("trending", "offline", days=7, pos_history="30d"),
        "metric_trending_both": _metric("trending", "online_offline", days=7),
        "geo_none": geo_rollup("none"),
        "geo_country": geo_rollup("country"),
        "geo_region": geo_rollup("region"),
        "merged_product_types": merged_product_types,
        "representative_skus": representative_skus,
        "product_type_buckets": product_type_buckets,
        "rank_view": _ranking("view", VIEW_DAYS),
        "rank_most_popular": _ranking("most_popular", VIEW_DAYS),
        "rank_view_filtered": _ranking(
            "view", VIEW_DAYS, tree("and", leaf("startswith", "product_type", ["ECONOMY", "small"]), leaf(">", "price", 905)),
            SHARED,
        ),
        "rank_view_buckets": _ranking("view", VIEW_DAYS, tree("and", CART)),
        "rank_purchase": _ranking("purchase", ALL_ORDER_DAYS),
        "rank_purchase_country": _ranking("purchase", ALL_ORDER_DAYS, geo_target="country"),
        "rank_purchase_both_region": _ranking("purchase", ALL_ORDER_DAYS, geo_target="region", source="online_offline"),
        "rank_purchase_market": _ranking("purchase", ALL_ORDER_DAYS, market_id=7),
        "rank_purchase_value": _ranking("purchase_value", ALL_ORDER_DAYS, source="online_offline"),
        "rank_trending": _ranking("trending", 7),
        "rank_or_filter_dropped": _ranking(
            "view", VIEW_DAYS, tree("or", leaf("contains", "brand", ["2"]), leaf("startswith", "product_type", ["E"]))
        ),
        "last_purchases": _last_purchases,
        "earliest_views": _earliest_views(),
        "earliest_views_capped": _earliest_views(14),
        "pairs_together_online": _pairs("purchase_also_purchase"),
        "pairs_together_offline": _pairs("purchase_also_purchase", "offline"),
        "pairs_together_both": _pairs("purchase_also_purchase", "online_offline"),
        "pairs_sequence_online": _pairs("subsequently_purchased"),
        "pairs_sequence_offline": _pairs("subsequently_purchased", "offline"),
        "pairs_sequence_both": _pairs("subsequently_purchased", "online_offline"),
        "pairs_sequence_both_summed": _pairs("subsequently_purchased", "online_offline", merge="sum"),
        "pairs_views": _pairs("view_also_view"),
        "pairs_views_capped": _pairs("view_also_view", cap=14),
        "pid_ranks_normalised": pid_ranks_normalised,
        "pair_feed": pair_feed,
        "pair_feed_short": pair_feed_short,
        "pairs_together_threshold": _pairs("purchase_also_purchase", settings=AccountSettings(minimum_purchases=3)),
        "pairs_together_without_pos": _pairs("purchase_also_purchase", "offline", settings=AccountSettings(has_point_of_sale=False)),
        "collab_starts_with_base_brand": _pairing("view_also_view", tree("and", leaf("startswith", "brand", BASE, function=True))),
        "similar_four_attributes": _pairing("similar_products_v2", settings=SIMILAR_BY_FOUR),
        "scope_single_account": scope_single_account,
        "output_accounts": output_accounts,
        "fan_out_documents": fan_out_documents,
        "written_documents": written_documents,
        "published_feeds": published_feeds,
        "run_counts": run_counts,
        "fan_out_many": fan_out_many,
        "context_items": context_items,
        "recommendable_items": recommendable_items,
        "collab_static": _pairing("purchase_also_purchase", STATIC, SHARED),
        "collab_views": _pairing("view_also_view"),
        "collab_bucket": _pairing("view_also_view", tree("and", CART)),
        "collab_same_colour": _pairing("view_also_view", SAME_COLOUR),
        "collab_other_class": _pairing("view_also_view", tree("and", leaf("not in", "size_class", BASE, function=True))),
        "collab_contains_base_title": _pairing("view_also_view", tree("and", leaf("contains", "title", BASE, function=True))),
        "collab_product_type_contains": _pairing(
            "view_also_view", tree("and", leaf("contains", "product_type", BASE, function=True))
        ),
        "bought_together": _pairing("bought_together", source="online_offline"),
        "subsequently_purchased": _pairing("subsequently_purchased"),
        "similar_weighted": _pairing("similar_products_v2", settings=SIMILAR),
        "similar_inverse_frequency": _pairing("similar_products_v2", settings=SIMILAR_BY_FREQUENCY),
        "similar_same_colour": _pairing("similar_products_v2", SAME_COLOUR, SIMILAR_BY_FREQUENCY),
        "doc_global": doc_global,
        "doc_unified": doc_unified,
        "doc_pairs": doc_pairs,
        "doc_pairs_unified": doc_pairs_unified,
        "doc_products": doc_products,
        "result_count": result_count,
        "shard_keys": shard_keys,
        "active_strategies": active_strategies,
    }
    return found
