"""Recommendation documents: one nested record per lookup key and filter bucket."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions import sharding
from vitrine.functions.times import stamp
from vitrine.operators.ranking import BUCKET

# Feed names.
GLOBAL_FEED = "RECSET_NONCOLLAB_RECS"
PAIR_FEED = "RECSET_COLLAB_RECS"
UNIFIED_FEED = "RECSET_RECS"
PRODUCT_FEED = "RECSET_COLLAB_RECS_PID"


def _list(order: str, entry: list[str]) -> Column:
    """Entries of a bucket in rank order. Buckets are bounded by the ranking limits."""
    gathered = F.array_sort(F.collect_list(F.struct(order, *[c for c in entry if c != order])))
    return F.transform(gathered, lambda e: F.struct(*[e[c].alias(c) for c in entry]))


def _bucket(ranks: DataFrame) -> Column:
    return F.col(BUCKET) if BUCKET in ranks.columns else F.lit("")


def _envelope(document: Column, account: Column, strategy_id: int | Column, feed: str, sent: datetime) -> list[Column]:
    return [
        sharding.shard_key(account).alias("shard_key"),
        document.alias("document"),
        F.date_format(sharding.minute_bucket(stamp(sent)), "yyyy-MM-dd HH:mm:ss").alias("sent_time"),
        F.struct(account.alias("id")).alias("account"),
        F.struct(F.lit(feed).alias("feed_type"), (F.lit(strategy_id) if isinstance(strategy_id, int) else strategy_id).alias("id")).alias("schema"),
    ]


#: Who gets the lists: one account, several, the account that rows name (None), or a table of renderings with the
#: accounts and strategies they answer (rendering, account_id, strategy_id).
Accounts = int | tuple[int, ...] | None | DataFrame


def _account(account_id: Accounts) -> list[str]:
    """Grouping column of a run whose rows name their account or rendering."""
    return ["account_id"] if account_id is None else ["rendering"] if isinstance(account_id, DataFrame) else []


def _addressed(lists: DataFrame, account_id: Accounts, strategy_id: int | None) -> tuple[DataFrame, Column, int | Column]:
    """Finished lists with the account and strategy each goes to."""
    if account_id is None:
        return lists, F.col("account_id"), strategy_id
    if isinstance(account_id, int):
        return lists, F.lit(account_id).cast("bigint"), strategy_id
    if isinstance(account_id, DataFrame):
        return lists.join(account_id, "rendering"), F.col("account_id"), F.col("strategy_id")
    each = F.explode(F.array(*[F.lit(a).cast("bigint") for a in account_id]))
    return lists.withColumn("account_id", each), F.col("account_id"), strategy_id


def global_documents(
    ranks: DataFrame, geo: tuple[str, ...], account_id: Accounts, strategy_id: int | None, sent: datetime
) -> DataFrame:
    """Older feed of a global ranking: buckets are named by a hash alone."""
    keys = _account(account_id) + [*geo, *([BUCKET] if BUCKET in ranks.columns else [])]
    entries = ranks.withColumnRenamed("score", "normalized_score")
    lists = entries.groupBy(*keys).agg(_list("rank", ["id", "normalized_score", "rank"]).alias("data"))
    document = F.struct(
        F.sha1(sharding.slash_filter_text(_bucket(ranks), geo)).alias("pushdown_filter_hash"), F.col("data")
    )
    lists, account, strategy = _addressed(lists.where(F.size("data") > 0), account_id, strategy_id)
    return lists.select(*_envelope(document, account, strategy, GLOBAL_FEED, sent))


def unified_documents(
    ranks: DataFrame, geo: tuple[str, ...], account_id: Accounts, strategy_id: int | None, sent: datetime
) -> DataFrame:
    """Unified feed, for global rankings (lookup key '') and item-to-item lists alike."""
    paired = "lookup_key" in ranks.columns
    keys = _account(account_id) + [*(["lookup_key"] if paired else []), *geo, *([BUCKET] if BUCKET in ranks.columns else [])]
    entries = ranks if paired else ranks.withColumnRenamed("score", "normalized_score")
    lists = entries.groupBy(*keys).agg(_list("rank", ["id", "normalized_score", "rank"]).alias("data"))
    text = sharding.json_filter_text(_bucket(ranks), geo)
    document = F.struct(
        F.sha1(text).alias("pushdown_filter_hash"),
        (F.col("lookup_key") if paired else F.lit("")).alias("lookup_key"),
        text.alias("pushdown_filter_json"),
        F.col("data"),
    )
    lists, account, strategy = _addressed(lists.where(F.size("data") > 0), account_id, strategy_id)
    return lists.select(*_envelope(document, account, strategy, UNIFIED_FEED, sent))


def pair_documents(ranks: DataFrame, account_id: Accounts, strategy_id: int | None, sent: datetime) -> DataFrame:
    """Older feed of an item-to-item list: one document per lookup key (and bucket, so that no array grows with their number)."""
    keys = _account(account_id) + ["lookup_key", *([BUCKET] if BUCKET in ranks.columns else [])]
    lists = ranks.groupBy(*keys).agg(_list("rank", ["id", "normalized_score", "rank"]).alias("data"))
    document = F.struct("lookup_key", "data")
    lists, account, strategy = _addressed(lists, account_id, strategy_id)
    return lists.select(*_envelope(document, account, strategy, PAIR_FEED, sent))


def product_documents(
    ordinals: DataFrame,
    sent: datetime,
    algorithm: str,
    lookback_days: int,
    account_id: int | None = None,
    market_id: int | None = None,
    retailer_id: int | None = None,
) -> DataFrame:
    """Product-to-product feed, one document per account and key; `ordinals` comes from ranking.pair_ordinals."""
    entry = ["product_id", "normalized_score", "score"]
    gathered = F.array_sort(F.collect_list(F.struct("ordinal", *entry)))
    lists = ordinals.groupBy("account_id", "lookup_key").agg(
        F.transform(gathered, lambda e: F.struct(*[e[c].alias(c) for c in entry])).alias("data")
    )
    schema = F.struct(
        F.lit(PRODUCT_FEED).alias("feed_type"),
        F.lit(None).cast("int").alias("id"),
        F.lit(account_id).cast("bigint").alias("account_id"),
        F.lit(market_id).cast("bigint").alias("market_id"),
        F.lit(retailer_id).cast("bigint").alias("retailer_id"),
        F.lit(algorithm).alias("algorithm"),
        F.lit(lookback_days).alias("lookback_days"),
    )
    return lists.select(
        sharding.shard_key(F.col("account_id")).alias("shard_key"),
        F.struct("lookup_key", "data").alias("document"),
        F.struct(F.col("account_id").alias("id")).alias("account"),
        F.date_format(sharding.minute_bucket(stamp(sent)), "yyyy-MM-dd HH:mm:ss").alias("sent_time"),
        schema.alias("schema"),
    )
