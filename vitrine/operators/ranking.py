"""Ranking SKUs, globally or per lookup key, with and without product-type buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vitrine.functions.product_types import buckets
from vitrine.functions.scores import normalise, scale_to_max
from vitrine.storage import in_rounds, materialise

GLOBAL_LIMIT = 1000
PAIR_LIMIT = 50
PAIR_FEED_LIMIT = 10_000
PRUNED = 1000  # Spark's own threshold: row limits up to here are applied inside each task before the shuffle
SHARES = 32
ROUND_ROWS = 500_000_000  # rows of a feed that are shuffled at a time
BUCKET = "split_product_type"


def scaled(scores: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    """Scores scaled to the highest one (of all places together; per account when asked).

    Scores are written to the shared folder: the highest one and the rows start from them, and all behind them runs once.
    """
    scores = materialise(scores, "scores")
    if per:
        tops = scores.groupBy(*per).agg(F.max("score").alias("top"))
        return scores.join(tops, list(per)).withColumn("score", scale_to_max(F.col("score"), F.col("top"))).drop("top")
    top = scores.agg(F.max("score")).scalar()
    return scores.withColumn("score", scale_to_max(F.col("score"), top))


def score_ends(pairs: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    """Lowest and highest pair score of the whole scope (or of each account)."""
    return pairs.groupBy(*per).agg(F.min("score").alias("low"), F.max("score").alias("high"))


def normalised(rows: DataFrame, ends: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    """Add `normalized_score`. Applied to finished lists, so only kept rows are computed."""
    score = F.col("score")
    if per:
        joined = rows.join(ends, list(per))
        return joined.withColumn("normalized_score", normalise(score, F.col("low"), F.col("high"))).drop("low", "high")
    both = ends.select(F.struct("low", "high")).scalar()
    return rows.withColumn("normalized_score", normalise(score, both.getField("low"), both.getField("high")))


def to_skus(scores: DataFrame, skus: DataFrame) -> DataFrame:
    """Scored products exploded to their representative SKUs.

    Sorted by product on both sides: few SKUs are few tasks, in which written scores, small as a file, would meet them all.
    """
    return scores.hint("merge").join(skus.withColumnRenamed("item_group_id", "product_id"), "product_id").drop("product_id")


def with_product_type(skus: DataFrame, catalog: DataFrame) -> DataFrame:
    """Product type of each SKU as the catalog has it (no freshness test)."""
    return skus.join(catalog.select("id", "product_type"), "id")


def with_buckets(skus: DataFrame, catalog: DataFrame) -> DataFrame:
    """`with_product_type` with the list of buckets in its place: split per SKU, before there is a row per place."""
    return skus.join(catalog.select("id", buckets(F.col("product_type")).alias(BUCKET)), "id")


def exploded(df: DataFrame) -> DataFrame:
    """One row per listed product type plus the catch-all ''; no product type, no rows."""
    return df.withColumn(BUCKET, F.explode(buckets(F.col("product_type"))))


def ranked(sku_scores: DataFrame, partition: list[str], limit: int = GLOBAL_LIMIT) -> DataFrame:
    """Rank by score, then id. The limit prunes inside every task before the shuffle."""
    order = Window.partitionBy(*partition).orderBy(F.col("score").desc(), F.col("id"))
    return sku_scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def ranked_pairs(sku_pairs: DataFrame, partition: list[str], limit: int = PAIR_LIMIT) -> DataFrame:
    """Rank the SKUs of every lookup key by score, highest ids first among equals."""
    order = Window.partitionBy(*partition).orderBy(F.col("score").desc(), F.col("id").desc())
    return sku_pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def pair_ordinals(pairs: DataFrame, limit: int = PAIR_FEED_LIMIT) -> DataFrame:
    """Products of every lookup key in order of score, then highest product id.

    A limit above what Spark prunes by itself before a shuffle (`PRUNED`) is
    applied to random shares of every key first: no task sorts the whole of a
    popular key, and the second step meets at most SHARES * limit rows of one.
    For a smaller one a single shuffle will do, of the rows each task keeps. Of
    very many rows the keys go through in rounds, whose results are written.
    """
    key = ["account_id", "lookup_key"]
    best = [F.col("score").desc(), F.col("product_id").desc()]

    def first(df: DataFrame, partition: list[str]) -> DataFrame:
        order = Window.partitionBy(*partition).orderBy(*best)
        return df.withColumn("ordinal", F.row_number().over(order)).where(F.col("ordinal") <= limit)

    def cut(rows: DataFrame) -> DataFrame:
        if limit <= PRUNED:
            return first(rows, key)
        shares = rows.withColumn("share", F.pmod(F.hash("product_id"), F.lit(SHARES)))
        return first(first(shares, [*key, "share"]).drop("share"), key)

    rounds = -(-pairs.count() // ROUND_ROWS)
    return cut(pairs) if rounds <= 1 else in_rounds(pairs, "feed", rounds, *key, then=cut)
