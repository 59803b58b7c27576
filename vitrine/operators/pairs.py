"""Product pairs that share a device or a customer.

Baskets are reduced to one row per basket and product before pairs are formed.
Pairs of an ordinary basket are formed inside one row, as a list of partners for
each product, and the lists are shuffled in place of the pairs; large baskets are
cut into blocks on both sides of a join. Counted pairs are written, in rounds: the
lists of some products after those of others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.storage import in_rounds, materialise

DEVICE = ("account_id", "mid_epoch", "mid_ts", "mid_rnd")
CUSTOMER = ("dataset_id", "customer_id")
BASKET_ROWS = 256
HOT_ROWS = 20_000  # rows of a product whose lists are one key
PAIRS_A_TASK = 1_000_000
ROUND_PAIRS = 200_000_000  # pairs whose lists are shuffled at a time


def last_purchases(lines: DataFrame) -> DataFrame:
    """Last purchase time of every device and product."""
    return lines.groupBy(*DEVICE, "product_id").agg(F.max("fact_time").alias("fact_time"))


def earliest_views(product_views: DataFrame) -> DataFrame:
    """First view time of every device and product."""
    return product_views.groupBy(*DEVICE, "product_id").agg(F.min("fact_time").alias("fact_time"))


def without_outliers(baskets: DataFrame, lookback_days: int, monthly_cap: float = 1000) -> DataFrame:
    """Drop devices with at least `monthly_cap` distinct products per 30 days.

    Sizes come from a grouped count, not a window, so no task holds a whole device.
    """
    sizes = baskets.groupBy(*DEVICE).agg(F.count(F.lit(1)).alias("size"))
    usual = sizes.where(F.col("size") < F.lit(lookback_days / 30.0 * monthly_cap))
    return baskets.join(usual.select(*DEVICE), list(DEVICE), "left_semi")


def _frequent_products(baskets: DataFrame, minimum_count: int) -> DataFrame:
    """Products on enough rows to reach the threshold in any pair.

    A pair counted n times needs both its products on at least n rows of their
    account, so dropping rarer products loses no pair and thins the self-join.
    """
    if minimum_count <= 1:
        return baskets
    often = (
        baskets.groupBy("account_id", "product_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= minimum_count)
        .drop("n")
    )
    return baskets.join(often, ["account_id", "product_id"], "left_semi")


def _lists_of_small(rows: DataFrame, key: tuple[str, ...], item: list[str], later_only: bool) -> DataFrame:
    """All fitting pairs of baskets of at most BASKET_ROWS rows, as one list of partners (`LISTS`) for each row.

    A basket is sorted by `item`, whose first column is the one that orders a pair; each item carries only those
    after it, so no pair is formed twice. The list of a product with several `shares` is dealt out by its partners.
    """
    baskets = rows.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(*item))).alias("items")).where(F.size("items") > 1)
    baskets = materialise(baskets.select("items"), "baskets")  # every round starts from them
    left = baskets.select(F.posexplode("items").alias("place", "one"), "items")
    later = left.select("one", F.slice("items", F.col("place") + 2, F.size("items")).alias("later"), F.explode(F.sequence(F.lit(0), F.col("one.shares") - 1)).alias("share"))

    def fits(two: Column) -> Column:
        condition = _condition(F.col("one.product_id"), two["product_id"], *([F.col("one.fact_time"), two["fact_time"]] if later_only else []))
        return condition & ((F.col("one.shares") == 1) | (_share(two["product_id"], F.col("one.shares")) == F.col("share")))

    fitting = later.select("one", "share", F.filter("later", fits).alias("later")).where(F.size("later") > 0)
    return fitting.select(
        F.col("one.account_id").alias("account_id"),
        F.col("one.product_id").alias("pid1"),
        "share",
        F.transform("later", lambda two: two["product_id"]).alias("pids"),
        F.transform("later", lambda two: F.col("one.times") * two["times"]).alias("ns"),
    )


def _pairs_of_large(rows: DataFrame, key: tuple[str, ...], item: list[str], condition: Column) -> DataFrame:
    """The same for larger baskets, whose rows carry `blocks`, the number of blocks they are cut into.

    Block i of the left side meets block j of the right side under a key of its own, so no key holds more than about
    BASKET_ROWS x BASKET_ROWS pairs and a row is copied once per block of its basket.
    """
    own = F.pmod(F.xxhash64(*[c for c in item if c not in ("times", "shares")]), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))

    def side(n: int, i: Column, j: Column) -> DataFrame:
        return rows.select(*key, i.alias("i"), j.alias("j"), *[F.col(c).alias(f"{c}{n}") for c in item])

    return side(1, own, every).join(side(2, every, own), [*key, "i", "j"]).where(condition)


def _condition(pid1: Column, pid2: Column, time1: Column | None = None, time2: Column | None = None) -> Column:
    """Which rows of a basket make a pair: the lower product id first, or, with times, the strictly earlier one."""
    return pid1 < pid2 if time1 is None else (pid1 != pid2) & (time1 < time2)


def _share(pid2: Column, shares: Column) -> Column:
    return F.pmod(F.xxhash64(pid2), shares).cast("int")


#: Partners of one product in one basket: (account_id, pid1, share, pids, ns), lists of products and of numbers of row pairs.
LISTS = ("account_id", "pid1", "share", "pids", "ns")


def _what(timed: bool) -> list[str]:
    return ["product_id", *(["fact_time"] if timed else [])]


def _folded(baskets: DataFrame, key: tuple[str, ...], timed: bool) -> tuple[DataFrame, int]:
    """Equal rows of a basket folded into one with their number, written, and the most pairs there can be.

    Basket sizes come from a grouped count, never from a window over a whole basket.
    """
    owner = [] if "account_id" in key else ["account_id"]
    # NULLs never pair.
    known = baskets.dropna(subset=[*key, *_what(timed)])
    sizes = known.groupBy(*key).agg(F.count(F.lit(1)).cast("double").alias("size"))
    most = sizes.agg(F.sum(F.col("size") * (F.col("size") - 1) / 2)).first()[0]
    folded = known.repartition(*key).groupBy(*key, *owner, *_what(timed)).agg(F.count(F.lit(1)).alias("times"))
    return materialise(folded, "folded"), int(most or 0)


def _with_shares(sources: list[DataFrame]) -> list[DataFrame]:
    """Rows with the number of shares of their product: one in very many baskets is no single key, in no source."""
    every = reduce(DataFrame.unionByName, [rows.select(F.col("account_id").alias("_owner"), F.col("product_id").alias("_product")) for rows in sources])
    wide = every.groupBy("_owner", "_product").agg(F.ceil(F.count(F.lit(1)) / HOT_ROWS).cast("int").alias("wide")).where(F.col("wide") > 1)
    wide = materialise(wide, "wide-products")
    if wide.isEmpty():
        return [rows.withColumn("shares", F.lit(1)) for rows in sources]
    same = F.col("account_id").eqNullSafe(F.col("_owner")) & (F.col("product_id") == F.col("_product"))
    return [rows.join(wide, same, "left").withColumn("shares", F.coalesce("wide", F.lit(1))).drop("_owner", "_product", "wide") for rows in sources]


def _partner_lists(rows: DataFrame, key: tuple[str, ...], timed: bool) -> DataFrame:
    """`LISTS` of the folded rows of each basket, not yet added up; a pair stands for the product of the two numbers."""
    what = _what(timed)
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("size"))
    large = sizes.where(F.col("size") > BASKET_ROWS).select(*key, F.ceil(F.col("size") / BASKET_ROWS).cast("int").alias("blocks"))
    item = [*reversed(what), "account_id", "times", "shares"]  # time first, if it counts: see _lists_of_small
    large = materialise(large, "large-baskets")
    some = not large.isEmpty()
    small = rows.join(large, list(key), "left_anti") if some else rows
    renamed = {c: f"_{c}" for c in key}

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({new: F.col(old) for old, new in renamed.items()})

    keys = tuple(renamed.values())
    condition = _condition(*[F.col(f"{c}{n}") for c in what for n in (1, 2)])
    one = [
        F.col("account_id1").alias("account_id"),
        F.col("product_id1").alias("pid1"),
        _share(F.col("product_id2"), F.col("shares1")).alias("share"),
        F.array("product_id2").alias("pids"),
        F.array(F.col("times1") * F.col("times2")).alias("ns"),
    ]
    lists = _lists_of_small(keyed(small), keys, item, timed)
    if not some:
        return lists
    blocked = materialise(keyed(rows.join(large, list(key))), "large-rows")
    return lists.unionByName(_pairs_of_large(blocked, keys, item, condition).select(*one))


def _counted(sources: list[tuple[DataFrame, tuple[str, ...]]], timed: bool, minimum_count: int = 1, by: str = "sum") -> DataFrame:
    """Pairs of the baskets of all sources (and their keys) added up, or (`source_count`) the number of sources that have them; written.

    The lists are shuffled, by their product, and become pairs where they meet.
    """
    folded = [_folded(baskets, key, timed) for baskets, key in sources]
    parts = [_partner_lists(rows, key, timed) for rows, (_, key) in zip(_with_shares([rows for rows, _ in folded]), sources)]
    lists = reduce(DataFrame.unionByName, [part.withColumn("source", F.lit(k)) for k, part in enumerate(parts)])
    most = sum(most for _, most in folded)
    rounds = max(1, -(-most // ROUND_PAIRS))
    tasks = max(1, -(-most // (rounds * PAIRS_A_TASK)))

    def added_up(mine: DataFrame) -> DataFrame:
        met = mine.repartition(tasks, "account_id", "pid1", "share")
        rows = met.select("account_id", "pid1", "share", "source", F.explode(F.arrays_zip("pids", "ns")).alias("x"))
        found_in = [F.max((F.col("source") == k).cast("bigint")) for k in range(len(parts))]
        score = {"sum": F.sum("n"), "source_count": reduce(Column.__add__, found_in)}[by]
        named = rows.select("account_id", "pid1", "share", "source", F.col("x.pids").alias("pid2"), F.col("x.ns").alias("n"))
        counted = named.groupBy("account_id", "pid1", "share", "pid2").agg(score.alias("score"))
        return counted.where(F.col("score") >= minimum_count).select("account_id", "pid1", "pid2", "score")

    return in_rounds(lists, "pairs", rounds, "pid1", then=added_up)


def mirrored(half: DataFrame) -> DataFrame:
    """Both directions of every unordered pair, from a single pass over them."""
    both = F.array(
        F.struct(F.col("pid1"), F.col("pid2")), F.struct(F.col("pid2").alias("pid1"), F.col("pid1").alias("pid2"))
    )
    return half.select("account_id", F.explode(both).alias("pair"), "score").select(
        "account_id", "pair.pid1", "pair.pid2", "score"
    )


def _frequent(baskets: DataFrame, key: tuple[str, ...], minimum_count: int) -> DataFrame:
    return _frequent_products(baskets, minimum_count) if key == DEVICE else baskets


def unordered(baskets: DataFrame, key: tuple[str, ...], minimum_count: int = 1) -> DataFrame:
    """Pairs of different products in one basket (pid1 < pid2), with the number of row pairs.

    The count is symmetric: `mirrored` gives the other half.
    """
    return _counted([(_frequent(baskets, key, minimum_count), key)], False, minimum_count)


def unordered_of_both(online: DataFrame, pos: DataFrame, minimum_count: int = 1) -> DataFrame:
    """`unordered` of devices and customers with their scores added up; without a threshold, in one aggregation."""
    if minimum_count > 1:
        return merged(unordered(online, DEVICE, minimum_count), unordered(pos, CUSTOMER, minimum_count))
    return _counted([(online, DEVICE), (pos, CUSTOMER)], False)


def together(baskets: DataFrame, key: tuple[str, ...], minimum_count: int = 1) -> DataFrame:
    """Directed pairs of different products in one basket, with the number of row pairs."""
    return mirrored(unordered(baskets, key, minimum_count))


def in_sequence(baskets: DataFrame, key: tuple[str, ...], minimum_count: int = 1) -> DataFrame:
    """Directed pairs where the second product came strictly later."""
    return _counted([(_frequent(baskets, key, minimum_count), key)], True, minimum_count)


def in_sequence_of_both(online: DataFrame, pos: DataFrame, by: str = "sum", minimum_count: int = 1) -> DataFrame:
    """`merged` pairs `in_sequence` of devices and customers; without a threshold, in one aggregation."""
    if minimum_count > 1:
        return merged(in_sequence(online, DEVICE, minimum_count), in_sequence(pos, CUSTOMER, minimum_count), by)
    return _counted([(online, DEVICE), (pos, CUSTOMER)], True, by=by)


def merged(online: DataFrame, pos: DataFrame, by: str = "sum") -> DataFrame:
    """Online and point-of-sale pairs: scores added up, or (`source_count`) the number of sources."""
    score = {"sum": F.sum("score"), "source_count": F.count(F.lit(1))}[by]
    return online.unionByName(pos).groupBy("account_id", "pid1", "pid2").agg(score.alias("score"))


def as_lookup(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "account_id", F.col("pid1").alias("lookup_key"), F.col("pid2").alias("product_id"), "score"
    )
