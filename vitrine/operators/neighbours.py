"""The best partners of every product, straight from baskets, without a table of all pairs.

Products are numbers here, in the order in which equal scores are ranked: those that no list can hold come first, below
`floor`. Every product of a basket gets the list of its partners, the lists are shuffled by product, and one task adds up
all pairs of a product and keeps the best. Products are dealt over rounds, so the lists that lie on disk at a time are
bounded, whatever the number of pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from vitrine.operators import pairs
from vitrine.storage import materialise

ROUND_PAIRS = 500_000_000  # pairs (each from both sides) whose lists are shuffled at a time


@dataclass(frozen=True)
class Baskets:
    """Numbered baskets of each source: small ones are a row, of large ones each item is; and the most pairs, both ways."""

    small: list[DataFrame]
    large: list[DataFrame | None]
    timed: bool
    floor: int
    dealt: bool  # some products have several shares
    most: int

    @property
    def rounds(self) -> int:
        return max(1, -(-self.most // ROUND_PAIRS))


def gathered(sources: list[tuple[DataFrame, tuple[str, ...]]], timed: bool, products: DataFrame, floor: int) -> Baskets:
    """Baskets of the sources with products by their number (`product_id`, `n`); equal rows of a basket are one with its number.

    A basket is large if it has more than BASKET_ROWS rows, or rows of several accounts: the account of a pair is then
    decided pair by pair.
    """
    what = ["product_id", *(["fact_time"] if timed else [])]
    known = [baskets.dropna(subset=[*key, *what]) for baskets, key in sources]
    every = reduce(DataFrame.unionByName, [rows.select("product_id") for rows in known])
    wide = every.groupBy("product_id").agg(F.ceil(F.count(F.lit(1)) / pairs.HOT_ROWS).cast("int").alias("wide")).where(F.col("wide") > 1)
    wide = materialise(wide, "wide-products")
    dealt, most, small, large = not wide.isEmpty(), 0, [], []
    for rows, (_, key) in zip(known, sources):
        mixed = F.min("account_id") != F.max("account_id")
        sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("size"), mixed.alias("mixed"))
        size = F.col("size").cast("double")
        most += int(sizes.agg(F.sum(size * (size - 1))).first()[0] or 0)
        big = materialise(sizes.where((F.col("size") > pairs.BASKET_ROWS) | F.col("mixed")).select(*key, F.ceil(F.col("size") / pairs.BASKET_ROWS).cast("int").alias("blocks")), "large-baskets")
        some = not big.isEmpty()
        named = rows.join(products.select("product_id", "n"), "product_id")
        named = named.join(wide, "product_id", "left").withColumn("shares", F.coalesce("wide", F.lit(1))) if dealt else named.withColumn("shares", F.lit(1))
        usual = named.join(big.drop("blocks"), list(key), "left_anti") if some else named
        small.append(materialise(_in_rows(_folded(usual, key, timed), key, timed, floor), "baskets"))
        large.append(materialise(_folded(named.join(big, list(key)), (*key, "blocks"), timed), "large-rows") if some else None)
    return Baskets(small, large, timed, floor, dealt, most)


def _folded(rows: DataFrame, key: tuple[str, ...], timed: bool) -> DataFrame:
    owner = [] if "account_id" in key else ["account_id"]
    item = ["n", "shares", "product_id", *(["fact_time"] if timed else [])]
    return rows.repartition(*key).groupBy(*key, *owner, *item).agg(F.count(F.lit(1)).cast("int").alias("times"))


def _in_rows(rows: DataFrame, key: tuple[str, ...], timed: bool, floor: int) -> DataFrame:
    """A row for each basket: its items by number, or by time, with the number of those below `floor` and the most `times`."""
    item, owner = F.struct("n", "times", "shares"), F.min("account_id").alias("_owner")
    shared = [owner, F.max("times").alias("most")]
    if timed:
        moments = rows.groupBy(*key, "fact_time").agg(*shared, F.collect_list(item).alias("at"))
        found = moments.groupBy(*key).agg(F.min("_owner").alias("_owner"), F.max("most").alias("most"), F.sort_array(F.collect_list(F.struct("fact_time", "at"))).alias("items"))
        kept = found.withColumn("below", F.lit(0))
    else:
        below = F.sum((F.col("n") < floor).cast("int")).cast("int").alias("below")
        kept = rows.groupBy(*key).agg(*shared, below, F.sort_array(F.collect_list(item)).alias("items"))
    return kept.where(F.size("items") > 1).select(F.col("_owner").alias("account_id"), "items", "below", "most")


def _lists(baskets: Baskets, k: int, mine: Column) -> DataFrame:
    """Partners of each product (`mine` chooses by number `n`) in each basket of source k: numbers `pids`, and row pairs `times` * `ns`."""
    rows = baskets.small[k]
    if baskets.timed:
        days = rows.select("account_id", "most", F.posexplode("items").alias("place", "day"), "items")
        later = days.select("account_id", "most", "day", F.flatten(F.slice(F.col("items.at"), F.col("place") + 2, F.size("items"))).alias("rest"))
        ones = later.where(F.size("rest") > 0).select("account_id", "most", F.explode("day.at").alias("one"), F.col("rest.n").alias("pids"), F.col("rest.times").alias("ns"))
    else:
        # Pairs of two products below the floor count for the range of scores only, so one side will do.
        start = F.when(F.col("one.n") < baskets.floor, F.col("place") + 2).otherwise(F.col("below") + 1)
        ones = rows.select("account_id", "most", "below", F.posexplode("items").alias("place", "one"), "items")
        part = lambda c: F.slice(F.col(f"items.{c}"), start, F.size("items"))
        ones = ones.select("account_id", "most", "one", part("n").alias("pids"), part("times").alias("ns"))
    own = ones.select("account_id", F.col("one.n").alias("n"), F.col("one.shares").alias("shares"), F.col("one.times").alias("times"), "pids", F.when(F.col("most") > 1, F.col("ns")).alias("ns"))
    own = own.where(mine & (F.size("pids") > 0))
    if baskets.dealt:
        each = own.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        several = F.col("shares") > 1
        fits = lambda pid: pairs._share(pid, F.col("shares")) == F.col("share")
        met = F.arrays_zip("pids", F.coalesce("ns", F.array_repeat(F.lit(1), F.size("pids"))).alias("ns"))
        chosen = each.withColumn("met", F.when(several, F.filter(met, lambda x: fits(x["pids"]))).otherwise(met))
        own = chosen.select("account_id", "n", "share", "times", F.col("met.pids").alias("pids"), F.col("met.ns").alias("ns"))
    else:
        own = own.select("account_id", "n", F.lit(0).alias("share"), "times", "pids", "ns")
    if baskets.large[k] is None:
        return own
    return own.unionByName(_lists_of_large(baskets, k, mine))


def _lists_of_large(baskets: Baskets, k: int, mine: Column) -> DataFrame:
    rows = baskets.large[k]
    key = pairs.CUSTOMER if "customer_id" in rows.columns else pairs.DEVICE
    renamed = {c: f"_{c}" for c in key}
    rows = rows.withColumns({new: F.col(old) for old, new in renamed.items()})
    item = ["n", "product_id", "account_id", "times", "shares", *(["fact_time"] if baskets.timed else [])]
    one, two = F.col("n1"), F.col("n2")
    if baskets.timed:
        fits, owner = (one != two) & (F.col("fact_time1") < F.col("fact_time2")), F.col("account_id1")
    else:
        fits = (one != two) & ((two >= baskets.floor) | (one < two))
        owner = F.when(F.col("product_id1") < F.col("product_id2"), F.col("account_id1")).otherwise(F.col("account_id2"))
    met = pairs._pairs_of_large(rows, tuple(renamed.values()), item, fits)
    return met.select(
        owner.alias("account_id"), F.col("n1").alias("n"), pairs._share(two, F.col("shares1")).alias("share"), F.col("times1").alias("times"),
        F.array(two).alias("pids"), F.array("times2").alias("ns"),
    ).where(mine)


def counted(baskets: Baskets, turn: int, minimum_count: int = 1, by: str = "sum", only: DataFrame | None = None, size: int | None = None) -> DataFrame:
    """(account_id, lookup_key, product_id, score) of the keys of one round, or those of them in `only`; products are numbers.

    Scores as `pairs.merged` gives them: a pair needs `minimum_count` within a source to count there. Rows of one key lie
    in one task, but for those of products with several shares. With `size`, pairs may be left out that are not among the
    `size` best of their key, if the range of scores stays.
    """
    mine = F.lit(True) if baskets.rounds == 1 else F.pmod(F.xxhash64("n"), F.lit(baskets.rounds)) == turn
    lists = reduce(DataFrame.unionByName, [_lists(baskets, k, mine).withColumn("source", F.lit(k)) for k in range(len(baskets.small))])
    if only is not None:
        lists = lists.join(only.select(F.col("lookup_key").alias("n")), "n", "left_semi")
    tasks = max(1, -(-baskets.most // (baskets.rounds * pairs.PAIRS_A_TASK)))
    at = ["n", *(["share"] if baskets.dealt else [])]
    lists = lists.repartition(tasks, *at)
    if size is not None and by == "sum" and minimum_count <= 1 and all(rows is None for rows in baskets.large):
        return _contenders(lists, at, size)
    met = lists.select("account_id", *at, "source", "times", "ns", F.posexplode("pids").alias("i", "product_id"))
    rows = met.where(F.col("product_id") != F.col("n")).select("account_id", *at, "product_id", "source", (F.col("times") * F.coalesce(F.get("ns", F.col("i")), F.lit(1))).cast("bigint").alias("times"))
    sources = range(len(baskets.small))
    if minimum_count <= 1:
        found_in = [F.max((F.col("source") == k).cast("bigint")) for k in sources]
        score = {"sum": F.sum("times"), "source_count": reduce(Column.__add__, found_in)}[by]
        found = rows.groupBy("account_id", *at, "product_id").agg(score.alias("score"))
    else:
        each = rows.groupBy("account_id", *at, "product_id").agg(*[F.sum(F.when(F.col("source") == k, F.col("times")).otherwise(0)).alias(f"in_{k}") for k in sources])
        kept = [F.col(f"in_{k}") >= minimum_count for k in sources]
        worth = {"sum": lambda k: F.when(kept[k], F.col(f"in_{k}")).otherwise(0), "source_count": lambda k: kept[k].cast("bigint")}[by]
        found = each.where(reduce(Column.__or__, kept)).withColumn("score", reduce(Column.__add__, [worth(k) for k in sources]))
    return found.select("account_id", F.col("n").alias("lookup_key"), "product_id", "score")


def _contenders(lists: DataFrame, at: list[str], size: int) -> DataFrame:
    """`counted` without pairs of score 1 that have `size` others of score 1 above them: most pairs never become a row.

    In the sorted partners of a key a pair of score s stands s times in a row.
    """
    several = F.flatten(F.zip_with("pids", "ns", lambda pid, n: F.array_repeat(pid, n * F.col("times"))))
    pids = F.when(F.col("ns").isNull() & (F.col("times") == 1), F.col("pids")).when(F.col("ns").isNull(), F.flatten(F.array_repeat("pids", F.col("times")))).otherwise(several)
    every = lists.select("account_id", *at, pids.alias("pids")).groupBy("account_id", *at).agg(F.sort_array(F.flatten(F.collect_list("pids"))).alias("all"))
    others = every.select("account_id", *at, F.array_remove("all", F.col("n")).alias("all"))
    again = others.withColumn("again", F.filter("all", lambda pid, i: (i > 0) & (pid == F.get("all", i - 1))))
    once = again.withColumn("once", F.array_except("all", "again"))
    some = F.slice("once", F.greatest(F.size("once") - size, F.lit(0)) + 1, size)
    rows = once.select("account_id", *at, F.explode(F.concat(some, "again", F.array_distinct("again"))).alias("product_id"))
    counted = rows.groupBy("account_id", *at, "product_id").agg(F.count(F.lit(1)).alias("score"))
    return counted.select("account_id", F.col("n").alias("lookup_key"), "product_id", "score")


def best(baskets: Baskets, turn: int, size: int, minimum_count: int = 1, by: str = "sum") -> tuple[DataFrame, int | None, int | None]:
    """The `size` best partners of every key of a round, written (lookup_key, product_id, score, nth); and the range of all scores."""
    ends = Observation()
    seen = counted(baskets, turn, minimum_count, by, size=size).observe(ends, F.min("score").alias("low"), F.max("score").alias("high"))
    order = Window.partitionBy("lookup_key").orderBy(F.col("score").desc(), F.col("product_id").desc())
    fit = seen.where(F.col("product_id") >= baskets.floor).select("lookup_key", "product_id", "score")
    kept = materialise(fit.withColumn("nth", F.dense_rank().over(order)).where(F.col("nth") <= size), "first-look")
    return kept, ends.get["low"], ends.get["high"]
