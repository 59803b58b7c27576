"""Similar products by weighted agreement of catalog attributes.

Every in-stock SKU is compared with every in-stock SKU of another item group:
each attribute on which both agree adds its weight. All pairs count, also those
that agree on nothing, so a pair table would be quadratic. It is never built.

Instead SKUs are indexed by every subset of attributes they could agree on
("mask") together with the values there. Under a mask, only a bounded number of
candidates can ever reach a top list, whatever the size of the catalog:

* Among SKUs of one look, a candidate matters only if it is the highest id that
  differs from the base item on all other attributes and on the item group.
  With j such conditions open, `_survivors(j)` candidates are enough: any choice
  of base item rules out at most j * _survivors(j - 1) of them.
* Looks below rank 2 * limit by their highest id lie behind `limit` others in
  every list they could enter (an item group holds at most `limit` looks, so
  leaving out the base item's own group costs no more than that).

Of SKUs with one look and equal attributes, the best two of different groups
stand for all, whatever the base item: so rows are cut to the number of looks
and attribute tuples before they are copied to masks.

The second point needs weights that are not negative; negative ones are refused,
and so are more than MOST_ATTRIBUTES attributes.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.functions import filters
from vitrine.functions.filters import Fields, PairFilters
from vitrine.functions.scores import RATIO_TYPE, ratio
from vitrine.operators import collab, ranking
from vitrine.storage import materialise

# Fields stored as columns although no filter may use them.
DATED_FIELDS = frozenset(
    {"availability_date", "sale_price_effective_date_begin", "sale_price_effective_date_end"}
)
SALTS = 64
ROWS_A_TASK = 1_000_000
# With more, row limits exceed what Spark prunes before a shuffle (`_survivors` of six conditions is 1957).
MOST_ATTRIBUTES = 4

Weights = tuple[tuple[str, float | None], ...]


def usable_weights(weights: Weights, fields: Fields) -> Weights:
    """Weights of attributes the catalog has. No weight, or 0, means inverse frequency."""
    usable = tuple((name, weight or None) for name, weight in weights if name in fields)
    if not usable:
        raise ValueError("no attribute weight applies to this catalog")
    if len(usable) > MOST_ATTRIBUTES:
        raise ValueError(f"similarity takes {MOST_ATTRIBUTES} attributes at most, {len(usable)} are weighted: the work doubles with each")
    if any(weight is not None and weight < 0 for _, weight in usable):
        raise ValueError("attribute weights must not be negative")
    return usable


def _value(catalog: DataFrame, name: str, fields: Fields) -> Column:
    column = catalog[name] if name in DATED_FIELDS else filters.field_column(catalog, name, fields)
    return column.cast("string")


def _names(weights: Weights) -> list[str]:
    return [f"a{n}" for n in range(len(weights))]


def attribute_sets(stock: DataFrame, weights: Weights, fields: Fields) -> DataFrame:
    """(item_group_id, a0.., count of SKUs): the attribute values found in each item group."""
    values = [_value(stock, name, fields).alias(a) for a, (name, _) in zip(_names(weights), weights)]
    known = stock.where(F.col("item_group_id").isNotNull())
    return known.select("item_group_id", *values).groupBy("item_group_id", *_names(weights)).agg(
        F.count(F.lit(1)).alias("skus")
    )


def weighted_tuples(sets: DataFrame, weights: Weights) -> DataFrame:
    """Distinct attribute tuples with the weight (w0..) each of their values carries."""
    names = _names(weights)
    tuples = sets.groupBy(*names).agg(F.sum("skus").alias("skus"))
    plain = tuples
    for n, (a, (_, weight)) in enumerate(zip(names, weights)):
        if weight is not None:
            tuples = tuples.withColumn(f"w{n}", F.lit(str(weight)).cast(RATIO_TYPE))
        else:
            shares = plain.where(F.col(a).isNotNull()).groupBy(a).agg(
                ratio(F.lit(1), F.sum("skus")).alias(f"w{n}")
            )
            tuples = tuples.join(shares, a, "left")
    return tuples.select(_tuple_key(names), *names, *[f"w{n}" for n in range(len(names))])


def _tuple_key(names: list[str]) -> Column:
    return F.to_json(F.struct(*names)).alias("tuple_key")


def _by_mask(df: DataFrame, names: list[str], carry: list[str]) -> DataFrame:
    """One row per subset of non-null attributes: `mask` and the values there (k0.., '' elsewhere)."""
    options = []
    for mask in range(1 << len(names)):
        inside = [a for n, a in enumerate(names) if mask >> n & 1]
        present = F.lit(True)
        for a in inside:
            present = present & F.col(a).isNotNull()
        keys = [
            (F.col(a) if a in inside else F.lit("")).alias(f"k{n}") for n, a in enumerate(names)
        ]
        options.append(F.when(present, F.struct(F.lit(mask).alias("mask"), *keys)))
    exploded = df.select(*carry, F.explode(F.array_compact(F.array(*options))).alias("at"))
    return exploded.select(*carry, "at.*")


def _keys(names: list[str]) -> list[str]:
    return ["mask", *[f"k{n}" for n in range(len(names))]]


def _copies() -> Column:
    """Into how many shares the rows of a mask are cut: the fewer attributes, the hotter its keys."""
    return F.when(F.col("mask") == 0, F.lit(SALTS)).when(F.bit_count("mask") == 1, F.lit(8)).otherwise(F.lit(1))


def _join_by_mask(many: DataFrame, spread_by: str, few: DataFrame, names: list[str], tasks: int | None = None) -> DataFrame:
    """Join on mask and values; hot keys of `many` are cut into shares and the rows of `few` copied to each.

    With `tasks` the keys are dealt out over so many, however few bytes the two sides have.
    """
    on = [*_keys(names), "share"]
    left = many.withColumn("share", F.pmod(F.hash(spread_by), _copies()))
    right = few.withColumn("share", F.explode(F.sequence(F.lit(0), _copies() - 1)))
    if tasks:
        left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    return left.join(right, on).drop("share")


def _meeting(many: DataFrame, few: DataFrame, names: list[str]) -> int:
    """Rows that `_join_by_mask` forms."""
    keys = _keys(names)
    sizes = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("many")).join(few.groupBy(*keys).agg(F.count(F.lit(1)).alias("few")), keys)
    return sizes.agg(F.sum(F.col("many") * F.col("few"))).first()[0] or 0


def _score(names: list[str], mask: int) -> Column:
    total = F.lit("0").cast("decimal(24,6)")
    for n, _ in enumerate(names):
        if mask >> n & 1:
            total = total + F.col(f"w{n}")
    return total.cast("decimal(24,6)")


def _exactly(mask: int, names: list[str]) -> Column:
    """Of the numbers n0.. agreeing on at least a mask, the number agreeing on exactly this one."""
    total = F.lit(0)
    for larger in range(1 << len(names)):
        if larger & mask == mask:
            sign = -1 if bin(larger ^ mask).count("1") % 2 else 1
            total = total + F.lit(sign) * F.col(f"n{larger}")
    return total


def _per_mask(rows: DataFrame, by: list[str], number: Column, names: list[str]) -> DataFrame:
    """Numbers of the masks as columns n0.., one row per `by`."""
    masks = range(1 << len(names))
    return rows.groupBy(*by).agg(*[F.coalesce(F.sum(F.when(F.col("mask") == m, number)), F.lit(0)).alias(f"n{m}") for m in masks])


def score_range(sets: DataFrame, tuples: DataFrame, weights: Weights) -> DataFrame:
    """One row (low, high): extreme scores over all pairs of different item groups.

    How many SKU sets agree with a tuple on exactly a given subset follows from
    the numbers agreeing on at least each larger one (inclusion-exclusion), so
    counts per mask suffice and no pair is formed.

    The sets of an item group itself do not count. Where more sets agree than
    the smallest group with the tuple has, one of another group is among them;
    only for other tuples (rare ones) the sets of each group are subtracted.
    """
    names = _names(weights)
    masks = range(1 << len(names))
    sizes = sets.groupBy("item_group_id").agg(F.count(F.lit(1)).alias("size"))
    held = sets.join(sizes, "item_group_id").groupBy(*names).agg(F.count(F.lit(1)).alias("held"), F.min("size").alias("smallest"))
    rows = _by_mask(held.withColumn("tuple_key", _tuple_key(names)), names, ["tuple_key", "smallest", "held"])
    everywhere = rows.groupBy(*_keys(names)).agg(F.sum("held").alias("all"))
    counts = _per_mask(_join_by_mask(rows, "tuple_key", everywhere, names), ["tuple_key", "smallest"], F.col("all"), names)
    exact = materialise(counts.select("tuple_key", "smallest", *[_exactly(m, names).alias(f"e{m}") for m in masks]), "agreeing")

    def few(m: int) -> Column:
        return (F.col(f"e{m}") > 0) & (F.col(f"e{m}") <= F.col("smallest"))

    rare = exact.where(F.array_contains(F.array(*[few(m) for m in masks]), True)).select("tuple_key", *[f"e{m}" for m in masks])
    keyed = sets.withColumn("tuple_key", _tuple_key(names))
    asked = keyed.join(rare.select("tuple_key"), "tuple_key", "left_semi")
    around = keyed.join(asked.select("item_group_id").distinct(), "item_group_id", "left_semi")
    inside = _by_mask(around, names, ["item_group_id"]).groupBy(*_keys(names), "item_group_id").agg(F.count(F.lit(1)).alias("own"))
    own = _by_mask(asked, names, ["item_group_id", "tuple_key"]).join(inside, [*_keys(names), "item_group_id"])
    others = _per_mask(own, ["item_group_id", "tuple_key"], F.col("own"), names).join(rare, "tuple_key")

    sure = exact.select("tuple_key", *[(F.col(f"e{m}") > F.col("smallest")).alias(f"there{m}") for m in masks])
    found = others.select("tuple_key", *[(F.col(f"e{m}") > _exactly(m, names)).alias(f"there{m}") for m in masks])
    there = sure.unionByName(found).groupBy("tuple_key").agg(*[F.max(f"there{m}").alias(f"there{m}") for m in masks])
    both = there.join(tuples.drop(*names), "tuple_key")
    scores = F.array(*[F.when(F.col(f"there{m}"), _score(names, m)) for m in masks])
    return both.agg(F.min(F.array_min(scores)).alias("low"), F.max(F.array_max(scores)).alias("high"))


def _survivors(open_conditions: int) -> int:
    return 1 if open_conditions == 0 else open_conditions * _survivors(open_conditions - 1) + 1


def candidates(sets: DataFrame, looks: DataFrame, side: list[str], names: list[str], limit: int) -> DataFrame:
    """Bounded candidate lists per mask, values and `side` (attributes of dynamic filters).

    Every step is a row limit within a window, which Spark applies inside each
    task before it shuffles. So no task ever gathers the whole of a hot list,
    such as the one under the mask of no attributes, to which every SKU belongs.
    """
    look = list(collab.LOOK)
    place = [*_keys(names), *side]
    differ = ["item_group_id", *names]
    alike = Window.partitionBy(*names, *look, *side).orderBy(F.col("id").desc())
    two = sets.join(looks, "item_group_id").withColumn("n", F.row_number().over(alike)).where(F.col("n") <= _survivors(1))
    rows = _by_mask(materialise(two, "two-of-a-kind"), names, [*differ, *look, *side, "id"])
    for size in range(len(differ), -1, -1):
        for fixed in combinations(differ, size):
            order = Window.partitionBy(*place, *look, *fixed).orderBy(F.col("id").desc())
            keep = _survivors(len(differ) - size)
            rows = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep)
    rows = rows.withColumn("best", F.max("id").over(Window.partitionBy(*place, *look)))
    by_best = Window.partitionBy(*place).orderBy(F.col("best").desc())
    return rows.withColumn("n", F.dense_rank().over(by_best)).where(F.col("n") <= 2 * limit).drop("n", "best")


def _best_per_tuple(tuples: DataFrame, lists: DataFrame, side: list[str], names: list[str], limit: int) -> DataFrame:
    """Top rows of every tuple with room to leave out any one item group; `place` and, within it, `nth` (1 or 2) number them.

    Tuples and candidates are few bytes but meet in many rows: these are dealt out, ROWS_A_TASK a task. Of a look under one
    mask the best two groups will do (a group has one SKU of a look and `side`); Spark cuts to them before the shuffle.
    """
    look = list(collab.LOOK)
    weights = [f"w{n}" for n in range(len(names))]
    base = _by_mask(tuples, names, ["tuple_key", *names, *weights])
    found = lists.select(
        *_keys(names), "item_group_id", *look, *side, "id", *[F.col(a).alias(f"b{n}") for n, a in enumerate(names)]
    )
    agreed = F.lit(0)
    for n, a in enumerate(names):
        agreed = agreed + F.when(F.col(a) == F.col(f"b{n}"), F.lit(1 << n)).otherwise(F.lit(0))
    score = F.lit(None).cast("decimal(24,6)")
    for mask in range(1 << len(names)):
        score = F.when(F.col("mask") == mask, _score(names, mask)).otherwise(score)
    tasks = max(1, -(-_meeting(base, found, names) // ROWS_A_TASK))
    rows = _join_by_mask(base, "tuple_key", found, names, tasks).where(agreed == F.col("mask"))
    alike = Window.partitionBy("tuple_key", "mask", *side, *look).orderBy(F.col("id").desc(), F.col("item_group_id").desc())
    rows = rows.withColumn("n", F.dense_rank().over(alike)).where(F.col("n") <= 2).withColumn("score", score)
    rows = rows.groupBy("tuple_key", *side, "score", *look, "item_group_id").agg(F.max("id").alias("id"))

    of_tuple = ["tuple_key", *side]
    per_group = Window.partitionBy(*of_tuple, "item_group_id").orderBy(F.col("score").desc(), F.col("id").desc())
    per_key = Window.partitionBy(*of_tuple, "score", *look)
    rows = rows.withColumn("n", F.row_number().over(per_group)).where(F.col("n") <= limit)
    rows = rows.withColumn("nth", F.row_number().over(per_key.orderBy(F.col("id").desc()))).where(F.col("nth") <= 2)
    rows = rows.withColumn("best", F.max("id").over(per_key))
    overall = Window.partitionBy(*of_tuple).orderBy(F.col("score").desc(), F.col("best").desc())
    return rows.withColumn("place", F.dense_rank().over(overall)).where(F.col("place") <= 2 * limit).drop("n", "best")


def _met(best: DataFrame, lookups: DataFrame, limit: int) -> DataFrame:
    """Every lookup key beside the rows of its tuples that can be in its list.

    An item group that stands in the rows of one of its tuples is left out there, which needs all of them; for the others
    the first SKU of each of the first `limit` places will do. Lookup keys are dealt out before rows are added, ROWS_A_TASK
    a task; so lists are made where their rows arise.
    """
    standing = best.select("tuple_key", F.col("item_group_id").alias("lookup_key"), F.lit(True).alias("stands")).distinct()
    first = best.where((F.col("nth") == 1) & (F.col("place") <= limit))
    asking = lookups.groupBy("tuple_key").agg(F.count(F.lit(1)).alias("keys"))
    rows = asking.join(first.groupBy("tuple_key").agg(F.count(F.lit(1)).alias("rows")), "tuple_key").agg(F.sum(F.col("keys") * F.col("rows"))).first()[0]
    dealt = lookups.repartition(max(1, -(-(rows or 0) // ROWS_A_TASK)), "lookup_key").join(standing, ["tuple_key", "lookup_key"], "left")
    both = best.withColumn("stands", F.lit(True)).unionByName(first.withColumn("stands", F.lit(False))).drop("place", "nth")
    found = dealt.withColumn("stands", F.coalesce("stands", F.lit(False))).join(both, ["tuple_key", "stands"])
    return found.where(F.col("lookup_key") != F.col("item_group_id")).drop("stands")


def similar_skus(
    stock: DataFrame,
    fresh: DataFrame,
    weights: Weights,
    strategy_filters: PairFilters,
    global_filters: PairFilters,
    fields: Fields,
    limit: int = ranking.PAIR_LIMIT,
) -> DataFrame:
    """Top SKUs by attribute agreement for every in-stock item group.

    `stock` are the in-stock SKUs that are compared, `fresh` the catalog the
    recommended SKUs and filters are taken from.
    """
    bucketed = strategy_filters.bucketed or global_filters.bucketed
    lists = similar_skus_for_many(stock, fresh, weights, [(strategy_filters, global_filters)], fields, bucketed, limit)
    return lists.drop("rendering")


def similar_skus_for_many(
    stock: DataFrame, fresh: DataFrame, weights: Weights, renderings: collab.Renderings, fields: Fields, bucketed: bool, limit: int = ranking.PAIR_LIMIT
) -> DataFrame:
    """The lists of every rendering (see `collab.explode_pairs_for_many`) from one comparison of the stock."""
    weights = usable_weights(weights, fields)
    names = _names(weights)
    dynamic_fields = sorted({f for both in renderings for part in both for f in part.dynamic_fields})
    side = ["rendering", *collab.attribute_columns(dynamic_fields), *(["product_type"] if bucketed else [])]

    sets = materialise(attribute_sets(stock, weights, fields), "attribute-sets")
    tuples = weighted_tuples(sets, weights)
    looks = collab.recommendable(collab.admitted(fresh, renderings, fields), dynamic_fields, fields, bucketed, limit, ("rendering",))
    lists = materialise(candidates(sets.drop("skus"), looks, side, names, limit), "candidates")
    best = materialise(_best_per_tuple(tuples, lists, side, names, limit), "best-per-tuple")

    lookups = sets.select(F.col("item_group_id").alias("lookup_key"), _tuple_key(names))
    rows = _met(best, lookups, limit)
    if dynamic_fields:
        rows = collab.against_base_item_for_many(rows, collab.context_items(fresh, dynamic_fields, fields), renderings)
    return ranking.normalised(collab.sku_lists(rows, bucketed, ("rendering",)), score_range(sets, tuples, weights))
