"""From product pairs to SKU lists per lookup key."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.functions import filters, product_types
from vitrine.functions.filters import Fields, PairFilters
from vitrine.operators import neighbours, ranking
from vitrine.operators.numbers import numbered
from vitrine.operators.spread import spread
from vitrine.storage import materialise

LOOK = ("color", "image_link")
SHARES = 8


def _attribute(field: str) -> str:
    return f"attr_{field.lower()}"


def attribute_columns(dynamic_fields: list[str]) -> list[str]:
    return [_attribute(field) for field in dynamic_fields]


def _attributes(catalog: DataFrame, dynamic_fields: list[str], fields: Fields) -> list[Column]:
    return [filters.field_column(catalog, f, fields).alias(_attribute(f)) for f in dynamic_fields]


def _with_parsed_list(items: DataFrame, dynamic_fields: list[str]) -> DataFrame:
    """Product types parsed once per item, not once per pair."""
    if filters.PRODUCT_TYPE not in dynamic_fields:
        return items
    parsed = product_types.parse_list(F.col(_attribute(filters.PRODUCT_TYPE)))
    return items.withColumn(_attribute(filters.PRODUCT_TYPE_LIST), parsed)


def context_items(catalog: DataFrame, dynamic_fields: list[str], fields: Fields) -> DataFrame:
    """Distinct attributes of every item group, for the base-item side of dynamic filters."""
    items = catalog.select("item_group_id", *_attributes(catalog, dynamic_fields, fields)).distinct()
    return _with_parsed_list(items, dynamic_fields)


def recommendable(
    catalog: DataFrame,
    dynamic_fields: list[str],
    fields: Fields,
    bucketed: bool,
    cap: int = ranking.PAIR_LIMIT,
    of: tuple[str, ...] = (),
) -> DataFrame:
    """Highest SKU per look and attribute set, at most `cap`, the length of the lists, of each item group and attribute set.

    `of` are further key columns of the catalog's rows, such as the rendering that admits them.

    SKUs of one group with equal attributes share score and filter outcome, so
    those beyond the cap rank behind `cap` others in any list they could enter.
    """
    attributes = _attributes(catalog, dynamic_fields, fields)
    names = attribute_columns(dynamic_fields) + (["product_type"] if bucketed else [])
    product_type = [F.col("product_type")] if bucketed else []
    looks = (
        catalog.select(*of, "item_group_id", *LOOK, "id", *product_type, *attributes)
        .groupBy(*of, "item_group_id", *LOOK, *names)
        .agg(F.max("id").alias("id"))
    )
    order = Window.partitionBy(*of, "item_group_id", *names).orderBy(F.col("id").desc())
    kept = looks.withColumn("n", F.row_number().over(order)).where(F.col("n") <= cap).drop("n")
    return _with_parsed_list(kept, dynamic_fields)


def dynamic_condition(trees: list[dict]) -> Column:
    """Recommended item (columns attr_x) against base item (columns base.attr_x)."""
    condition = F.lit(True)
    for tree in trees:
        if tree["filters"]:
            condition = condition & filters.compile_tree(
                tree, lambda f: F.col(f"pair.`{_attribute(f)}`"), lambda f: F.col(f"base.`{_attribute(f)}`")
            )
    return condition


def against_base_item(sku_pairs: DataFrame, contexts: DataFrame, trees: list[dict]) -> DataFrame:
    """Keep rows for which some attribute set of the lookup key's group passes the dynamic filters.

    A semi-join: a lookup key with many attribute sets does not multiply rows.
    """
    condition = (F.col("pair.lookup_key") == F.col("base.item_group_id")) & dynamic_condition(trees)
    return sku_pairs.alias("pair").join(contexts.alias("base"), condition, "left_semi")


def collapsed(sku_pairs: DataFrame, bucketed: bool, per: tuple[str, ...] = (), look: tuple[str, ...] = LOOK) -> DataFrame:
    """Highest SKU among equal looks with equal score under one lookup key."""
    product_type = ["product_type"] if bucketed else []
    keys = [*per, "lookup_key", "score", *look, *product_type]
    return sku_pairs.groupBy(*keys).agg(F.max("id").alias("id"))


def attribute_sets(candidates: DataFrame, names: list[str], of: tuple[str, ...] = ()) -> DataFrame:
    """(product_id, *names, top, lane) of every product and attribute set: its highest SKU, and whether it fills a place.

    Highest SKUs of different looks are never collapsed into one. Of the sets whose highest SKUs share a look, one has
    lane 0 and the others a lane of their own. `of` are further key columns of the candidates.
    """
    sets = candidates.groupBy(*of, F.col("item_group_id").alias("product_id"), *names).agg(F.max(F.struct("id", *LOOK)).alias("top"))
    look = [*of, *[f"top.{c}" for c in LOOK], *(["product_type"] if "product_type" in names else [])]
    chosen = F.struct("top.id", "product_id", *names)
    first = sets.groupBy(*[F.col(c).alias(f"_{n}") for n, c in enumerate(look)]).agg(F.max(chosen).alias("chosen"))
    alike = [F.col(c).eqNullSafe(F.col(f"_{n}")) for n, c in enumerate(look)]
    lane = F.when(chosen.eqNullSafe(F.col("chosen")), F.lit(0).cast("long")).otherwise(F.xxhash64("product_id", "top.id", *names))
    return sets.join(first, reduce(Column.__and__, alike)).select(*of, "product_id", *names, "top", lane.alias("lane"))


def within_reach(set_pairs: DataFrame, bucketed: bool, per: tuple[str, ...] = (), limit: int = ranking.PAIR_LIMIT) -> DataFrame:
    """Attribute sets under a lookup key (in buckets: of each product type) whose SKUs can be among its `limit` best.

    Each set in lane 0 fills a place of its own with its highest SKU, whatever ties there are, and places go by score and
    id; so `limit` of them rule out all that come after (exact). Equal pairs of several accounts share a place. Spark
    applies the limit inside each task before the shuffle.
    """
    place = [*per, "lookup_key", *(["product_type"] if bucketed else []), "lane"]
    best = Window.partitionBy(*place).orderBy(F.col("score").desc(), F.col("top.id").desc())
    return set_pairs.withColumn("nth", F.dense_rank().over(best)).where(F.col("nth") <= limit).drop("nth", "lane")


def sku_lists(
    sku_pairs: DataFrame, bucketed: bool, per: tuple[str, ...] = (), limit: int = ranking.PAIR_LIMIT, look: tuple[str, ...] = LOOK
) -> DataFrame:
    """Top SKUs per lookup key (and product-type bucket)."""
    rows = collapsed(sku_pairs, bucketed, per, look)
    partition = [*per, "lookup_key"]
    if bucketed:
        rows, partition = ranking.exploded(rows), [*partition, ranking.BUCKET]
    return ranking.ranked_pairs(rows, partition, limit).select(*partition, "id", "rank", "score")


def explode_pairs(
    pairs: DataFrame,
    catalog: DataFrame,
    strategy_filters: PairFilters,
    global_filters: PairFilters,
    fields: Fields,
    per: tuple[str, ...] = (),
    limit: int = ranking.PAIR_LIMIT,
) -> DataFrame:
    """Scored product pairs to ranked SKU lists of `limit` places, under the strategy's and the account's filters."""
    both = (strategy_filters, global_filters)
    bucketed, dynamic_fields = any(f.bucketed for f in both), _dynamic_fields([both])

    def passing(rows: DataFrame) -> DataFrame:
        if not dynamic_fields:
            return rows
        return against_base_item(rows, context_items(catalog, dynamic_fields, fields), [f.dynamic for f in both])

    return _lists(pairs, static_part(catalog, *both, fields), dynamic_fields, fields, bucketed, passing, per, (), limit)


Renderings = list[tuple[PairFilters, PairFilters]]


def explode_pairs_for_many(
    pairs: DataFrame, catalog: DataFrame, renderings: Renderings, fields: Fields, bucketed: bool, limit: int = ranking.PAIR_LIMIT
) -> DataFrame:
    """The lists of every rendering (strategy's and account's filters) at once, with its number in column `rendering`.

    Renderings are rows, not plans: each SKU is copied to those that admit it, and all that follows has the number in its
    keys. All must be with buckets, or all without.
    """
    dynamic_fields = _dynamic_fields(renderings)

    def passing(rows: DataFrame) -> DataFrame:
        return against_base_item_for_many(rows, context_items(catalog, dynamic_fields, fields), renderings) if dynamic_fields else rows

    return _lists(pairs, admitted(catalog, renderings, fields), dynamic_fields, fields, bucketed, passing, (), ("rendering",), limit)


def _dynamic_fields(renderings: Renderings) -> list[str]:
    return sorted({field for both in renderings for part in both for field in part.dynamic_fields})


def admitted(catalog: DataFrame, renderings: Renderings, fields: Fields) -> DataFrame:
    """Catalog rows once for each rendering whose static filters they pass, with its number in column `rendering`."""
    tests = [[part.static for part in both if part.static["filters"]] for both in renderings]
    rows = spread(catalog, "item_group_id", *LOOK, copies=len(renderings))
    numbers = filters.passing(tests, lambda f: filters.field_column(rows, f, fields))
    return rows.withColumn("rendering", F.explode(numbers))


def against_base_item_for_many(sku_pairs: DataFrame, contexts: DataFrame, renderings: Renderings) -> DataFrame:
    """`against_base_item` under the dynamic filters of each row's rendering; those without any pass."""
    trees = {n: [part.dynamic for part in both] for n, both in enumerate(renderings) if any(part.dynamic["filters"] for part in both)}
    own = F.col("pair.rendering")
    chosen = reduce(lambda c, n: c.when(own == n, dynamic_condition(trees[n])), trees, F.when(F.lit(False), F.lit(True)))
    condition = (F.col("pair.lookup_key") == F.col("base.item_group_id")) & chosen
    tested = F.col("rendering").isin(list(trees))
    kept = sku_pairs.where(tested).alias("pair").join(contexts.alias("base"), condition, "left_semi")
    return kept.unionByName(sku_pairs.where(~tested)) if len(trees) < len(renderings) else kept


def _lists(
    pairs: DataFrame,
    allowed: DataFrame,
    dynamic_fields: list[str],
    fields: Fields,
    bucketed: bool,
    passing: Callable[[DataFrame], DataFrame],
    per: tuple[str, ...],
    of: tuple[str, ...],
    limit: int,
) -> DataFrame:
    """Pairs first meet the attribute sets of their products, which decide on dynamic filters and on what a list can hold;
    only the sets that stay are exploded to SKUs. A best-seller stands in most lists; its pairs are dealt over SHARES
    keys, and its sets and SKUs copied to each."""
    names = attribute_columns(dynamic_fields) + (["product_type"] if bucketed else [])
    candidates = recommendable(allowed, dynamic_fields, fields, bucketed, limit, of)
    sets = _with_parsed_list(attribute_sets(candidates, names, of), dynamic_fields)
    every = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))
    dealt = pairs.withColumn("share", F.pmod(F.xxhash64("lookup_key"), F.lit(SHARES)).cast("int"))
    spread = sets.withColumn("share", every)
    keys = (*per, *of)
    if not bucketed:
        skus = candidates.withColumnRenamed("item_group_id", "product_id").withColumn("share", every)
        return sku_lists(_passing_from_the_top(dealt, skus, passing, names, per, of, limit), bucketed, keys, limit)
    rows = passing(dealt.join(spread, ["product_id", "share"]))
    kept = within_reach(rows, bucketed, keys, limit).select(*keys, "lookup_key", "product_id", "share", "score", *names)
    shared = [*of, *names]
    own = candidates.select(F.col("item_group_id").alias("_product"), F.col("id"), *LOOK, *[F.col(n).alias(f"_{n}") for n in shared], every.alias("_share"))
    same = [F.col("product_id") == F.col("_product"), F.col("share") == F.col("_share"), *[F.col(n).eqNullSafe(F.col(f"_{n}")) for n in shared]]
    return sku_lists(kept.join(own, reduce(Column.__and__, same)), bucketed, keys, limit)


FIRST_LOOK = 2  # how many times the length of a list is tested against the base item first


def _passing_from_the_top(
    pairs: DataFrame, skus: DataFrame, passing: Callable[[DataFrame], DataFrame], names: list[str], per: tuple[str, ...], of: tuple[str, ...], limit: int
) -> DataFrame:
    """SKUs that pass the dynamic filters, without testing those of products far down a list that is full above.

    The best FIRST_LOOK * limit products of each lookup key are tested first. A product's highest SKU has its score, and
    products go by score and highest id, so all SKUs of the products left out come after `bound`, the last product tested.
    Where SKUs that do not come after it pass for `limit` places, which are scores and looks, the list is full; the others,
    but for short lists whose products were all tested, are tested on. SKUs of one score, look and attribute set under a key
    pass together and share a place, so the highest is tested for all.
    """
    key, size, product = [*per, *of, "lookup_key"], FIRST_LOOK * limit, [*of, "product_id", "share"]
    tops = skus.groupBy(*product).agg(F.max("id").alias("top_id"))
    order = Window.partitionBy(*key).orderBy(F.col("score").desc(), F.col("top_id").desc())
    parsed = _attribute(filters.PRODUCT_TYPE_LIST)

    def highest(known: DataFrame) -> DataFrame:
        rows = known.join(skus.drop(parsed), product)
        kept = rows.groupBy(*key, "score", *LOOK, *names).agg(F.max("id").alias("id"))
        return passing(_with_parsed_list(kept, [filters.PRODUCT_TYPE] if parsed in skus.columns else []))

    known = pairs.join(tops, ["product_id", "share"]).select(*key, "product_id", "share", "score", "top_id")
    known = materialise(known, "known-pairs")
    first = materialise(known.withColumn("nth", F.dense_rank().over(order)).where(F.col("nth") <= size), "first-look")
    passed = materialise(highest(first.drop("top_id", "nth")), "first-passed")
    bounds = first.groupBy(*key).agg(F.min(F.struct("score", "top_id")).alias("bound"), F.max("nth").alias("tested"))
    above = F.struct("score", F.col("id").alias("top_id")) >= F.col("bound")
    places = passed.join(bounds, key).where(above).groupBy(*key).agg(F.countDistinct("score", F.struct(*LOOK)).alias("n"))
    full = places.where(F.col("n") >= limit).select(*key)
    left = materialise(bounds.where(F.col("tested") >= size).join(full, key, "left_anti").select(*key, "bound"), "lists-left")
    rest = known.join(left, key).where(F.struct("score", "top_id") < F.col("bound"))
    return passed.unionByName(highest(rest.drop("top_id", "bound")))


def lists_of_baskets(
    sources: list[tuple[DataFrame, tuple[str, ...]]],
    timed: bool,
    catalog: DataFrame,
    strategy_filters: PairFilters,
    global_filters: PairFilters,
    fields: Fields,
    minimum_count: int = 1,
    by: str = "sum",
    limit: int = ranking.PAIR_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """What `explode_pairs` makes of all pairs of the baskets, without buckets, and the range of the pairs' scores (low, high).

    As in `_passing_from_the_top`, the best products of a key are tested first, and all of its pairs only where these leave
    places that a product left out could take. Products, SKUs and looks are numbers until the lists are done; the order of
    the products is that of their highest SKUs. Keys go through in the rounds of `neighbours`.
    """
    both = (strategy_filters, global_filters)
    dynamic_fields = _dynamic_fields([both])
    names, size, parsed = attribute_columns(dynamic_fields), FIRST_LOOK * limit, [f for f in dynamic_fields if f == filters.PRODUCT_TYPE]
    candidates = recommendable(static_part(catalog, *both, fields), dynamic_fields, fields, False, limit).drop(_attribute(filters.PRODUCT_TYPE_LIST))
    candidates = materialise(candidates, "candidates")
    ids, _ = numbered(candidates.select("id").distinct(), [F.col("id")], "sku-numbers")
    looks, _ = numbered(candidates.select(*LOOK).distinct(), [F.col(c) for c in LOOK], "look-numbers")
    alike = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LOOK]
    looks = looks.select(F.col("n").alias("look"), *[F.col(c).alias(f"_{c}") for c in LOOK])
    skus = candidates.join(ids.withColumnRenamed("n", "sku"), "id").join(looks, reduce(Column.__and__, alike))
    skus = materialise(skus.select(F.col("item_group_id").alias("product"), "sku", "look", *names), "skus")

    sold = reduce(DataFrame.unionByName, [rows.select("product_id") for rows, _ in sources]).where(F.col("product_id").isNotNull()).distinct()
    tops = skus.groupBy(F.col("product").alias("product_id")).agg(F.max("sku").alias("top"))
    products, number = numbered(sold.join(tops, "product_id", "left"), [F.col("top").asc_nulls_first(), F.col("product_id")], "product-numbers")
    floor = products.where(F.col("top").isNull()).count()
    own = skus.join(products.select(F.col("product_id").alias("product"), F.col("n").alias("product_id")), "product").drop("product")
    own = materialise(own, "numbered-skus").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    contexts = None
    if dynamic_fields:
        plain = catalog.select("item_group_id", *_attributes(catalog, dynamic_fields, fields)).distinct()
        at = products.select(F.col("product_id").alias("item_group_id"), "n")
        contexts = materialise(plain.join(at, "item_group_id").drop("item_group_id").withColumnRenamed("n", "item_group_id"), "base-items")

    def lists(known: DataFrame) -> DataFrame:
        dealt = known.withColumn("share", F.pmod(F.xxhash64("lookup_key"), F.lit(SHARES)).cast("int"))
        rows = dealt.join(own, ["product_id", "share"]).select("lookup_key", "score", "look", "sku", *names)
        # All that follows is by key: dealt out once.
        kept = rows.repartition("lookup_key").groupBy("lookup_key", "score", "look", *names).agg(F.max("sku").alias("id"))
        if contexts is not None:
            kept = against_base_item(_with_parsed_list(kept, parsed), _with_parsed_list(contexts, parsed), [f.dynamic for f in both])
        return sku_lists(kept, False, (), limit, ("look",))

    baskets, found, ends = neighbours.gathered(sources, timed, products, floor), [], []
    for turn in range(baskets.rounds):
        first, *end = neighbours.best(baskets, turn, size, minimum_count, by)
        ends += [e for e in end if e is not None]
        short = materialise(lists(first.drop("nth")), "short-lists")
        last = first.groupBy("lookup_key").agg(F.min(F.struct("score", "product_id")).alias("last"), F.max("nth").alias("tested")).where(F.col("tested") >= size)
        bound = last.join(products.select(F.col("n").alias("_n"), "top"), F.col("last.product_id") == F.col("_n")).select("lookup_key", F.struct(F.col("last.score").alias("score"), F.col("top").alias("id")).alias("bound"))
        full = short.where(F.col("rank") == limit).join(bound, "lookup_key").where(F.struct("score", "id") >= F.col("bound")).select("lookup_key")
        left = materialise(last.select("lookup_key").join(full, "lookup_key", "left_anti"), "lists-left")
        if left.isEmpty():
            found.append(short)
            continue
        every = neighbours.counted(baskets, turn, minimum_count, by, left).where(F.col("product_id") >= floor)
        found += [short.join(left, "lookup_key", "left_anti"), materialise(lists(every.select("lookup_key", "product_id", "score")), "long-lists")]
    done = reduce(DataFrame.unionByName, found).withColumnRenamed("id", "sku").withColumnRenamed("lookup_key", "n")
    named = done.join(products.select("n", F.col("product_id").alias("lookup_key")), "n").join(ids.withColumnRenamed("n", "sku"), "sku")
    low, high = (f(ends, default=None) for f in (min, max))
    return named.select("lookup_key", "id", "rank", "score"), catalog.sparkSession.range(1).select(F.lit(low).cast("bigint").alias("low"), F.lit(high).cast("bigint").alias("high"))


def static_part(catalog: DataFrame, first: PairFilters, second: PairFilters, fields: Fields) -> DataFrame:
    """Catalog rows that pass both static filters."""
    for part in (first, second):
        if part.static["filters"]:
            catalog = catalog.where(
                filters.compile_tree(part.static, lambda f: filters.field_column(catalog, f, fields))
            )
    return catalog
