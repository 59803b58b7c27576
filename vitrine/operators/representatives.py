"""Reducing a catalog to SKUs that look different."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.functions import filters
from vitrine.functions.product_types import trimmed_list_text
from vitrine.operators.spread import spread

VARIANT = ("item_group_id", "image_link", "color")
SKUS_PER_GROUP = 50


def merged_product_types(catalog: DataFrame, of: tuple[str, ...] = ()) -> DataFrame:
    """Highest SKU id and the joined product-type list of every visual variant.

    SKUs without product type are left out. The list follows SKU order. `of` are further key columns.
    """
    parts = catalog.where(F.col("product_type").isNotNull()).select(
        *of, *VARIANT, "id", trimmed_list_text(F.col("product_type")).alias("part")
    )
    lists = parts.groupBy(*of, *VARIANT).agg(
        F.max("id").alias("id"), F.array_sort(F.collect_list(F.struct("id", "part"))).alias("parts")
    )
    return lists.withColumn("product_type", F.array_join(F.col("parts.part"), ",")).drop("parts")


def variants(catalog: DataFrame, late_filters: list[dict]) -> DataFrame:
    """Highest SKU id of every visual variant whose merged product types pass the filters.

    Where the conditions hold for a list exactly when they hold for one of its
    parts, they are folded as booleans during aggregation and no list is ever
    gathered; otherwise the merged text is built and tested.
    """
    trees = [tree for tree in late_filters if tree["filters"]]
    listed = catalog.where(F.col("product_type").isNotNull())
    if not all(filters.splits_over_lists(tree) for tree in trees):
        texts = merged_product_types(catalog)
        for tree in trees:
            texts = texts.where(filters.compile_tree(tree, lambda _: F.col("product_type")))
        return texts.drop("product_type")

    tests = [filters.positive(leaf) for tree in trees for leaf in filters.leaves(tree)]
    part = trimmed_list_text(F.col("product_type"))
    flags = [
        F.max(filters.compile_tree(test, lambda _: part)).alias(f"test_{n}") for n, test in enumerate(tests)
    ]
    folded = listed.groupBy(*VARIANT).agg(F.max("id").alias("id"), *flags)
    for tree in trees:
        folded = folded.where(
            filters.compile_tree(
                tree,
                lambda _: F.lit(None),
                ready=lambda leaf: F.col(f"test_{tests.index(filters.positive(leaf))}"),
            )
        )
    return folded.select(*VARIANT, "id")


BITS = 63  # tests in one long


def variants_for_many(catalog: DataFrame, early: list[list[dict]], late: list[list[dict]], item: Callable[[str], Column]) -> DataFrame:
    """`variants` of every rendering at once, with its number in column `rendering`.

    Rendering n admits SKUs under the trees early[n] and variants under late[n]. All tests of late trees on a SKU are bits
    of a few longs, computed once per SKU before it is copied to the renderings that admit it, and folded by OR. If a
    tree depends on joined text, the texts are built instead; `needs_text` tells.
    """
    trees = [[tree for tree in some if tree["filters"]] for some in late]
    listed = spread(catalog.where(F.col("product_type").isNotNull()), *VARIANT, copies=len(early))
    numbers = F.explode(filters.passing(early, item))
    own = F.col("rendering")

    def chosen(condition: Callable[[dict], Column]) -> Column:
        tests = {n: reduce(Column.__and__, map(condition, some)) for n, some in enumerate(trees) if some}
        return reduce(lambda c, n: c.when(own == n, tests[n]), tests, F.when(F.lit(False), F.lit(True))).otherwise(~own.isin(list(tests)))

    if any(needs_text(some) for some in trees):
        texts = merged_product_types(listed.withColumn("rendering", numbers), ("rendering",))
        return texts.where(chosen(lambda tree: filters.compile_tree(tree, lambda _: F.col("product_type")))).drop("product_type")

    tests: list[dict] = []
    for leaf in (filters.positive(leaf) for some in trees for tree in some for leaf in filters.leaves(tree)):
        if leaf not in tests:
            tests.append(leaf)
    tested = listed.withColumn("part", trimmed_list_text(F.col("product_type")))
    words = []
    for low in range(0, len(tests), BITS):
        bits = [F.when(filters.compile_tree(t, lambda _: F.col("part")), F.lit(1 << n)).otherwise(F.lit(0)).cast("long") for n, t in enumerate(tests[low : low + BITS])]
        words.append(reduce(Column.bitwiseOR, bits).alias(f"tests_{low // BITS}"))
    rows = tested.select(*VARIANT, "id", *words, numbers.alias("rendering"))
    folded = rows.groupBy("rendering", *VARIANT).agg(F.max("id").alias("id"), *[F.bit_or(f"tests_{n}").alias(f"tests_{n}") for n in range(len(words))])

    def holds(leaf: dict) -> Column:
        n = tests.index(filters.positive(leaf))
        return F.col(f"tests_{n // BITS}").bitwiseAND(F.lit(1 << n % BITS).cast("long")) != 0

    if any(trees):
        folded = folded.where(chosen(lambda tree: filters.compile_tree(tree, lambda _: F.lit(None), ready=holds)))
    return folded.select("rendering", *VARIANT, "id")


def needs_text(late_filters: list[dict]) -> bool:
    """Whether a tree cannot be decided part by part of a product-type list."""
    return not all(filters.splits_over_lists(tree) for tree in late_filters if tree["filters"])


def capped(variants: DataFrame, of: tuple[str, ...] = (), cap: int = SKUS_PER_GROUP) -> DataFrame:
    """At most `cap` SKUs per item group, highest ids first."""
    order = Window.partitionBy(*of, "item_group_id").orderBy(F.col("id").desc())
    ordered = variants.withColumn("ordinal", F.row_number().over(order))
    return ordered.where(F.col("ordinal") <= cap).select(*of, "item_group_id", "id")


def representatives(catalog: DataFrame, late_filters: list[dict] = (), cap: int = SKUS_PER_GROUP) -> DataFrame:
    """At most `cap` SKUs per item group whose variants pass the filters."""
    return capped(variants(catalog, list(late_filters)), (), cap)
