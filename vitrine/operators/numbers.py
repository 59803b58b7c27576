"""Whole numbers in place of ids: an id is then four bytes wherever rows are many."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.storage import materialise

_PLACE_BITS = 33  # of monotonically_increasing_id: place in the partition, the partition's number above


def numbered(rows: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """Rows, written, with the numbers 0, 1, 2.. in the given order as column `n`; and how many there are.

    Each task numbers its range of rows; only the number of rows of each comes to the driver.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    written = materialise(placed, name)
    part = F.shiftright("_at", _PLACE_BITS).cast("int")
    sizes = {r["part"]: r["count"] for r in written.groupBy(part.alias("part")).count().collect()}
    starts = [0, *accumulate(sizes.get(p, 0) for p in range(max(sizes, default=0) + 1))]
    first = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts]), part + 1)
    n = first + F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return written.withColumn("n", n.cast("int" if starts[-1] < 1 << 31 else "bigint")).drop("_at"), starts[-1]
