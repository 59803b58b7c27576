"""Dealing rows out to tasks by their number."""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS_A_TASK = 1_000_000


def spread(df: DataFrame, *keys: str, copies: int = 1) -> DataFrame:
    """Rows dealt out by `keys` to a task for every million, each row counted as the copies that are made of it next.

    A small file is read by one task, and shuffled partitions are merged by their compressed size, in which ids take a few
    bytes: neither tells how many rows a task will sort.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-df.count() * copies // ROWS_A_TASK)), *keys)
