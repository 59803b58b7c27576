"""Cutting lineage for results that several plans share.

A shared intermediate is written once as parquet below the shared folder named
by `spark.checkpoint.dir` and read back: it survives lost executors, keeps
column pruning, and gives the planner real sizes to choose join strategies by.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`; a temporary one only for a master inside this process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[[^,]*(,[^,]*)?\])?$", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="vitrine-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/shared/{spark.sparkContext.applicationId}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and return a scan of it.

    Shuffle files behind it are deleted with the end of the write: nothing reads them any more, and a chain of steps
    needs no more local disk than its largest one.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def in_rounds(rows: DataFrame, name: str, rounds: int, *key: str, then: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`then` of `rows`, which may not mix rows of different `key`, written for one part of the keys after the other.

    What `then` shuffles lies on disk for one round at a time.
    """
    turn = F.pmod(F.xxhash64(*key), F.lit(rounds))
    parts = [materialise(then(rows.where(turn == r) if rounds > 1 else rows), name) for r in range(rounds)]
    return reduce(DataFrame.unionByName, parts)


def discard(df: DataFrame) -> None:
    """Delete what `materialise` wrote for `df`, a scan that nothing reads any more."""
    spark = df.sparkSession
    own = f"{_own_folder(spark)}/"
    folders = {file.rpartition("/")[0] for file in df.inputFiles()}
    for folder in folders:
        if own.removeprefix("file:").lstrip("/") in folder:
            _delete(spark, folder)


def sweep(spark: SparkSession) -> None:
    """Delete all that this application has materialised; call it when the results of a run are written."""
    _delete(spark, _own_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
