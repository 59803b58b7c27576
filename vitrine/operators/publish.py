"""Publishing documents: files under their labels, and a manifest per run that makes them visible all at once.

A run writes below a folder of its own, `runs/run=<id>/label=<label>/`. Only when all files are there is its manifest
put in place, a small file that names the run's labels with their counts. Readers go by manifests alone, and a label is
read from the latest run that has it. So a run that dies changes nothing, a run that is repeated replaces its labels and
no others, and nobody reads half a run.

A label tells feed, minute, shard range, account and strategy, or for the product feed its scope, algorithm and look-back:
two product feeds of one minute never meet.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from vitrine.functions import sharding
from vitrine.operators.documents import PRODUCT_FEED, UNIFIED_FEED

# Names of the document sets, and the marks of a label.
LISTS, PRODUCTS = "recs_global", "recs_global_pid_pid"
UNIFIED_MARK, ENDING = "_new", ".json.gz"
SCOPE = ("account_id", "market_id", "retailer_id")


def label(documents: DataFrame, sent: datetime) -> Column:
    """File name under which the documents of one account and strategy, or of one product feed, are known downstream."""
    schema = documents.schema["schema"].dataType
    assert isinstance(schema, T.StructType)
    minute = sent.replace(second=0, microsecond=0)

    def named(name: str, key: Column, output: Column) -> Column:
        shard = sharding.shard_key(key)
        span = F.concat_ws("-", sharding.shard_low(shard), sharding.shard_high(shard))
        return F.concat(F.lit(f"{name}-{minute:%Y%m%dT%H%M%S.000Z}_PT1M-"), span, F.lit("-precompute_"), output)

    account = F.col("account.id").cast("string")
    lists = named(LISTS, account, F.concat_ws("_", account, F.col("schema.id").cast("string")))
    mark = F.when(F.col("schema.feed_type") == UNIFIED_FEED, F.lit(UNIFIED_MARK)).otherwise(F.lit(""))
    found = F.concat(lists, mark)
    if "algorithm" in schema.names:
        scope = [F.coalesce(F.col(f"schema.{c}").cast("string"), F.lit("None")) for c in SCOPE]
        output = F.concat_ws("_", *scope, F.col("schema.algorithm"), F.col("schema.lookback_days").cast("string"))
        found = F.when(F.col("schema.feed_type") == PRODUCT_FEED, named(PRODUCTS, F.concat(*scope), output)).otherwise(found)
    return F.concat(found, F.lit(ENDING))


class _Store:
    """The few file operations that manifests need, on whatever file system the path is."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self._path(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(folder)))

    def put(self, name: str, text: str) -> None:
        """The file appears under its name when it is complete."""
        hidden = f"{name.rpartition('/')[0]}/_{uuid.uuid4().hex}"
        out = self.fs.create(self._path(hidden), False)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.fs.rename(self._path(hidden), self._path(name)):
            raise OSError(f"{name} could not be put in place")

    def get(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


def publish(documents: DataFrame, path: str, sent: datetime, outputs: Iterable[tuple[int, int]] = ()) -> dict:
    """Write documents (gzip JSON) below `path` and make them visible; returns the manifest.

    With `outputs`, pairs of account and strategy, the manifest has the number of list entries of each, counted by the
    write itself (`DataFrame.observe`), without a second job. Rows are gathered by label; AQE splits a label with many
    rows over several tasks and joins small ones.
    """
    store, run, outputs = _Store(documents.sparkSession, path), uuid.uuid4().hex, sorted(set(outputs))
    rows, counted = documents, None
    if outputs:
        counted = Observation(f"entries-{run}")
        older = F.col("schema.feed_type") != UNIFIED_FEED  # the unified feed repeats the lists
        entries = [F.sum(F.when(older & (F.col("account.id") == a) & (F.col("schema.id") == s), F.size("document.data"))) for a, s in outputs]
        rows = rows.observe(counted, F.array(*[F.coalesce(e, F.lit(0)) for e in entries]).alias("entries"))
    laid_out = rows.withColumn("label", label(documents, sent)).hint("rebalance", "label")
    laid_out.write.partitionBy("label").option("compression", "gzip").json(f"{path.rstrip('/')}/runs/run={run}")
    labels = [n.removeprefix("label=") for n in store.names(f"runs/run={run}") if n.startswith("label=")]
    manifest = {"run": run, "minute": f"{sent:%Y%m%dT%H%M}", "labels": labels}
    if counted is not None:
        manifest["entries"] = [{"account": a, "strategy": s, "n": n} for (a, s), n in zip(outputs, counted.get["entries"], strict=True)]
    folder = f"manifests/{manifest['minute']}"
    number = max((int(n.partition("-")[0]) for n in store.names(folder) if not n.startswith("_")), default=0) + 1
    store.put(f"{folder}/{number:09}-{run}.json", json.dumps(manifest))
    return manifest


def manifests(spark: SparkSession, path: str, minutes: Iterable[datetime] = ()) -> list[dict]:
    """Manifests of the given minutes (of all, without any) in the order in which their runs became visible."""
    store = _Store(spark, path)
    wanted = [f"{m:%Y%m%dT%H%M}" for m in minutes] or store.names("manifests")
    return [json.loads(store.get(f"manifests/{m}/{n}")) for m in wanted for n in store.names(f"manifests/{m}") if not n.startswith("_")]


def published(spark: SparkSession, path: str, schema: T.StructType | None = None, minutes: Iterable[datetime] = ()) -> DataFrame:
    """The visible documents with their label and what it says: name, minute, shard_low, shard_high, output, unified."""
    latest = {name: m["run"] for m in manifests(spark, path, minutes) for name in m["labels"]}
    if not latest:
        raise ValueError(f"nothing is published below {path}")
    root = f"{path.rstrip('/')}/runs"
    reader = spark.read.option("basePath", root)
    rows = (reader.schema(schema) if schema else reader).json([f"{root}/run={run}/label={name}" for name, run in latest.items()])
    pattern = rf"^(.+)-(\d{{8}}T\d{{4}})\d\d\.000Z_PT1M-(\d+)-(\d+)-precompute_(.+?)({UNIFIED_MARK})?\{ENDING}$"
    part = lambda n: F.regexp_extract("label", pattern, n)
    return rows.withColumns(
        {
            "name": part(1), "minute": part(2), "shard_low": part(3).cast("long"), "shard_high": part(4).cast("long"),
            "output": part(5), "unified": part(6) == UNIFIED_MARK,
        }
    )


def sweep(spark: SparkSession, path: str) -> int:
    """Delete the folders of runs that no label is read from any more, or that never became visible; their number.

    Not for use beside a run that is still writing.
    """
    store = _Store(spark, path)
    live = {run for run in {name: m["run"] for m in manifests(spark, path) for name in m["labels"]}.values()}
    gone = [n for n in store.names("runs") if n.startswith("run=") and n.removeprefix("run=") not in live]
    for name in gone:
        store.fs.delete(store._path(f"runs/{name}"), True)
    return len(gone)
