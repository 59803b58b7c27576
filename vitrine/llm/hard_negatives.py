"""Hard negatives: rows of other labels that score a little below an anchor's positives, found exactly in a GNAT.

The tree of `vitrine.llm.gnat` cuts the space into leaves; split points are fitted on a bounded sample, all rows are
indexed. A search has two steps: each query first visits its own leaf, which bounds the scores worth looking for; then
it visits every leaf that its narrowed windows reach. Positives are one such search (best rows of the query's label),
negatives another (best rows of other labels in a window below each positive score).

Rows meet in keys of (leaf, part, block of queries). Parts cut a full leaf, blocks cut many queries, so a key holds a
bounded number of rows, and queries stream past them. Equal vectors of one label score alike, so only their smallest ids
can be returned: the index keeps as many of them as a list may need, and equal anchors are one query. A vector that a
third of all rows share is therefore a handful of rows.

Defined results: rows without vec_id, label or vector, or with a null or non-finite component, take no part; repeated
rows count once; rows of one vec_id with other labels or vectors are rows of their own, but never positives of their own
id; shorter vectors are filled up with zeros; an empty table gives an empty result; further columns are not read.
Vectors longer than 2^25 after scaling are refused, since their scores would not be exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.gnat import NONE, Tree, best
from vitrine.llm.ptolemaic_clusters import finite, whole_components
from vitrine.storage import discard, materialise

PART = 4096  # rows of a leaf that are compared at once
WINDOWS = "array<struct<name:long,least:long,most:long>>"


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column as doubles, filled up with zeros to `width`."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _windows(column) -> tuple[np.ndarray, ...]:
    """(owner row, name, least, most) of every window of a batch."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    owner = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False))
    flat = column.flatten()
    return (owner, *(flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)))


class Index:
    """All rows by leaf, on disk, and the tree that leads to them."""

    def __init__(self, rows: DataFrame, *, fanout: int, leaf_rows: int, sample: int) -> None:
        norm = F.aggregate("whole", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
        about = rows.agg(F.count("*").alias("rows"), F.max(norm).alias("m2"), F.max(F.size("whole")).alias("width")).first()
        self.rows, self.width, m2 = about.rows, about.width or 0, about.m2 or 0.0
        if m2 >= 1 << 50:
            raise ValueError("vectors are too long for exact scores")
        depth = 0 if not self.rows else min(4, max(0, math.ceil(math.log(self.rows / leaf_rows, fanout))))
        tree = self.tree = Tree(int(m2))
        if depth:
            picked = rows.select("whole").orderBy(F.xxhash64("whole"), "whole").limit(sample).toArrow()
            tree.grow(_matrix(picked.column(0), self.width), fanout, depth)
        else:
            tree.leaves = 1
        width = self.width

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf, _ = tree.assign(_matrix(batch.column(2), width))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], names=["leaf", "vec_id", "label", "whole"])

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                for node, (low, high) in tree.assign(_matrix(batch.column(0), width))[1].items():
                    old = total.get(node, (low, high))
                    total[node] = np.minimum(old[0], low), np.maximum(old[1], high)
            for node, (low, high) in total.items():
                i, j = np.indices(low.shape).reshape(2, -1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), node, np.int32)), pa.array(i), pa.array(j), pa.array(low.ravel()), pa.array(high.ravel())], names=["node", "i", "j", "low", "high"])

        self.leaves = materialise(rows.select("vec_id", "label", "whole").mapInArrow(place, "leaf int, vec_id long, label long, whole array<int>"), "leaves")
        if tree.nodes:
            ranges = self.leaves.select("whole").mapInArrow(measure, "node int, i int, j int, low double, high double").groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"))
            for r in ranges.collect():  # ranges of all nodes: bounded by fanout and depth
                tree.nodes[r.node].low[r.i, r.j], tree.nodes[r.node].high[r.i, r.j] = r.low, r.high
        counts = {r.leaf: r["count"] for r in self.leaves.groupBy("leaf").count().collect()}  # one row a leaf
        self.parts = np.array([max(1, math.ceil(counts.get(leaf, 0) / PART)) for leaf in range(tree.leaves)], np.int32)

    def search(self, queries: DataFrame, k: int, *, same: bool, home: bool, blocks: int) -> DataFrame:
        """(query, name, score, vec_id, place): the k best rows in each window of `queries` (query, label, whole, windows).

        With `home`, only a part of the query's own leaf is looked at.
        """
        tree, width, parts = self.tree, self.width, self.parts

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(2), width)
                if home:
                    query, leaf = np.arange(len(x)), tree.assign(x)[0]
                    part = np.zeros(len(x), np.int32)
                else:
                    owner, _, least, most = _windows(batch.column(3))
                    query, leaf = tree.reach(x, owner, least, most)
                    times = parts[leaf]
                    part = (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)).astype(np.int32)
                    query, leaf = np.repeat(query, times), np.repeat(leaf, times)
                for low in range(0, len(query), 4096):  # a query may go to many leaves
                    some = slice(low, low + 4096)
                    taken = batch.take(pa.array(query[some]))
                    yield pa.RecordBatch.from_arrays([pa.array(leaf[some]), pa.array(part[some]), *taken.columns], names=["leaf", "part", "id", "label", "whole", "windows"])

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held = None, []
            for batch in batches:
                keys = np.stack([batch.column(c).to_numpy() for c in range(4)], axis=1)
                edges = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)])) if len(keys) else [0]
                for start, stop in zip(edges[:-1], edges[1:], strict=True):
                    some, (leaf, part, block, kind) = batch.slice(start, stop - start), keys[start].tolist()
                    if (leaf, part, block) != key:
                        key, held = (leaf, part, block), []
                    ids, labels, x = some.column(4).to_numpy(), some.column(5).to_numpy(), _matrix(some.column(6), width)
                    if not kind:
                        held.append((x, ids, labels))
                        continue
                    if len(held) > 1:
                        held = [tuple(np.concatenate(c) for c in zip(*held, strict=True))]
                    if not held:
                        continue
                    owner, name, least, most = _windows(some.column(7))
                    for low in range(0, len(held[0][1]), PART):
                        rows, row_ids, row_labels = (c[low : low + PART] for c in held[0])
                        for q in range(0, len(x), 256):
                            own = (owner >= q) & (owner < q + 256)
                            window, row, score = best(rows, row_ids, row_labels, x[q : q + 256], labels[q : q + 256], owner[own] - q, least[own], most[own], k, same=same)
                            yield pa.RecordBatch.from_arrays([pa.array(ids[owner[own][window]]), pa.array(name[own][window]), pa.array(score), pa.array(row_ids[row])], names=["query", "name", "score", "vec_id"])

        sized = queries.sparkSession.createDataFrame([(i, int(p)) for i, p in enumerate(self.parts)], "leaf int, parts int")  # leaves are bounded
        part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
        own = self.leaves.join(F.broadcast(sized), "leaf").select("leaf", part.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "label", "whole", F.lit(None).cast(WINDOWS).alias("windows"))
        schema = f"leaf int, part int, id long, label long, whole array<int>, windows {WINDOWS}"
        routed = queries.select("query", "label", "whole", "windows").mapInArrow(route, schema)
        asked = routed.select("leaf", "part", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(1).alias("kind"), "id", "label", "whole", "windows")
        if home:
            own = own.where("part = 0")
        dealt = own.unionByName(asked).repartition("leaf", "part", "block").sortWithinPartitions("leaf", "part", "block", "kind", "id")
        found = dealt.mapInArrow(meet, "query long, name long, score long, vec_id long")
        order = Window.partitionBy("query", "name").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _narrowed(queries: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """`queries` with the lower end of each window raised to the k-th best score that its own leaf has."""
    full = seen.where(F.col("place") == k).groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("name", "score"))).alias("floor"))  # one entry a window
    least = F.transform("windows", lambda w: F.struct(w["name"].alias("name"), F.greatest(w["least"], F.element_at("floor", w["name"])).alias("least"), w["most"].alias("most")))
    return queries.join(full, "query", "left").withColumn("windows", F.when(F.col("floor").isNull(), F.col("windows")).otherwise(least)).drop("floor")


def hard_negatives(vectors: DataFrame, *, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, fanout: int = 8, leaf_rows: int = 2048, sample: int = 8192, block: int = 20_000) -> DataFrame:
    """The best `negatives` rows of other labels for each anchor and each of its best `positives` rows of its own label.

    `vectors` has vec_id, label and embedding; anchors are the rows whose vec_id is divisible by `every`. Components
    become floor(scale * x); a score is the inner product with the anchor, ties go to the smaller vec_id. A negative's
    score is within `low` and `high` percent of the positive's. Returns (anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score); a positive without negatives has no row.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding").where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding"))
    whole = F.transform(whole_components("embedding", scale), lambda x: F.when(F.abs(x) >= 1 << 25, F.raise_error(F.lit("vectors are too long for exact scores")).cast("int")).otherwise(x.cast("int")))
    rows = materialise(rows.select("vec_id", "label", whole.alias("whole")).distinct(), "vectors")
    alike = Window.partitionBy("whole", "label").orderBy("vec_id")
    kept = materialise(rows.withColumn("place", F.row_number().over(alike)).where(F.col("place") <= max(positives + 1, negatives)).drop("place"), "distinct-vectors")
    index = Index(kept, fanout=fanout, leaf_rows=leaf_rows, sample=sample)
    discard(kept)
    anchors = rows.where(F.col("vec_id") % every == 0)
    queries = materialise(anchors.select("whole", "label").distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    blocks = max(1, math.ceil(queries.count() / block))

    k = positives + 1  # an anchor itself may be among them
    asked = queries.withColumn("windows", F.array(F.struct(F.lit(0).cast("long").alias("name"), F.lit(NONE).alias("least"), F.lit(-NONE).alias("most"))))
    seen = index.search(asked, k, same=True, home=True, blocks=blocks)
    mates = materialise(index.search(_narrowed(asked, seen, k), k, same=True, home=False, blocks=blocks), "positives")

    lists = mates.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("mates"))  # k entries at most
    # A window below a negative score is empty.
    windows = F.expr(f"transform(filter(array_distinct(mates.score), s -> s >= 0), s -> named_struct('name', s, 'least', (s * {low}L + 99L) div 100L, 'most', (s * {high}L) div 100L))")
    asked = materialise(queries.join(lists.select("query", windows.alias("windows")), "query").where("size(windows) > 0"), "windows")
    seen = index.search(asked, negatives, same=False, home=True, blocks=blocks)
    others = materialise(index.search(_narrowed(asked, seen, negatives), negatives, same=False, home=False, blocks=blocks), "negatives")

    found = others.groupBy("query", F.col("name").alias("positive_score")).agg(F.sort_array(F.collect_list(F.struct(F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))).alias("found"))  # `negatives` entries at most
    named = anchors.select(F.col("vec_id").alias("anchor_id"), "label", "whole").join(queries, ["label", "whole"]).select("anchor_id", "query").join(lists, "query")
    own = F.slice(F.filter("mates", lambda m: m["vec_id"] != F.col("anchor_id")), 1, positives)
    pairs = named.select("anchor_id", "query", F.explode(own).alias("m")).select("anchor_id", "query", F.col("m.vec_id").alias("positive_id"), F.col("m.score").alias("positive_score"))
    return pairs.join(found, ["query", "positive_score"]).select("anchor_id", "positive_id", "positive_score", F.inline("found")).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
