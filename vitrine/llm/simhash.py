"""SimHash near-duplicates: fingerprints of word shingles, linked when few bits differ.

Fingerprints are compared exactly, in tiles: `numpy` exclusive-or of two tiles and bit counts of the result. Rows are
ordered by population count first, and two tiles whose counts differ by more than the radius are skipped, since each
differing bit changes the count by one at most.

To keep tiles apart at scale, the 64 bits are cut into radius + 1 blocks: fingerprints within the radius agree in at
least one whole block, so only fingerprints that share a block value meet (exact, no link is lost). Equal fingerprints
count once. A block value with more than `tile_rows` fingerprints is dealt out as pairs of tiles (population count,
salt), again without the pairs that the counts rule out. Each task sends a spanning forest of the links it finds, never
all pairs of a group; components join the forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import as_bytes, local_components
from vitrine.llm.components import components
from vitrine.storage import materialise

CHUNK = 1 << 17  # shingles whose bits are counted at once
TILE = 1024  # rows of a tile in the comparison kernel


def _bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits (high bit first) is set, for each run of hashes that begins at `starts`."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int32)


def fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each text; 0 for a text without words."""
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    counts, totals = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    waiting: list[int] = []
    owners: list[int] = []
    sizes: list[int] = []

    def flush() -> None:
        if waiting:
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            np.add.at(counts, owners, _bit_counts(np.array(waiting, np.uint64), starts))
            np.add.at(totals, owners, sizes)
        waiting.clear(), owners.clear(), sizes.clear()

    for i, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begins = np.concatenate(([0], ends[:-1])).tolist()
        stops = (ends - 1).tolist()
        k = max(len(words) - shingle + 1, 1)
        stops = stops[shingle - 1 :] if len(words) >= shingle else [len(joined)]
        for low in range(0, k, CHUNK):
            part = [digest(joined[a:b], 42) for a, b in zip(begins[low : min(low + CHUNK, k)], stops[low : low + CHUNK], strict=True)]
            waiting.extend(part)
            owners.append(i)
            sizes.append(len(part))
            if len(waiting) >= CHUNK:
                flush()
    flush()
    powers = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    some = totals > 0
    out[some] = ((counts[some] * 2 > totals[some, None]) * powers).sum(axis=1, dtype=np.uint64)
    return out


def signatures(documents: DataFrame, *, shingle: int = 3) -> DataFrame:
    """(doc_id, bits: long) of each row; words are split at ASCII white space after lowering A-Z."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = fingerprints(as_bytes(batch.column(1)), shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, bits long")


def close_pairs(bits: np.ndarray, radius: int, other: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within `radius`, tile by tile. Rows of `bits` (and `other`) must be in order of population count."""
    ones = np.bitwise_count(bits)
    right, right_ones = (bits, ones) if other is None else (other, np.bitwise_count(other))
    for i in range(0, len(bits), TILE):
        low, high = int(ones[i]), int(ones[min(i + TILE, len(bits)) - 1])
        for j in range(i if other is None else 0, len(right), TILE):
            if int(right_ones[j]) > high + radius:
                break
            if int(right_ones[min(j + TILE, len(right)) - 1]) < low - radius:
                continue
            near = np.bitwise_count(bits[i : i + TILE, None] ^ right[None, j : j + TILE]) <= radius
            if other is None and i == j:
                near = np.triu(near, 1)
            a, b = np.nonzero(near)
            if len(a):
                yield a + i, b + j


def _forest(radius: int):
    """Links of a spanning forest for each group of rows with the same key, one partition at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        sources, targets = [], []
        if held:
            table = pa.Table.from_batches(held)
            keys = [table.column(c).to_numpy() for c in ("key", "tile_a", "tile_b")]
            bits, owner = table.column("bits").to_numpy().view(np.uint64), table.column("owner").to_numpy()
            order = np.lexsort((np.bitwise_count(bits), *keys))
            keys, bits, owner = [k[order] for k in keys], bits[order], owner[order]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            edges = np.concatenate(([0], change, [len(bits)]))
            for start, stop in zip(edges[:-1][np.diff(edges) > 1], edges[1:][np.diff(edges) > 1], strict=True):
                label = np.arange(stop - start)
                for a, b in close_pairs(bits[start:stop], radius):
                    la, lb = label[a], label[b]
                    apart = la != lb
                    if apart.any():
                        label = local_components(len(label), la[apart], lb[apart])[label]
                moved = np.flatnonzero(label != np.arange(len(label)))
                sources.append(owner[start:stop][moved])
                targets.append(owner[start:stop][label[moved]])
        a = np.concatenate(sources) if sources else np.zeros(0, np.int64)
        b = np.concatenate(targets) if targets else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def links(prints: DataFrame, *, radius: int = 2, tile_rows: int = 20_000) -> DataFrame:
    """Spanning links (a, b) between `owner`s of distinct fingerprints (bits, owner) within `radius` bits."""
    if radius < 1:
        raise ValueError("radius must be 1 or more; equal fingerprints are one row")
    blocks = radius + 1
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    pieces = [
        F.struct((F.shiftrightunsigned("bits", 64 - edges[i + 1]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1)) * blocks + i).alias("key"))
        for i in range(blocks)
    ]
    keyed = prints.select("bits", "owner", F.explode(F.array(*pieces)).alias("p")).select("p.key", "bits", "owner")
    hot = keyed.groupBy("key").count().where(F.col("count") > tile_rows).select("key", F.ceil(F.col("count") / tile_rows).cast("long").alias("salts"))
    split = keyed.join(hot, "key", "left")
    plain = split.where("salts is null").select("key", F.lit(0).cast("long").alias("tile_a"), F.lit(0).cast("long").alias("tile_b"), "bits", "owner")
    own = F.bit_count("bits") * F.col("salts") + F.pmod(F.xxhash64("bits"), F.col("salts"))
    low = F.greatest(F.bit_count("bits") - radius, F.lit(0)) * F.col("salts")
    high = (F.bit_count("bits") + radius + 1) * F.col("salts") - 1
    tiled = split.where("salts is not null").select("key", "bits", "owner", own.alias("t"), F.explode(F.sequence(low, high)).alias("u")).select("key", F.least("t", "u").alias("tile_a"), F.greatest("t", "u").alias("tile_b"), "bits", "owner")
    dealt = plain.unionByName(tiled).repartition("key", "tile_a", "tile_b")
    return dealt.mapInArrow(_forest(radius), "a long, b long")


def near_groups(documents: DataFrame, *, shingle: int = 3, radius: int = 2, tile_rows: int = 20_000) -> DataFrame:
    """Group of each document under links of `radius` bits or fewer.

    One row per row of `documents` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id (smallest doc_id
    reachable). A bit is set if it is set in over half of the shingle hashes (XXH64, seed 42), repeats included. Fewer
    words than `shingle` make one shingle; texts without words have fingerprint zero, linked like any other. Rows
    without doc_id link no others; they get the component of their fingerprint, null if no row with a doc_id has it.
    """
    prints = materialise(signatures(documents, shingle=shingle), "fingerprints")
    distinct = materialise(prints.groupBy("bits").agg(F.min("doc_id").alias("owner")).where("owner is not null"), "distinct-fingerprints")
    groups = components(links(distinct, radius=radius, tile_rows=tile_rows))
    named = distinct.join(groups, F.col("owner") == F.col("node"), "left").select("bits", F.coalesce("component", "owner").alias("component_id"))
    return prints.join(named, "bits", "left").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def thin(documents: DataFrame, *, shingle: int = 3, radius: int = 2) -> DataFrame:
    """`documents` with the row of the smallest doc_id left of each group; all columns as they were.

    Rows that repeat that doc_id all stay; rows without doc_id stay, since nothing names them.
    """
    gone = near_groups(documents, shingle=shingle, radius=radius).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, documents["doc_id"].cast("long") == gone["_gone"], "left_anti")
