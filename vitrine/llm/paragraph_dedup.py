"""Near-duplicate paragraphs: MinHash bands find candidates, exact Jaccard decides, components choose what goes.

A paragraph is a line of a text; its words are split at ASCII white space after lowering A-Z. Similarity is the Jaccard
index of the sets of five-word shingles. Numbers of bands and rows are tuned (`tuned`) so that a pair just at the
threshold is missed with a probability below `miss`.

1. Each paragraph gets a 64-bit hash of its words, so equal paragraphs are one from then on.
2. Band keys meet by shuffle; rows stream through in order, and only keys with two different paragraphs go on. Keys with
   the same members count once. A key with more than `tile_rows` members is dealt out as pairs of tiles.
3. The shingles of these paragraphs alone are fetched, from one document each. In a tile, overlaps of a paragraph with
   all others are counted at once through posting lists; once every paragraph outside the largest cluster has been
   counted against all, no link between clusters can be missed. Only a spanning forest of the links leaves the task.
4. Components of these links and equal paragraphs form the clusters. The first occurrence (smallest doc_id, then place)
   stays, all others are removed.
5. Passages (`passage_reach`): what is left of a text is cut into pieces wherever the hash of two words is the smallest
   of all within so many words on either side. The words alone decide that, across line ends, so a passage repeated
   inside other lines falls into the same pieces. They go through steps 1 to 4 like lines, and their spans go.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import as_bytes
from vitrine.llm.components import components
from vitrine.llm.substring_suffixes import MIX, _sliding, joined
from vitrine.storage import discard, materialise

TILE_ROWS = 5000
LONGEST = 50  # words of a piece
WORD = re.compile(rb"\S+")


def tuned(threshold: float, miss: float, most: int = 10) -> tuple[int, int]:
    """(bands, rows): the most rows a band may have so that `most` bands or fewer (twice as many and so on, if none do)
    miss a pair at `threshold` with a probability of `miss` at most."""
    for rows in range(8, 0, -1):
        for bands in range(1, most + 1):
            if (1 - threshold**rows) ** bands <= miss:
                return bands, rows
    return tuned(threshold, miss, 2 * most)


def shingle_sets(paragraphs: list[list[bytes]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all paragraphs (with at least one word each), and where each paragraph's begin."""
    lengths = np.fromiter(map(len, paragraphs), np.int64, len(paragraphs))
    words = np.fromiter((zlib.crc32(w) for p in paragraphs for w in p), np.uint64, int(lengths.sum()))
    words = (words + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(29)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    counts = np.maximum(lengths - size + 1, 1)
    owner = np.repeat(np.arange(len(paragraphs)), counts)
    begins = np.concatenate(([0], np.cumsum(counts)[:-1]))
    at = starts[owner] + np.arange(len(owner)) - begins[owner]
    ends = (starts + lengths)[owner]
    out = np.zeros(len(owner), np.uint64)
    for k in range(size):
        inside = at + k < ends  # fewer words: the whole paragraph
        out = np.where(inside, (out ^ words[np.minimum(at + k, len(words) - 1)]) * np.uint64(0xC2B2AE3D27D4EB4F), out)
        out ^= out >> np.uint64(31)
    return out, begins


def band_keys(hashes: np.ndarray, begins: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(paragraphs, bands) keys: each hashes the minima of `rows` permutations and the number of the band."""
    draw = np.random.default_rng(11)
    factors = draw.integers(1, 1 << 63, (bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(begins), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(begins), np.uint64(b + 1) * np.uint64(0xD6E8FEB86659FD93), np.uint64)
        for f in factors[b]:
            mixed = hashes * f
            mixed ^= mixed >> np.uint64(32)
            least = np.minimum.reduceat(mixed * np.uint64(0xA0761D6478BD642F), begins)
            key = (key ^ least) * np.uint64(0x165667B19E3779F9)
            key ^= key >> np.uint64(32)
        out[:, b] = key
    return out


def paragraphs_of(text: bytes) -> list[list[bytes]]:
    return [line.split() for line in text.lower().split(b"\n")]


def _name(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


ROWS = "part string, number long, doc_id long, packed binary, names array<long>"


def _read(least_words: int):
    """Rows with a name of their own, the text compressed, and the names of its paragraphs (null: too short to count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, press = uuid.uuid4().hex, 0, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = as_bytes(batch.column(1))
            names = [[_name(p) if len(p) >= least_words else None for p in paragraphs_of(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(texts), pa.string()), pa.array(range(row, row + len(texts)), pa.int64()), batch.column(0), pa.array(map(press.compress, texts), pa.binary()), pa.array(names, pa.list_(pa.int64()))],
                names=[f.split()[0] for f in ROWS.split(", ")],
            )
            row += len(texts)

    return run


def _bands(size: int, bands: int, rows: int):
    """Band keys of the named units of each text; a name that a task has met before is not worked again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, seen = zstandard.ZstdDecompressor(), set()
        for batch in batches:
            fresh: dict[int, list[bytes]] = {}
            held = 0
            for packed, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for name, line in zip(names, expand.decompress(packed).lower().split(b"\n"), strict=True):
                    if name is not None and name not in seen and name not in fresh:
                        words = fresh[name] = line.split()
                        held += len(words)
                if held > 150_000:
                    yield _keys(fresh, size, bands, rows)
                    seen.update(fresh)
                    fresh, held = {}, 0
            if fresh:
                yield _keys(fresh, size, bands, rows)
                seen.update(fresh)
            if len(seen) > 1_000_000:
                seen.clear()

    return run


def _keys(fresh: dict[int, list[bytes]], size: int, bands: int, rows: int) -> pa.RecordBatch:
    keys = band_keys(*shingle_sets(list(fresh.values()), size), bands, rows)
    return pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(np.fromiter(fresh, np.int64, len(fresh)), bands))], names=["key", "name"])


MEMBER = "bucket long, tile_a int, tile_b int, name long"


def _buckets(tile_rows: int):
    """Of rows in order of key and name: members of the keys with at least two names, large ones as pairs of tiles."""

    def deal(names: np.ndarray) -> Iterator[pa.RecordBatch]:
        tiles = -(-len(names) // tile_rows)
        bucket = xxhash.xxh3_64_intdigest(names.tobytes()) - (1 << 63)
        for a in range(tiles):
            for b in range(a, tiles) if tiles < 3 else range(a + 1, tiles):
                some = np.concatenate([names[t * tile_rows : (t + 1) * tile_rows] for t in sorted({a, b})])
                n = len(some)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, bucket)), pa.array(np.full(n, a, np.int32)), pa.array(np.full(n, b, np.int32)), pa.array(some)], names=["bucket", "tile_a", "tile_b", "name"])

    def small(keys: np.ndarray, names: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All complete groups of a run of rows."""
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])))
        keys, names = keys[new], names[new]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.append(starts, len(keys)))
        out: list[tuple[np.ndarray, int]] = []
        for s, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            group = names[s : s + n]
            if n > tile_rows:
                yield from deal(group)
            else:
                out.append((group, xxhash.xxh3_64_intdigest(group.tobytes()) - (1 << 63)))
        if out:
            n = [len(g) for g, _ in out]
            zeros = np.zeros(sum(n), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array([b for _, b in out], np.int64), n)), pa.array(zeros), pa.array(zeros), pa.array(np.concatenate([g for g, _ in out]))], names=["bucket", "tile_a", "tile_b", "name"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, names = [], []  # rows of a group that may go on in the next batch: one name each
        for batch in batches:
            if not batch.num_rows:
                continue
            keys.append(batch.column(0).to_numpy())
            names.append(batch.column(1).to_numpy())
            if keys[0][0] == keys[-1][-1]:
                continue
            k, n = np.concatenate(keys), np.concatenate(names)
            cut = int(np.searchsorted(k, k[-1]))
            yield from small(k[:cut], n[:cut])
            keys, names = [k[cut:]], [n[cut:]]
        if keys:
            yield from small(np.concatenate(keys), np.concatenate(names))

    return run


def _fetch(size: int):
    """Shingle sets of the wanted paragraphs of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            names, sets = [], []
            for packed, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                paragraphs = paragraphs_of(expand.decompress(packed))
                hashes, begins = shingle_sets([paragraphs[i] for i in places], size)
                for i, part in zip(places, np.split(hashes, begins[1:]), strict=True):
                    names.append(_name(paragraphs[i]))
                    sets.append(np.unique(part).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], names=["name", "shingles"])

    return run


def close_forest(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Cluster (smallest index) of each set under links of Jaccard index `threshold` or more; exact."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat_sorted, posting = flat[order], owner[order]
    label, counted = np.arange(n), np.zeros(n, bool)
    while True:
        largest = np.bincount(label, minlength=n).argmax()
        left = np.flatnonzero(~counted & (label != largest))
        if not len(left) or counted.sum() == 0 and n == 1:
            return label
        x = left[0]
        low, high = np.searchsorted(flat_sorted, sets[x], "left"), np.searchsorted(flat_sorted, sets[x], "right")
        lengths = high - low
        rows = np.repeat(low - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(int(lengths.sum()))
        overlap = np.bincount(posting[rows], minlength=n)
        near = np.flatnonzero(overlap >= threshold * (sizes + sizes[x] - overlap) - 1e-9)
        joined = np.unique(label[near])
        label[np.isin(label, joined)] = joined[0]
        counted[x] = True


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, members = None, {}
        sources: list[int] = []
        targets: list[int] = []

        def close() -> None:
            if len(members) > 1:
                names = sorted(members)
                label = close_forest([np.frombuffer(members[m], np.uint64) for m in names], threshold)
                for i, j in enumerate(label.tolist()):
                    if i != j:
                        sources.append(names[i])
                        targets.append(names[j])
            members.clear()

        for batch in batches:
            x = batch.to_pydict()
            for *key, name, shingles in zip(x["bucket"], x["tile_a"], x["tile_b"], x["name"], x["shingles"], strict=True):
                if key != current:
                    close()
                    current = key
                members[name] = shingles
        close()
        yield pa.RecordBatch.from_arrays([pa.array(sources, pa.int64()), pa.array(targets, pa.int64())], names=["a", "b"])

    return run


def near_units(read: DataFrame, *, shingle: int, threshold: float, miss: float, most_bands: int, tile_rows: int) -> DataFrame:
    """(part, number, removed, first_docs) of each row of `read` (`ROWS`; a unit a line) with a unit that occurs again:
    the places to remove, and the first documents of its clusters. Of a cluster the first unit stays, in order of
    doc_id (rows without come last), row and place."""
    bands, rows = tuned(threshold, miss, most_bands)
    keyed = read.select("packed", "names").mapInArrow(_bands(shingle, bands, rows), "key long, name long")
    members = keyed.repartition("key").sortWithinPartitions("key", "name").mapInArrow(_buckets(tile_rows), MEMBER)
    members = materialise(members.distinct(), "unit-buckets")

    occurrences = read.select("part", "number", "doc_id", F.posexplode("names").alias("place", "name")).where("name is not null")
    wanted = members.select("name").distinct()
    source = occurrences.join(wanted, "name").groupBy("name").agg(F.min(F.struct("part", "number", "place")).alias("x"))
    asked = source.groupBy("x.part", "x.number").agg(F.collect_list("x.place").alias("places"))
    sets = read.select("part", "number", "packed").join(asked, ["part", "number"]).select("packed", "places").mapInArrow(_fetch(shingle), "name long, shingles binary")
    tiles = members.join(sets, "name").repartition("bucket", "tile_a", "tile_b").sortWithinPartitions("bucket", "tile_a", "tile_b")
    links = tiles.select("bucket", "tile_a", "tile_b", "name", "shingles").mapInArrow(_verify(threshold), "a long, b long")
    clusters = materialise(components(links).select(F.col("node").alias("name"), F.col("component").alias("cluster")), "unit-clusters")
    discard(members)

    # Most units occur once and are like no other; only the rest is dealt out by cluster.
    again = occurrences.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    shared = materialise(again.join(clusters, "name", "full").select("name", F.coalesce("cluster", "name").alias("cluster")), "shared-units")
    placed = materialise(occurrences.join(shared, "name"), "shared-places")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("doc"), "part", "number", "place")
    firsts = placed.groupBy("cluster").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select("cluster", "first")
    stays = (F.col("part") == F.col("first.part")) & (F.col("number") == F.col("first.number")) & (F.col("place") == F.col("first.place"))
    marked = placed.join(firsts, "cluster").select("part", "number", F.when(~stays, F.col("place")).alias("gone"), F.when(~F.col("first.unnamed"), F.col("first.doc")).alias("doc"))
    return marked.groupBy("part", "number").agg(F.sort_array(F.collect_list("gone")).alias("removed"), F.sort_array(F.collect_set("doc")).alias("first_docs"))


def pieces(words: list[bytes], reach: int) -> list[tuple[int, int]]:
    """Ranges of words between places that are least in their surroundings of `reach` words; at most `LONGEST` words each.

    At such a place the hash of its word and the one before is below all `reach` hashes before it and not above those
    after it. Places `reach` + 1 words or more inside a passage are the same wherever the passage occurs.
    """
    n = len(words)
    if not n:
        return []
    h = (np.fromiter(map(zlib.crc32, words), np.uint64, n) + np.uint64(1)) * MIX[0]
    h[1:] ^= h[:-1] * MIX[1]
    h ^= h >> np.uint64(29)
    h *= MIX[2]
    h ^= h >> np.uint64(32)
    ends = np.full(reach, np.iinfo(np.uint64).max)
    around = _sliding(np.concatenate([ends, h, ends]), reach, np.minimum)
    least = (h < around[:n]) & (h <= around[reach + 1 : reach + 1 + n])
    cuts = np.flatnonzero(least)
    out, start = [], 0
    for cut in [*cuts[cuts > 0].tolist(), n]:
        while cut - start > LONGEST:
            out.append((start, start + LONGEST))
            start += LONGEST
        out.append((start, cut))
        start = cut
    return out


def pieces_left(text: bytes, removed: list[int], reach: int) -> tuple[list[bytes], np.ndarray, list[tuple[int, int]]]:
    """Lowered words of the lines of `text` that stay, the line of each, and the ranges of the pieces."""
    gone, words, lines = set(removed), [], []
    for i, paragraph in enumerate(paragraphs_of(text)):
        if i not in gone:
            words += paragraph
            lines += [i] * len(paragraph)
    return words, np.array(lines, np.int64), pieces(words, reach)


def _read_pieces(reach: int):
    """The pieces of what is left of each text, one a line, in the columns of `ROWS`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed, names = [], []
            for text, removed in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                words, _, ranges = pieces_left(expand.decompress(text), removed or [], reach)
                cut = [b" ".join(words[a:b]) for a, b in ranges]
                found = [xxhash.xxh3_64_intdigest(c) - (1 << 63) if b - a > reach else None for c, (a, b) in zip(cut, ranges, strict=True)]
                names.append(found or [None])  # nothing left: one empty line, as of an empty text
                packed.append(press.compress(b"\n".join(cut)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary()), pa.array(names, pa.list_(pa.int64()))], names=[f.split()[0] for f in ROWS.split(", ")])

    return run


def _spans(reach: int):
    """Bytes of the pieces to remove of each text, broken where lines are removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for packed, removed, chosen in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                text = expand.decompress(packed)
                _, lines, ranges = pieces_left(text, removed or [], reach)
                gone = set(removed or [])
                places = [m.span() for m in WORD.finditer(text)]
                breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
                places = [x for x, i in zip(places, np.searchsorted(breaks, [a for a, _ in places]).tolist(), strict=True) if i not in gone]
                spans = []
                for a, b in (ranges[i] for i in chosen):
                    # A jump over removed lines parts a span; lines without words do not.
                    jumps = [k for k in range(a + 1, b) if any(line in gone for line in range(int(lines[k - 1]) + 1, int(lines[k])))]
                    for low, high in zip([a, *jumps], [*jumps, b], strict=True):
                        spans.append((places[low][0], places[high - 1][1]))
                out.append([{"start": a, "end": b} for a, b in joined(spans)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["part", "number", "spans"])

    return run


def remove_near(
    documents: DataFrame, *, with_text: bool = False, passage_reach: int | None = None, shingle: int = 5, threshold: float = 0.8, miss: float = 0.001, passage_miss: float = 0.06, least_words: int = 5, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """One row per row of `documents` (doc_id, text): doc_id, n_paragraphs (lines), n_removed, removed (their places,
    from 0), first_docs (doc_ids whose paragraph stays for each cluster with a paragraph of this row, its own included);
    with `passage_reach` also spans (bytes from start to end, in order, of pieces that occur before, in what the lines
    left); with `with_text` also kept (the text without the removed lines and spans).

    Paragraphs of fewer than `least_words` words are never removed, nor pieces of `passage_reach` words or fewer. Of
    equal places, the row that stays is the one of the smallest doc_id; rows without doc_id come last. Null texts are
    empty: one line, no words. No rows, no result. Pairs just at the threshold are missed with a probability of `miss`
    (lines) and `passage_miss` (pieces) at most; equal ones never.
    """
    options = {"shingle": shingle, "threshold": threshold, "tile_rows": tile_rows}
    read = materialise(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_read(least_words), ROWS), "paragraph-names")
    decided = near_units(read, miss=miss, most_bands=10, **options)
    columns = ["part", "number", "doc_id", F.size("names").cast("long").alias("n_paragraphs")] + ["packed"] * with_text
    none = lambda kind: F.expr(f"cast(array() as array<{kind}>)")
    removed = F.coalesce("removed", none("int"))
    passages = []
    if passage_reach is not None:
        decided = materialise(decided, "paragraphs-removed")
        left = read.join(decided, ["part", "number"], "left").select("part", "number", "doc_id", "packed", "removed")
        cut = materialise(left.mapInArrow(_read_pieces(passage_reach), ROWS), "pieces")
        chosen = near_units(cut, miss=passage_miss, most_bands=4, **options).where("size(removed) > 0").select("part", "number", F.col("removed").alias("chosen"))
        spans = left.join(chosen, ["part", "number"]).select("part", "number", "packed", "removed", "chosen").mapInArrow(_spans(passage_reach), "part string, number long, spans array<struct<start: int, end: int>>")
        passages = [F.coalesce("spans", none("struct<start: int, end: int>")).alias("spans")]
    rows = read.select(*columns).join(decided, ["part", "number"], "left")
    if passage_reach is not None:
        rows = rows.join(spans, ["part", "number"], "left")
    out = rows.select("doc_id", "n_paragraphs", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"), F.coalesce("first_docs", none("bigint")).alias("first_docs"), *passages, *["packed"] * with_text)
    return out.mapInArrow(_keep, ", ".join(f"{c} {kind}" for c, kind in out.dtypes if c != "packed") + ", kept string") if with_text else out


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        kept = []
        spans = batch.column("spans").to_pylist() if "spans" in batch.schema.names else [[]] * batch.num_rows
        for packed, removed, cut in zip(batch.column("packed").to_pylist(), batch.column("removed").to_pylist(), spans, strict=True):
            gone, text, parts, at = set(removed), expand.decompress(packed), [], 0
            for i, line in enumerate(text.split(b"\n")):
                if i not in gone:
                    rest, end = at, at + len(line)
                    pieces = []
                    for x in cut:
                        if x["start"] < end and x["end"] > rest:
                            pieces.append(text[rest : max(x["start"], rest)])
                            rest = min(x["end"], end)
                    left = b"".join([*pieces, text[rest:end]])
                    if left or not pieces:
                        parts.append(left)
                at += len(line) + 1
            kept.append(b"\n".join(parts))
        names = [n for n in batch.schema.names if n != "packed"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(kept, pa.binary()).cast(pa.string())], names=[*names, "kept"])
