"""Benchmark decontamination: Wu-Manber search for runs of benchmark words in documents.

Symbols are words. For each length of test string (a window of `window` words; an item with fewer words is one string)
there is a shift table over blocks of two words: it says how far the search may jump when a block is seen at the end of
the current window, at most the length less one. A shift of zero points to the bucket of test strings that end in this
block; each is compared with the words in place. Documents are searched whole, where they lie, with no shuffle.

The test strings are broadcast in portions of `portion` bytes of item text at most. A larger benchmark is searched in
several rounds, each adding its hits to those of the round before, so a task's memory has a fixed bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import as_bytes
from vitrine.storage import materialise

PORTION = 2 << 20
#: Letters A-Z become small, digits and bytes of other scripts stay, anything else parts words.
LETTERS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


class Length:
    """Shift table and buckets of the test strings of one length."""

    def __init__(self, size: int):
        self.size, self.block = size, min(size, 2)
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, dict[tuple, set]] = {}

    def add(self, string: tuple, item: str) -> None:
        for end in range(self.block, self.size + 1):
            block = string[end - self.block : end]
            self.shift[block] = min(self.shift.get(block, self.size), self.size - end)
        self.bucket.setdefault(string[-self.block :], {}).setdefault(string, set()).add(item)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(start, items) of each occurrence, by position."""
        size, shift, far, at, end = self.size, self.shift.get, self.size - self.block + 1, self.size, len(words)
        if self.block == 2:
            while at <= end:
                block = (words[at - 2], words[at - 1])
                step = shift(block, far)
                if step:
                    at += step
                    continue
                items = self.bucket[block].get(tuple(words[at - size : at]))
                if items is not None:
                    yield at - size, items
                at += 1
        else:
            for at, word in enumerate(words):
                if (word,) in self.bucket:
                    yield at, self.bucket[word,][word,]


def compile_items(items: list[tuple[str, bytes]], window: int) -> list[Length]:
    found: dict[int, Length] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        if size:
            length = found.setdefault(size, Length(size))
            for start in range(len(words) - size + 1):
                length.add(tuple(words[start : start + size]), item)
    return list(found.values())


def hits(words: list[bytes], lengths: list[Length]) -> tuple[list[tuple[int, int]], set]:
    """Runs of hit words (start, end), disjoint and in order, and the items that occur."""
    spans, items = [], set()
    for length in lengths:
        for start, found in length.search(words):
            spans.append((start, start + length.size))
            items |= found
    return join_spans(spans), items


def join_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
ADDED = "_words long, _spans array<struct<start: long, end: long>>, _items array<string>"


def _round(documents: DataFrame, lengths, at: int, schema: str, carry: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans, items = [], [], []
            before = zip(batch.column("_spans").to_pylist(), batch.column("_items").to_pylist(), strict=True) if carry else ((), ()) * 0
            for i, text in enumerate(as_bytes(batch.column(at))):
                words = words_of(text)
                new, found = hits(words, lengths.value)
                if carry:
                    old, named = next(before)
                    new, found = join_spans(new + [(s["start"], s["end"]) for s in old]), found | set(named)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in new])
                items.append(sorted(found))
            kept = [c for c in batch.schema.names if c not in ("_words", "_spans", "_items")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(counts, pa.int64()), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))],
                names=[*kept, "_words", "_spans", "_items"],
            )

    return documents.mapInArrow(run, schema)


def _schema(columns: list[tuple[str, str]]) -> str:
    return ", ".join([f"`{c}` {kind}" for c, kind in columns] + [ADDED])


def find(documents: DataFrame, benchmark: DataFrame, *, window: int = 10, portion: int = PORTION) -> DataFrame:
    """`documents` with three more columns: _words (number of words), _spans (runs of hit words: start, end) and _items
    (ids of the items that occur, sorted as text). Only `text` is read of the documents, item_id and text of the
    benchmark. Null texts have no words; items without words or without id match nothing; an item may repeat."""
    spark = documents.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rounds = max(1, -(-total // portion))
    schema = _schema(documents.dtypes)
    at = documents.columns.index("text")
    for number in range(rounds):
        part = [(r.item, r.text.encode()) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(rounds)) == number).toLocalIterator()]
        lengths = spark.sparkContext.broadcast(compile_items(part, window))
        documents = _round(documents, lengths, at, schema, number > 0)
        if number + 1 < rounds:
            documents = materialise(documents, "benchmark-hits")
    return documents


def contamination(documents: DataFrame, benchmark: DataFrame, *, window: int = 10, portion: int = PORTION) -> DataFrame:
    """One row per row of `documents`: doc_id, n_words, n_hit (words inside any occurrence), n_items, item_ids (sorted as
    text), spans, contaminated. See `find` for nulls; no rows give no result."""
    found = find(documents.select(F.col("doc_id").cast("long"), "text"), benchmark, window=window, portion=portion)
    n_hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", F.col("_words").alias("n_words"), n_hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.col("_items").alias("item_ids"), F.col("_spans").alias("spans"), (F.size("_spans") > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, *, window: int = 10) -> DataFrame:
    """`documents` without the rows that hold a test string; all columns as they were."""
    return find(documents, benchmark, window=window).where(F.size("_spans") == 0).select(*documents.columns)


def items_digest(column: str):
    """SHA-256 of the ids joined by commas."""
    return F.sha2(F.array_join(column, ",").cast("binary"), 256)


def digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()
