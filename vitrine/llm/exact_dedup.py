"""Exact deduplication: compressed radix (Patricia) tries own the texts of a length-and-hash partition.

1. Each task inserts the texts it reads into a trie of its own, so copies meet before any shuffle. A new text becomes
   a local class, sent on once with its number of rows and best identifier; a row only names its class. When the trie
   reaches `memory` bytes, it is sent on and a new one begun: the classes split then meet again in step 2.
2. The local classes, not the rows, are dealt out by (length, hash of content). Each task inserts their full byte
   strings into its trie; a terminal node holds the smallest (or largest) identifier, so texts are equal only if all
   their bytes are. Beyond `memory` bytes the largest subtrees move to files of the task and are finished one by one.
3. Rows get their owner through their local class. A text with a third of all rows has one class per input task, so
   neither step gathers its rows anywhere.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import as_bytes
from vitrine.storage import materialise

MEMORY = 96 << 20


class Node:
    """`edge`: bytes on the way in; `children` by first byte; `value`: of the string that ends here, or None."""

    __slots__ = ("edge", "children", "value")

    def __init__(self, edge: bytes, children: dict, value=None):
        self.edge, self.children, self.value = edge, children, value


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class Trie:
    """Compressed radix trie over byte strings; `size` counts the bytes on its edges."""

    def __init__(self):
        self.root, self.size = Node(b"", {}), 0

    def place(self, key: bytes) -> Node:
        """The terminal node of `key`, made if need be (its value is then None)."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                self.size += len(key) - at + 200
                child = node.children[key[at]] = Node(key[at:], {})
                return child
            edge = child.edge
            if key.startswith(edge, at):
                node, at = child, at + len(edge)
                continue
            same = _common(edge, key[at : at + len(edge)])
            upper = node.children[key[at]] = Node(edge[:same], {edge[same]: child})
            child.edge = edge[same:]
            self.size += 200
            node, at = upper, at + same
        return node

    def items(self, node: Node | None = None) -> Iterator[tuple[bytes, object]]:
        stack = [(b"", node or self.root)]
        while stack:
            before, node = stack.pop()
            here = before + node.edge
            if node.value is not None:
                yield here, node.value
            stack.extend((here, child) for child in node.children.values())


class Owners:
    """Strings with values that `merge` folds together; subtrees beyond `memory` bytes wait in files of this task."""

    def __init__(self, merge, memory: int = MEMORY, depth: int = 0):
        self.merge, self.memory, self.depth = merge, memory, depth
        self.trie, self.spilled = Trie(), {}

    def add(self, key: bytes, value: tuple) -> None:
        branch = key[self.depth] if len(key) > self.depth else -1
        if branch in self.spilled:
            self._write(self.spilled[branch], key, value)
            return
        node = self.trie.place(key)
        node.value = value if node.value is None else self.merge(node.value, value)
        if self.trie.size > self.memory:
            self._spill()

    @staticmethod
    def _write(file, key: bytes, value: tuple) -> None:
        text = pickle.dumps(value)
        file.write(len(key).to_bytes(8, "big") + len(text).to_bytes(8, "big") + key + text)

    def _spill(self) -> None:
        """Move the heavier half of the subtrees, told apart by the byte at `depth`, to files."""
        weight: dict[int, int] = {}
        for key, _ in self.trie.items():
            branch = key[self.depth] if len(key) > self.depth else -1
            weight[branch] = weight.get(branch, 0) + len(key)
        kept, total = Trie(), sum(weight.values())
        out, moved = set(), 0
        for branch in sorted((x for x in weight if x >= 0), key=weight.get, reverse=True):
            if moved * 2 > total:
                break
            moved += weight[branch]
            out.add(branch)
            self.spilled[branch] = tempfile.TemporaryFile()
        for key, value in self.trie.items():
            branch = key[self.depth] if len(key) > self.depth else -1
            if branch in out:
                self._write(self.spilled[branch], key, value)
            else:
                kept.place(key).value = value
        self.trie = kept
        if not out:  # one string as long as the limit
            self.memory *= 2

    def __iter__(self) -> Iterator[tuple[bytes, tuple]]:
        yield from self.trie.items()
        self.trie = Trie()
        for file in self.spilled.values():
            file.seek(0)
            part = Owners(self.merge, self.memory, self.depth + 1)
            while head := file.read(16):
                key = file.read(int.from_bytes(head[:8], "big"))
                part.add(key, pickle.loads(file.read(int.from_bytes(head[8:], "big"))))
            file.close()
            yield from part


def _merge(choose):
    def merge(a: tuple, b: tuple) -> tuple:
        ids = [x for x in (a[0], b[0]) if x is not None]
        return (choose(ids) if ids else None, a[1] + b[1], a[2] + b[2])

    return merge


LOCAL = "doc_id long, part string, class long, text_sha256 string, text binary, length long, hash long, best long, rows long"
KINDS = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())


def _batch(rows: list, kinds: tuple, schema: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _local(fold: bool, choose, memory: int):
    """Rows with their local class, then, whenever a trie is given up, its texts with best id and number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A retried task must not share names with its first attempt: the name of a trie is drawn afresh.
        trie, part, ids, counts = Trie(), uuid.uuid4().hex, [], []

        def finish() -> Iterator[pa.RecordBatch]:
            rows, held = [], 0
            for key, (number, _) in trie.items():
                rows.append((None, part, number, None, key, len(key), xxhash.xxh64_intdigest(key) - (1 << 63), ids[number], counts[number]))
                held += len(key)
                if held > 8 << 20:
                    yield _batch(rows, KINDS, LOCAL)
                    rows, held = [], 0
            yield _batch(rows, KINDS, LOCAL)

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                key = text.lower() if fold else text
                node = trie.place(key)
                if node.value is None:
                    node.value = (len(ids), hashlib.sha256(key).hexdigest())
                    ids.append(doc_id)
                    counts.append(0)
                number, sha = node.value
                counts[number] += 1
                if doc_id is not None:
                    ids[number] = doc_id if ids[number] is None else choose(ids[number], doc_id)
                rows.append((doc_id, part, number, sha, None, None, None, None, None))
                if trie.size > memory:
                    yield _batch(rows, KINDS, LOCAL)
                    yield from finish()
                    rows, trie, part, ids, counts = [], Trie(), uuid.uuid4().hex, [], []
            yield _batch(rows, KINDS, LOCAL)
        yield from finish()

    return run


def exact_groups(documents: DataFrame, *, keep: str = "min", fold_case: bool = True, memory: int = MEMORY) -> DataFrame:
    """Groups of byte-identical texts.

    One row per row of `documents` (doc_id, text): doc_id, keep_id (smallest or largest doc_id of the group, by
    `keep`), group_size, kept, text_sha256 (of the compared text). `fold_case` lowers A-Z first.

    Null texts equal empty ones. A row without doc_id belongs to its group and is kept only if no row of the group has
    one. If rows repeat a doc_id within a group, all of them carry kept; `dedup` leaves one. No rows, no result.
    """
    choose = min if keep == "min" else max
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    local = materialise(rows.mapInArrow(_local(fold_case, choose, memory), LOCAL), "local-classes")
    merge = _merge(choose)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners = Owners(merge, memory)
        for batch in batches:
            x = batch.to_pydict()
            for text, part, number, best, n in zip(x["text"], x["part"], x["class"], x["best"], x["rows"], strict=True):
                owners.add(text, (best, n, ((part, number),)))
        found = []
        for _, (best, n, members) in owners:
            found += [(part, number, best, n) for part, number in members]
            if len(found) > 20_000:
                yield _batch(found, OWNER_KINDS, OWNER)
                found = []
        yield _batch(found, OWNER_KINDS, OWNER)

    texts = local.where("text is not null").repartition("length", "hash")
    owners = texts.select("text", "part", "class", "best", "rows").mapInArrow(own, OWNER)
    return (
        local.where("text is null")
        .select("doc_id", "part", "class", "text_sha256")
        .join(owners, ["part", "class"])
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    )


OWNER = "part string, class long, keep_id long, group_size long"
OWNER_KINDS = (pa.string(), pa.int64(), pa.int64(), pa.int64())


def dedup(documents: DataFrame, *, keep: str = "min", fold_case: bool = True) -> DataFrame:
    """`documents` with one row left of each group of equal texts; all columns as they were."""
    text = F.coalesce("text", F.lit(""))
    if fold_case:
        text = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # One text key, so that finding the rows kept and leaving one of repeated rows share a shuffle.
    name = lambda doc_id, sha: F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("none")), F.lit(" "), sha)
    groups = exact_groups(documents, keep=keep, fold_case=fold_case)
    kept = groups.where("kept").select(name("doc_id", F.col("text_sha256")).alias("_kept")).distinct()
    marked = documents.withColumn("_kept", name("doc_id", F.sha2(text.cast("binary"), 256)))
    return marked.join(kept, "_kept", "left_semi").dropDuplicates(["_kept"]).select(*documents.columns)
