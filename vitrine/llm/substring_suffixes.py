"""Suffix-array deduplication of byte strings: removes what any other place of the corpus repeats for `length` bytes.

1. Anchors. In each text the smallest hash of a 32-byte window is chosen among all windows of every `length`-byte
   string. It depends on the string alone, so two equal strings have the same anchor at the same place, and only places
   whose anchor occurs again can be repeated (exact, nothing is sampled away).
2. Windows. Around each place of a repeated anchor, the bytes of all strings that it anchors are cut out, once for each
   different content.
3. Suffix array. The windows of an anchor meet in one task, up to `HOT` of them. As blocks of `BLOCK` bytes named once by
   content, they are sorted by suffix (`suffix_array`, linear grouping). Neighbours that share as many blocks as every
   repeated string must contain mark the places where one can lie; the bytes of these places are then compared as they
   are.
4. Hot anchors. A very common line has its anchor in as many windows as there are texts with that line. A repeated
   string holds a run of whole blocks at a fixed distance from the anchor, so windows of such anchors meet by (anchor,
   hash of a run) instead, each with only the few bytes around the run: windows that share nothing but the line never
   meet. Beyond `GIANT` windows of an anchor nothing is gathered at all: rows stream past, and the strings around runs
   that occur twice are counted by hash with partial sums before the shuffle.
5. Spans. What repeats goes back to all places with that window, spans are joined by text and cut out of it.

Places are named by a 97-bit hash of the whole text, so equal texts do all of this once, and texts travel compressed. A
task sends the places of equal texts twice at most, which is enough to know that they repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import as_bytes
from vitrine.llm.suffix_array import common_prefixes, suffix_array
from vitrine.storage import materialise

ANCHOR = 32  # bytes hashed; a power of two
BLOCK = 16
PLACE_BITS = 31
HOT, GIANT = 1000, 20_000  # windows of an anchor that are sorted together, and that meet by runs


def _sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """choose (minimum or maximum) of every `width` values in a row, by doubling."""
    n, size, out = len(values) - width + 1, 1, values
    while size * 2 <= width:
        out = choose(out[:-size], out[size:])
        size *= 2
    return choose(out[:n], out[width - size : width - size + n])


#: Odd 64-bit constants for mixing, one for each doubling.
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all windows that are smallest in some `length`-byte string (ties all count)."""
    if len(text) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    size = 1
    for m in MIX:
        h = (h[:-size] * m) ^ (h[size:] + (h[:-size] >> np.uint64(29)))
        size *= 2
    h *= MIX[0]
    h ^= h >> np.uint64(32)
    width = length - ANCHOR + 1
    least = _sliding(h, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    chosen = np.flatnonzero(h == _sliding(np.concatenate([pad, least, pad]), width, np.maximum))
    return chosen, h[chosen]


def text_id(text: bytes) -> tuple[int, int]:
    """97 bits of a hash of the text, as a signed 64-bit number and 33 bits."""
    whole = xxhash.xxh3_128_intdigest(text)
    return (whole >> 64) - (1 << 63), whole & ((1 << 64 - PLACE_BITS) - 1)


PLACE = "anchor long, window long, text_a long, text_b long, reach long"


def _places(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        left = length - ANCHOR
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            for text in as_bytes(batch.column(0)):
                if len(text) < length:
                    continue
                a, b = text_id(text)
                seen[a, b] = seen.get((a, b), 0) + 1
                if seen[a, b] > 2:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                where, hashes = anchors(text, length)
                windows = [xxhash.xxh3_64_intdigest(text[max(p - left, 0) : p + length], max(left - p, 0)) for p in where.tolist()]
                kept, reach = chains(where, windows, length)
                where = where[kept]
                columns[0].append(hashes[kept])
                columns[1].append(np.array(windows, np.uint64)[kept])
                columns[2].append(np.full(len(where), a, np.int64))
                columns[3].append(np.uint64(b << PLACE_BITS) | where.astype(np.uint64))
                columns[4].append(reach)
                if sum(map(len, columns[0])) > 200_000:
                    yield _columns(columns)
                    columns = [[], [], [], [], []]
            yield _columns(columns)

    return run


def chains(where: np.ndarray, windows: list[int], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that begin a run of overlapping equal windows of one text, and how far beyond each its last one lies.

    Periodic text has the same window again and again; all of it repeats, so its ends say enough.
    """
    n = len(where)
    if len(set(windows)) == n:
        return np.arange(n), np.zeros(n, np.int64)
    begun: dict[int, int] = {}
    kept, last = [], {}
    for i, (p, w) in enumerate(zip(where.tolist(), windows, strict=True)):
        j = begun.get(w)
        if j is not None and p - last[j] <= length:
            last[j] = p
        else:
            begun[w] = i
            kept.append(i)
            last[i] = p
    index = np.array(kept)
    return index, np.array([last[i] for i in kept]) - where[index]


def _columns(columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    arrays = [np.concatenate(c).view(np.int64) if c else np.zeros(0, np.int64) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=[f.split()[0] for f in PLACE.split(", ")])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of anchor, window, place: those whose anchor occurs at another row too, each place once.

    first: of its window; many: the window occurs again. Looks one row ahead, so a group of any size streams through.
    """
    names = ["anchor", "window", "text_a", "text_b", "reach"]
    before, waiting = None, None

    def judge(rows: np.ndarray, before: np.ndarray | None, after: np.ndarray | None) -> pa.RecordBatch:
        up = np.concatenate([before[:, None] if before is not None else ~rows[:, :1], rows[:, :-1]], axis=1)
        down = np.concatenate([rows[:, 1:], after[:, None] if after is not None else ~rows[:, -1:]], axis=1)
        same = [(rows[:k] == up[:k]).all(axis=0) for k in (1, 2, 4)]
        next_same = [(rows[:k] == down[:k]).all(axis=0) for k in (1, 2)]
        again = rows[4] > 0
        keep = (same[0] | next_same[0] | again) & ~same[2]
        columns = [pa.array(c[keep]) for c in rows] + [pa.array(~same[1][keep]), pa.array((same[1] | next_same[1] | again)[keep])]
        return pa.RecordBatch.from_arrays(columns, names=[*names, "first", "many"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(n).to_numpy() for n in names])
        if waiting is not None:
            yield judge(waiting, before, rows[:, 0])
            before = waiting[:, -1]
        waiting = rows
    if waiting is not None:
        yield judge(waiting, before, None)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text with its name, compressed."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = as_bytes(batch.column(1))
        ids = [text_id(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([a for a, _ in ids], pa.int64()), pa.array([b for _, b in ids], pa.int64()), pa.array([press.compress(t) for t in texts], pa.binary())],
            names=["doc_id", "text_a", "text_c", "packed"],
        )


WINDOW = "anchor long, key long, window long, many boolean, before int, size int, at int, low int, high int, content binary, giant boolean"
KINDS = tuple({"long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary()}[f.split()[1]] for f in WINDOW.split(", "))


def _cut(length: int):
    """Windows of the places listed beside each text (its first row of several equal texts); of hot anchors, their runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        left = length - ANCHOR
        for batch in batches:
            rows: list[tuple] = []
            for packed, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = expand.decompress(packed) if packed else b""
                for x in places:
                    at = x["place"]
                    before, content = min(at, left), text[max(at - left, 0) : at + length]
                    if x["hot"]:
                        rows += [(x["anchor"], key, x["window"], x["many"], before, len(content), *rest, x["giant"]) for key, *rest in runs_around(content, before, length)]
                    else:
                        rows.append((x["anchor"], 0, x["window"], x["many"], before, len(content), 0, 0, 0, content, False))
                    if len(rows) > 20_000:
                        yield _window_batch(rows)
                        rows = []
            yield _window_batch(rows)

    return run


def _window_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)], names=[f.split()[0] for f in WINDOW.split(", ")])


def _leftmost(content: bytes, before: int) -> int:
    """Least distance from the anchor at which a string may begin: one that holds its anchor several times counts at the
    leftmost only, else it would meet itself."""
    return max(content.rfind(content[before : before + ANCHOR], 0, before + ANCHOR - 1) + 1, 0) - before


def runs_around(content: bytes, before: int, length: int) -> list[tuple[int, int, int, int, bytes]]:
    """(key, at, low, high, around) of each run of whole blocks in a window that a string of `length` bytes can hold.

    `at` is the distance of the run from the anchor and the key its content and distance; strings begin `low` to `high`
    bytes before the run (0 to BLOCK - 1, each string with one run only), and `around` is what they hold besides it:
    the `high` bytes before and the bytes after the run.
    """
    size = (length - BLOCK + 1) // BLOCK * BLOCK
    least, out = _leftmost(content, before), []
    for off in range(before % BLOCK, len(content) - size + 1, BLOCK):
        at = off - before
        low, high = max(0, at, off + length - len(content)), min(BLOCK - 1, off, at - least)
        if low <= high:
            key = xxhash.xxh3_64_intdigest(content[off : off + size], seed=off - before + (1 << 20)) | 1
            out.append((key - (1 << 63), at, low, high, content[off - high : off] + content[off + size : off + length - low]))
    return out


def strings_around(low: int, high: int, around: bytes, rest: int) -> Iterator[tuple[int, bytes]]:
    """(bytes before the run, the string less the run) of each string of a row of `runs_around`; `rest` its size."""
    for back in range(low, high + 1):
        yield back, around[high - back : high - back + rest]


def repeats(windows: list[tuple[bytes, int, bool]], length: int) -> list[list[tuple[int, int]]]:
    """For each (content, bytes before the anchor, occurs again): the spans (start, end), counted from the anchor, that
    strings of `length` bytes around the anchor cover if they occur in another window, or in the same again."""
    spans: list[list[tuple[int, int]]] = [[] for _ in windows]
    for k, (content, before, many) in enumerate(windows):
        if many and len(content) >= length:
            spans[k].append((-before, len(content) - before))
    if len(windows) < 2:
        return spans
    # Blocks at fixed distances from the anchor, named by content; a block of one window only parts runs.
    names: dict[bytes, int] = {}
    uses: list[int] = []
    cut: list[list[int]] = []
    for content, before, _ in windows:
        row = []
        for at in range(before % BLOCK, len(content) - BLOCK + 1, BLOCK):
            name = names.setdefault(content[at : at + BLOCK], len(names))
            if name == len(uses):
                uses.append(0)
            uses[name] += 1
            row.append(name)
        cut.append(row)
    need = (length - BLOCK + 1) // BLOCK  # whole blocks in any string of `length` bytes
    runs: dict[tuple, list[int]] = {}
    for k, ((_, before, _), row) in enumerate(zip(windows, cut, strict=True)):
        zero = before // BLOCK
        low = high = zero
        while low > 0 and uses[row[low - 1]] > 1:
            low -= 1
        while high < len(row) and uses[row[high]] > 1:
            high += 1
        if high - low >= need:
            runs.setdefault((low - zero, *row[low:high]), []).append(k)
    if not runs or len(runs) == 1 and len(next(iter(runs.values()))) < 2:
        return spans
    text: list[int] = []
    origin: list[tuple[int, int]] = []  # run and block distance from the anchor, of each symbol
    listed = list(runs)
    for r, (low, *row) in enumerate(listed):
        text += [name + len(listed) for name in row] + [r]
        origin += [(r, low + i) for i in range(len(row))] + [(r, 1 << 30)]
    order = suffix_array(text)
    shared = common_prefixes(text, order)
    shared.append(0)
    first_start = [_leftmost(content, before) for content, before, _ in windows]
    group: list[tuple[int, int]] = []
    for k, i in enumerate(order):
        group.append(origin[i])
        if shared[k + 1] >= need:
            continue
        members = group
        group = []
        if len(members) > 1 or len(runs[listed[members[0][0]]]) > 1:
            _compare([(w, d * BLOCK) for r, d in members if d < 1 << 30 for w in runs[listed[r]]], windows, spans, length, first_start)
    return spans


def _compare(members: list[tuple[int, int]], windows: list, spans: list, length: int, first_start: list[int]) -> None:
    """Strings that begin up to a block before the shared blocks of `members` (window, distance), byte for byte."""
    for back in range(BLOCK):
        found: dict[bytes, list[tuple[int, int]]] = {}
        for w, at in members:
            start = at - back
            content, before, _ = windows[w]
            if first_start[w] <= start <= 0 and start + before + length <= len(content):
                found.setdefault(content[start + before : start + before + length], []).append((w, start))
        for places in found.values():
            if len(places) > 1:
                for w, start in places:
                    own = spans[w]
                    if own and own[-1][0] - 1 <= start <= own[-1][1]:
                        own[-1] = (min(own[-1][0], start), max(own[-1][1], start + length))
                    else:
                        own.append((start, start + length))


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


#: Spans of a window, or with `string` a string of a giant anchor by its hash, which begins at `low`.
FOUND = "anchor long, window long, low int, high int, string long"


def shared_strings(rows: list[tuple[int, int, int, int, bytes]], length: int) -> list[tuple[int, int, int]]:
    """(window, start, end) of what repeats among rows (window, at, low, high, around) of one key, by distance from the anchor."""
    rest = length - (length - BLOCK + 1) // BLOCK * BLOCK
    uses: dict[tuple[int, bytes], int] = {}
    for _, _, low, high, around in rows:
        for string in strings_around(low, high, around, rest):
            uses[string] = uses.get(string, 0) + 1
    out = []
    for window, at, low, high, around in rows:
        spans = joined([(at - string[0], at - string[0] + length) for string in strings_around(low, high, around, rest) if uses[string] > 1])
        out += [(window, *span) for span in spans]
    return out


def _judge(length: int):
    """Windows in order of anchor and key: spans of each, group by group; strings of giant anchors whose run occurs again."""
    rest = length - (length - BLOCK + 1) // BLOCK * BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out, waiting = (None, 0), {}, [], []

        def close() -> None:
            if held and not key[1]:
                for window, spans in zip(held, repeats([(x[-1], x[1], x[0]) for x in held.values()], length), strict=True):
                    out.extend((key[0], window, low, high, None) for low, high in joined(spans))
            elif held:
                out.extend((key[0], w, -x[1], x[2] - x[1], None) for w, x in held.items() if x[0])
                if len(held) > 1:
                    out.extend((key[0], *found, None) for found in shared_strings([(w, *x[3:]) for w, x in held.items()], length))
            held.clear()
            waiting.clear()

        def stream(window: int, many: bool, before: int, size: int, *row) -> None:
            """Nothing is kept but the first row of a key, until a second one comes."""
            if many:
                out.append((key[0], window, -before, size - before, None))
            if waiting:
                for w, (at, low, high, around) in [x for x in waiting if x] + [(window, row)]:
                    out.extend((key[0], w, at - back, None, xxhash.xxh3_64_intdigest(string, seed=key[1] & 0xFFFFFFFFFFFFFFFF) - (1 << 63)) for back, string in strings_around(low, high, around, rest))
                waiting[:] = [None]
            else:
                waiting.append((window, row))

        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                x = batch.slice(low, 2000).to_pydict()
                for anchor, part, window, *row, giant in zip(*x.values(), strict=True):
                    if (anchor, part) != key:
                        close()
                        key = anchor, part
                    if giant:
                        stream(window, *row)
                    else:
                        held[window] = row
                if len(out) > 20_000:
                    yield _found_batch(out)
                    out.clear()
        close()
        yield _found_batch(out)

    return run


def _found_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in FOUND.split(", ")])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start: long, end: long>>"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for doc_id, packed, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            text = expand.decompress(packed) if packed else b""
            spans = joined([(x["start"], x["end"]) for x in found or ()])
            parts, at = [], 0
            for start, end in spans:
                parts.append(text[at:start])
                at = end
            parts.append(text[at:])
            kept = b"".join(parts)
            rows.append((doc_id, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept, [{"start": a, "end": b} for a, b in spans]))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])


def _repeated_strings(strings: DataFrame, length: int) -> DataFrame:
    """Spans (anchor, window, low, high) of strings that occur twice, by counts; rows are as in `FOUND`."""
    again = strings.groupBy("anchor", "low", "string").count().where("count > 1").select("anchor", "low", "string")
    starts = strings.join(again, ["anchor", "low", "string"]).groupBy("anchor", "window").agg(F.array_sort(F.collect_set("low")).alias("starts"))  # `length` at most
    # Starts next to each other are one span.
    first = F.filter("starts", lambda x, i: (i == 0) | (F.element_at("starts", F.greatest(i, F.lit(1))) < x - 1))
    last = F.filter("starts", lambda x, i: (i == F.size("starts") - 1) | (F.element_at("starts", F.least(i + 2, F.size("starts"))) > x + 1))
    spans = starts.select("anchor", "window", F.inline(F.arrays_zip(first.alias("low"), last.alias("end"))))
    return spans.select("anchor", "window", "low", (F.col("end") + length).alias("high"))


def remove_repeats(documents: DataFrame, *, length: int = 200) -> DataFrame:
    """Cut every byte out of texts that a `length`-byte string covers which also starts anywhere else.

    One row per row of `documents` (doc_id, text): doc_id, n_bytes (UTF-8), n_removed, n_spans (maximal removed runs),
    kept_sha256, kept (bytes left; a cut may fall inside a character), spans (start, end). Strings never cross texts and
    are judged on the input. Null texts are empty. Rows that repeat, with or without doc_id, repeat each other's text.
    No rows, no result. `length` must be 64 or more.
    """
    if length < 2 * ANCHOR:
        raise ValueError("length must be 64 bytes or more")
    texts = documents.select(F.col("text").cast("string"))
    dealt = texts.mapInArrow(_places(length), PLACE).repartition("anchor").sortWithinPartitions("anchor", "window", "text_a", "text_b")
    places = materialise(dealt.mapInArrow(_repeated, PLACE + ", first boolean, many boolean"), "repeated-anchors")
    place = F.col("text_b").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    name = F.shiftrightunsigned("text_b", PLACE_BITS)

    packed = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_packed, "doc_id long, text_a long, text_c long, packed binary")
    # Equal texts would each answer: only one row of a text is asked.
    one = packed.select("text_a", "text_c", "packed").dropDuplicates(["text_a", "text_c"])
    first = places.where("first").select("text_a", name.alias("text_c"), place.alias("place"), "anchor", "window", "many")
    crowds = materialise(first.groupBy("anchor").count().where(F.col("count") > HOT), "hot-anchors")
    hot, giant = crowds.agg(F.count("*"), F.count(F.when(F.col("count") > GIANT, 1))).first()
    marked = first.join(crowds, "anchor", "left") if hot else first.withColumn("count", F.lit(None).cast("long"))

    x = F.struct("anchor", "window", "many", "place", F.col("count").isNotNull().alias("hot"), (F.coalesce("count", F.lit(0)) > GIANT).alias("giant"))
    asked = marked.groupBy("text_a", "text_c").agg(F.collect_list(x).alias("places"))
    windows = one.join(asked, ["text_a", "text_c"]).select("packed", "places").mapInArrow(_cut(length), WINDOW)
    found = windows.repartition("anchor", "key").sortWithinPartitions("anchor", "key").mapInArrow(_judge(length), FOUND)
    if giant:
        found = materialise(found, "repeats")
        found = found.where("string is null").select("anchor", "window", "low", "high").unionByName(_repeated_strings(found.where("string is not null"), length))
    spans = places.join(found, ["anchor", "window"]).select("text_a", name.alias("text_c"), F.struct((place + F.col("low")).cast("long").alias("start"), (place + F.col("reach") + F.col("high")).cast("long").alias("end")).alias("s"))
    by_text = spans.groupBy("text_a", "text_c").agg(F.collect_list("s").alias("found"))
    return packed.join(by_text, ["text_a", "text_c"], "left").select("doc_id", "packed", "found").mapInArrow(_remove, RESULT)
