"""Language-model scores: prediction by partial matching over bytes, beside a smoothed word model.

The byte model is a context trie of fixed depth: for each of the last `ORDER` bytes' contexts, how often each byte (or
the end of the text) followed in the training texts. The probability of a byte is taken from the longest context known.
If the byte was not seen there, an escape is paid (method C: as many escapes as different successors) and the next
shorter context is asked, without the successors that the longer one has ruled out (symbol exclusion); below the empty
context all symbols left are equally likely. All probabilities after a context add up to one.

Counts come from all training texts: each task counts the (context, byte) strings and the words it reads, and one
aggregation adds them up. The deepest level holds all others as sums, so only it is shuffled.

The trie is broadcast in portions of `portion` strings at most, dealt by the last two context bytes; those parts of the
trie that several portions need are the two shallowest levels, of 65,792 strings at most. While the trie fits one
portion, documents are read once for it, else once per portion; each round adds its positions to the scores. Words
are counted against a broadcast table of the most frequent (`head` words at most); the others meet their counts by join.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import as_bytes, held_out, per_worker
from vitrine.storage import materialise

ORDER = 5
START, END = 0xFE, 0xFF  # no byte of UTF-8
SYMBOLS = 256
PORTION = 4_000_000
HEAD = 200_000
CHUNK = 1 << 19  # bytes looked at together
EMPTY = np.uint64(1 << 63)
EIGHT = np.uint64(8)


def context_strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The (context, symbol) strings of `texts` with their end, as numbers, and where each text's strings begin."""
    pad = bytes([START]) * ORDER
    buffer = np.frombuffer(b"".join(pad + t + b"\xff" for t in texts), np.uint8)
    n = len(buffer) - ORDER
    grams = np.zeros(n, np.uint64)
    for j in range(ORDER + 1):
        grams <<= EIGHT
        grams |= buffer[j : j + n]
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    keep = buffer[ORDER:] != START
    return grams[keep], np.concatenate(([0], np.cumsum(sizes)[:-1]))


def pieces(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, strings, starts) for runs of texts of about CHUNK bytes; long texts come in parts."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if held and size + len(text) > CHUNK:
            yield (first, *context_strings(held))
            first, held, size = i, [], 0
        if len(text) > CHUNK:
            grams_before = bytes([START]) * ORDER
            for low in range(0, len(text) + 1, CHUNK):
                part = text[low : low + CHUNK] if low + CHUNK <= len(text) else text[low:] + b"\xff"
                buffer = np.frombuffer(grams_before + part, np.uint8)
                grams = np.zeros(len(part), np.uint64)
                for j in range(ORDER + 1):
                    grams <<= EIGHT
                    grams |= buffer[j : j + len(part)]
                grams_before = (grams_before + part)[-ORDER:]
                if len(part):
                    yield i, grams, np.zeros(1, np.int64)
            first = i + 1
            continue
        held.append(text)
        size += len(text)
    if held:
        yield (first, *context_strings(held))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and context strings of a task with their counts, sent on whenever they fill their tables."""
    words: Counter = Counter()
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def joined() -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in held] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([c for _, c in held] or [np.zeros(0, np.int64)])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts

    def table(word: list, gram: np.ndarray, n: list | np.ndarray) -> pa.RecordBatch:
        size = len(word) + len(gram)
        gram_column = pa.array(gram.view(np.int64)) if len(gram) else pa.nulls(size, pa.int64())
        word_column = pa.array(word, pa.binary()) if word else pa.nulls(size, pa.binary())
        return pa.RecordBatch.from_arrays([word_column, gram_column, pa.array(n, pa.int64())], names=["word", "gram", "n"])

    none = np.zeros(0, np.uint64)
    for batch in batches:
        texts = [t.lower() for t in as_bytes(batch.column(0))]
        for text in texts:
            words.update(text.split())
        if len(words) > 300_000:
            yield table(list(words.keys()), none, list(words.values()))
            words.clear()
        for _, grams, _ in pieces(texts):
            keys, counts = np.unique(grams, return_counts=True)
            held.append((keys, counts))
            if sum(len(k) for k, _ in held) > 2_000_000:
                held[:] = [joined()]
                if len(held[0][0]) > 1_000_000:
                    yield table([], *held.pop())
    yield table(list(words.keys()), none, list(words.values()))
    yield table([], *joined())


class Level:
    """Contexts of one length: strings with counts; per context total, number of successors, and what it excludes below."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, below: Level | None):
        self.keys, self.counts = keys, _narrow(counts)
        before = keys >> EIGHT  # in order, as the keys are
        starts = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1]))) if len(keys) else np.zeros(0, np.int64)
        self.contexts = before[starts]
        del before
        self.total = _narrow(np.add.reduceat(counts, starts, dtype=np.int64)) if len(keys) else counts
        self.kinds = np.diff(np.append(starts, len(keys))).astype(np.uint16)
        self.excluded = np.zeros(len(self.contexts), np.int64)
        if below is not None and len(keys):
            mask = np.uint64((1 << (8 * below.width)) - 1)
            gone = np.zeros(len(keys), below.counts.dtype)
            for low in range(0, len(keys), CHUNK):
                at, found = _search(below.keys, keys[low : low + CHUNK] & mask)
                gone[low : low + CHUNK] = np.where(found, below.counts[at], 0)
            self.excluded = _narrow(np.add.reduceat(gone, starts, dtype=np.int64))

    width = 1


def _search(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order with their counts added up; what is so already is not copied."""
    if bool(np.all(keys[1:] > keys[:-1])):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    del order
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], np.add.reduceat(counts, starts)


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """The numbers (none negative) in four bytes if they fit; sums of them are taken in eight."""
    return numbers.astype(np.uint32) if len(numbers) and int(numbers.max()) < 1 << 32 else numbers


class Trie:
    """One portion of the context trie. keys, counts: deepest level; shallow: (keys, counts) of contexts of one byte."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, shallow: tuple[np.ndarray, np.ndarray]):
        sums, source = {}, _sums(keys, counts)
        for order in range(ORDER, -1, -1):  # each level from the next deeper one, whose strings are fewer than all
            if order < ORDER:
                mask = np.uint64((1 << (8 * (order + 1))) - 1)
                source = shallow if order == 1 else source
                source = _sums(source[0] & mask, source[1])
            sums[order] = source
        del source
        self.levels: list[Level] = []
        for order in range(ORDER + 1):
            level = Level(*sums.pop(order), self.levels[-1] if self.levels else None)
            level.width = order + 1
            self.levels.append(level)
        top = self.levels[-1]
        bits = max(4, int(len(top.keys) * 2).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.slots = np.full(1 << bits, EMPTY)
        self.logs = np.zeros(1 << bits, np.float32)
        ends = np.cumsum(top.kinds, dtype=np.int64)
        for high in range(0, len(ends), CHUNK):  # runs of contexts, so that little is held beside the table
            kinds = top.kinds[high : high + CHUNK]
            run = slice(int(ends[high]) - int(kinds[0]), int(ends[min(high + CHUNK, len(ends)) - 1]))
            both = top.total[high : high + CHUNK].astype(np.int64) + kinds
            self._fill(top.keys[run], np.log10(top.counts[run] / np.repeat(both, kinds)).astype(np.float32))

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        at = self._home(keys)
        while len(keys):
            free = self.slots[at] == EMPTY
            where, first = np.unique(at[free], return_index=True)
            index = np.flatnonzero(free)[first]
            self.slots[where], self.logs[where] = keys[index], values[index]
            left = np.ones(len(keys), bool)
            left[index] = False
            keys, values, at = keys[left], values[left], (at[left] + 1) & self.mask

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each string after its context."""
        at = self._home(grams)
        seen = self.slots[at]
        out = self.logs[at].astype(np.float64)
        wrong = np.flatnonzero(seen != grams)
        at = at[wrong]
        missing = []
        while len(wrong):
            absent = self.slots[at] == EMPTY
            missing.append(wrong[absent])
            wrong, at = wrong[~absent], (at[~absent] + 1) & self.mask
            hit = self.slots[at] == grams[wrong]
            out[wrong[hit]] = self.logs[at[hit]]
            wrong, at = wrong[~hit], at[~hit]
        absent = np.concatenate(missing) if missing else np.zeros(0, np.int64)
        if len(absent):
            unseen, inverse = np.unique(grams[absent], return_inverse=True)
            out[absent] = self.escape(unseen)[inverse]
        return out

    def escape(self, grams: np.ndarray) -> np.ndarray:
        """The same for any strings, by walking down from the longest context."""
        out = np.zeros(len(grams))
        open_ = np.ones(len(grams), bool)
        gone_total, gone_kinds = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
        for order in range(ORDER, -1, -1):
            level = self.levels[order]
            key = grams & np.uint64((1 << (8 * (order + 1))) - 1)
            at, known = _search(level.contexts, key >> EIGHT)
            if not len(level.contexts):
                continue
            total = np.where(known, level.total[at].astype(np.int64) - gone_total, 0)
            kinds = np.where(known, level.kinds[at].astype(np.int64) - gone_kinds, 0)
            where, found = _search(level.keys, key)
            found &= open_ & known
            out[found] += np.log10(level.counts[where[found]] / (total + kinds)[found])
            open_ &= ~found
            pay = open_ & known & (kinds > 0)
            out[pay] += np.log10(kinds[pay] / (total + kinds)[pay])
            gone_total = np.where(known, level.excluded[at], gone_total)
            gone_kinds = np.where(known, level.kinds[at], gone_kinds)
        last = self.levels[0].kinds[0] if len(self.levels[0].kinds) else 0
        out[open_] -= math.log10(max(SYMBOLS - int(last), 1))
        return out


def _portions(by_tail: list[tuple[int, int]], limit: int) -> np.ndarray:
    """Number of the portion of each pair of last context bytes (65,536 entries)."""
    out, portion, filled = np.zeros(65536, np.int32), 0, 0
    for tail, n in by_tail:
        if filled and filled + n > limit:
            portion, filled = portion + 1, 0
        out[tail] = portion
        filled += n
    return out


ROW = "part string, number long, doc_id long, held_out boolean, text string, n_tokens long, head_known long, head_log double, score double, tail array<struct<word: binary, n: long>>"
TAIL = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))


def scores(documents: DataFrame, *, modulus: int = 7, portion: int = PORTION, head: int = HEAD) -> DataFrame:
    """One row per row of `documents` (doc_id, text), scored by models of those whose crc32(doc_id as text) mod
    `modulus` is not 2.

    Columns: doc_id, held_out, n_tokens (words split at ASCII white space after lowering A-Z, and one end), n_known
    (tokens seen in training), train_tokens, base_score (add-one word model, log10), score (log10 probability of the
    bytes and the end by the trie). Null texts are empty: one token, the end. Rows without doc_id are training rows.
    Without training rows all symbols are equally likely. No rows, no result.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    training = rows.where(~held_out("doc_id", modulus))
    counts = materialise(training.select("text").mapInArrow(_count, "word binary, gram long, n long").groupBy("word", "gram").agg(F.sum("n").alias("n")), "corpus-counts")
    words, grams = counts.where("word is not null").select("word", "n"), counts.where("gram is not null").select("gram", "n")
    ends = grams.where(F.col("gram").bitwiseAND(F.lit(255)) == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sizes = words.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).collect()
    total, kinds = sum(r.tokens for r in sizes) + ends, sum(r.words for r in sizes) + (ends > 0)
    least, kept = 1 << (max([r.k for r in sizes], default=0) + 1), 0
    for r in sorted(sizes, key=lambda r: -r.k):
        kept += r.words
        if kept > head:
            break
        least = 1 << r.k
    frequent = spark.sparkContext.broadcast({bytes(r.word): r.n for r in words.where(F.col("n") >= least).toLocalIterator()})

    low16 = F.col("gram").bitwiseAND(F.lit(0xFFFF))
    shallow = grams.groupBy(low16.alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    tail = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    by_tail = sorted((r.t, r.n) for r in grams.groupBy(tail.alias("t")).agg(F.count("*").alias("n")).collect())
    portion_of = _portions(by_tail, portion)
    rounds = int(portion_of.max()) + 1

    table = rows.select("doc_id", held_out("doc_id", modulus).alias("held_out"), "text")
    for number in range(rounds):
        tails = [t for t, _ in by_tail if portion_of[t] == number]
        own = grams if rounds == 1 else grams.where(tail.between(min(tails, default=0), max(tails, default=0)))
        deep = own.toArrow()
        model = spark.sparkContext.broadcast((_arrays(deep), _arrays(shallow), portion_of))
        table = _score(table, model, frequent, number, rounds)
        if rounds > 1:
            table = materialise(table, "scored-documents")
    table = table.drop("text") if rounds > 1 else materialise(table.drop("text"), "scored-documents")

    rest = table.select("part", "number", F.explode("tail").alias("t")).select("part", "number", "t.word", F.col("t.n").alias("k"))
    seen = rest.join(words.where(F.col("n") < least), "word")
    tails = seen.groupBy("part", "number").agg(F.sum("k").alias("tail_known"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("tail_log"))
    none = F.lit(math.log10(total + kinds + 1))
    return table.join(tails, ["part", "number"], "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.coalesce("tail_log", F.lit(0.0)) + F.lit(math.log10(ends + 1)) - F.col("n_tokens") * none).alias("base_score"),
        "score",
    )


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = table.column(0).to_numpy().view(np.uint64), table.column(1).to_numpy()
    order = np.argsort(keys)
    return keys[order], counts[order]


def _score(table: DataFrame, model, frequent, number: int, rounds: int) -> DataFrame:
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deep, shallow, portion_of = model.value
        trie = per_worker(token, lambda: Trie(*deep, shallow))
        common = frequent.value
        part, row = uuid.uuid4().hex, 0
        for batch in (whole.slice(low, 500) for whole in batches for low in range(0, max(whole.num_rows, 1), 500)):
            x = {name: batch.column(name) for name in batch.schema.names}
            texts = [t.lower() for t in as_bytes(x["text"])]
            sums = np.zeros(len(texts))
            for first, strings, starts in pieces(texts):
                if rounds > 1:
                    own = portion_of[((strings >> EIGHT) & np.uint64(0xFFFF)).astype(np.int64)] == number
                    values = np.zeros(len(strings))
                    values[own] = trie.log10(strings[own])
                else:
                    values = trie.log10(strings)
                sums[first : first + len(starts)] += np.add.reduceat(values, starts)
            if "score" in x:
                x["score"] = pa.array(x["score"].to_numpy(zero_copy_only=False) + sums)
            else:
                n_tokens, known, logs, rest = [], [], [], []
                for text in texts:
                    words = text.split()
                    found = [common.get(w) for w in words]
                    n_tokens.append(len(words) + 1)
                    values = np.array([n for n in found if n is not None], np.float64)
                    known.append(len(values))
                    logs.append(float(np.log10(values + 1).sum()))
                    others = Counter([w for w, n in zip(words, found, strict=True) if n is None]) if len(values) < len(words) else {}
                    rest.append([{"word": w, "n": n} for w, n in others.items()])
                x |= {
                    "part": pa.array([part] * len(texts), pa.string()), "number": pa.array(range(row, row + len(texts)), pa.int64()),
                    "n_tokens": pa.array(n_tokens, pa.int64()), "head_known": pa.array(known, pa.int64()), "head_log": pa.array(logs, pa.float64()),
                    "score": pa.array(sums), "tail": pa.array(rest, TAIL),
                }
                row += len(texts)
            names = [field.split(":")[0].split()[0] for field in ROW.replace("word: binary, n: long", "").split(", ")]
            if rounds == 1:
                x["text"] = pa.nulls(len(texts), pa.string())
            yield pa.RecordBatch.from_arrays([x[n] for n in names], names=names)

    return table.mapInArrow(run, ROW)
