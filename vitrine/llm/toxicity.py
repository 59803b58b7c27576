"""Toxicity: a convolutional text classifier, trained here in numpy, with thresholds calibrated by language.

A word's vector is the sum of two rows of hashed embedding tables, so two words are mixed up only if both rows agree.
Filters of several widths run over the whole text, each keeps its maximum, and a logistic layer turns the maxima into a
probability. Training needs gradients at the maxima only.

`train` fits on every labelled document outside the held-out part. They are dealt out in shards; in each round every shard
goes once through its texts from the model all share, and the changes are averaged, each row of a table over the shards
that changed it. A fifth of the documents is kept from training to choose, for each language (told from the text's own
function words), the threshold of the best F0.5; probabilities are then bent so that this threshold becomes 0.3 in every
language. Scoring reads whole texts where they lie, with no shuffle; the model has a fixed size.
"""

from __future__ import annotations

import copy
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import as_bytes, held_out, per_worker
from vitrine.storage import discard, materialise

ROWS = 1 << 17  # of each embedding table; one more, of zeros, is the empty word
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
CUT = 0.3
STEPS, BATCH = 900, 32  # steps at least, of so many texts
SHARD_TEXTS, SHARD_WORDS = 8000, 4_000_000  # about, so that a task holds no more
EXACT = 1 << 30  # changes are added up as whole multiples of 1 / EXACT, in any order alike
BINS = 1 << 14  # of probabilities, when a threshold is chosen
BLOCK = 1 << 16  # words convolved at once
LETTERS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

#: Frequent function words, by which a text's language is told.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on with as be by".split(),
    "de": "der die und das ist nicht ein den zu mit sich des auf dem eine".split(),
    "fr": "le la les et des est une que qui dans pour pas sur par un".split(),
    "es": "el los las y que en una por con se del para no su es".split(),
}
OTHER = len(FUNCTION_WORDS)
VOTES = {zlib.crc32(w.encode()): np.array([w in v for v in FUNCTION_WORDS.values()], float) for vs in FUNCTION_WORDS.values() for w in vs}


def word_hashes(text: bytes) -> np.ndarray:
    words = text.translate(LETTERS).split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


VOTED = np.array(sorted(VOTES), np.uint32)
BALLOTS = np.array([VOTES[k] for k in sorted(VOTES)])


def language(hashes: np.ndarray) -> int:
    """Index of the language with most function words, OTHER if there are none."""
    at = np.minimum(np.searchsorted(VOTED, hashes), len(VOTED) - 1)
    at = at[VOTED[at] == hashes]
    return int((np.bincount(at, minlength=len(VOTED)) @ BALLOTS).argmax()) if len(at) else OTHER


def rows_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the two tables: the hash's low bits, and bits of its product with a constant."""
    second = (hashes * np.uint32(0x9E3779B1)) >> np.uint32(15)
    return (hashes & np.uint32(ROWS - 1)).astype(np.int32), second.astype(np.int32)


@dataclass
class Model:
    """`ready` is False if there was nothing to tell apart; then every score is 0."""

    first: np.ndarray
    second: np.ndarray
    filters: list[np.ndarray]  # for each width: (width, SIZE, FILTERS)
    bias: np.ndarray  # of all filters
    weights: np.ndarray
    offset: float
    thresholds: np.ndarray  # by language
    ready: bool = True

    @classmethod
    def new(cls, seed: int = 7) -> Model:
        draw = np.random.default_rng(seed)
        table = lambda: np.concatenate([draw.normal(0, 0.05, (ROWS, SIZE)), np.zeros((1, SIZE))]).astype(np.float32)
        filters = [draw.normal(0, 0.5, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        return cls(table(), table(), filters, np.zeros(n, np.float32), draw.normal(0, 0.3, n).astype(np.float32), 0.0, np.full(OTHER + 1, 0.5))

    def maxima(self, a: np.ndarray, b: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Filter responses at every position, and their maxima over each text (see `lay_out`)."""
        x = self.first[a] + self.second[b]
        n = len(x)
        out = np.empty((n, FILTERS * len(WIDTHS)), np.float32)
        for k, filters in enumerate(self.filters):
            part = out[:, k * FILTERS : (k + 1) * FILTERS]
            np.matmul(x, filters[0], out=part)
            for j in range(1, len(filters)):
                part[: n - j] += (x @ filters[j])[j:]
        return out, np.maximum.reduceat(out, edges, axis=0)[::2]

    def probability(self, maxima: np.ndarray) -> np.ndarray:
        z = np.maximum(maxima + self.bias, 0) @ self.weights + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def dense(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.weights]

    def bend(self, p: np.ndarray, languages: np.ndarray) -> np.ndarray:
        t = self.thresholds[languages]
        return np.where(p < t, CUT * p / t, CUT + (1 - CUT) * (p - t) / (1 - t))


GAP = max(WIDTHS) - 1


def lay_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of both tables for texts one after the other, and first and last edge of each in turn.

    A text is one empty word and its words; empty words follow, so that no filter that begins in a text sees another.
    """
    head, gap = np.full(1, ROWS, np.int32), np.full(GAP, ROWS, np.int32)
    pairs = [rows_of(t) for t in texts]
    a = np.concatenate([part for r, _ in pairs for part in (head, r, gap)])
    b = np.concatenate([part for _, r in pairs for part in (head, r, gap)])
    sizes = np.array([(len(t) + 1, GAP) for t in texts]).ravel()
    return a, b, np.concatenate(([0], np.cumsum(sizes)[:-1]))


def probabilities(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Unbent probability of each text; long texts are convolved in overlapping parts and keep the maxima of all."""
    best = np.full((len(texts), FILTERS * len(WIDTHS)), -np.inf, np.float32)
    held, owners, size = [], [], 0

    def flush() -> None:
        if held:
            best[owners] = model.maxima(*lay_out(held))[1]
        held.clear(), owners.clear()

    for i, text in enumerate(texts):
        if len(text) >= BLOCK:
            a, b, _ = lay_out([text])
            for low in range(0, len(text) + 1, BLOCK):
                part = slice(low, min(low + BLOCK, len(text) + 1) + GAP)
                edges = np.array([0, part.stop - low - GAP])
                best[i] = np.maximum(best[i], model.maxima(a[part], b[part], edges)[1][0])
            continue
        if size + len(text) > BLOCK:
            flush()
            size = 0
        held.append(text)
        owners.append(i)
        size += len(text)
    flush()
    return model.probability(best)


@dataclass
class Squares:
    """Sums of squared gradients, by which steps get shorter."""

    dense: list[np.ndarray]
    tables: np.ndarray
    offset: float = 1e-3

    @classmethod
    def new(cls, model: Model) -> Squares:
        return cls([np.full(p.shape, 1e-3, np.float32) for p in model.dense()], np.full((2, ROWS), 1e-3, np.float32))


def learn(model: Model, squares: Squares, texts: list[np.ndarray], labels: np.ndarray, heavier: float, epochs: int, draw: np.random.Generator, *, rate: float = 0.1, batch: int = BATCH) -> None:
    """Go through the texts `epochs` times, changing `model` and `squares`; toxic ones weigh `heavier`."""
    labels = np.asarray(labels, np.float32)
    weight = np.where(labels > 0, heavier, 1.0)
    dense = model.dense()
    for _ in range(epochs):
        order = draw.permutation(len(texts))
        for low in range(0, len(order), batch):
            some = order[low : low + batch]
            a, b, edges = lay_out([texts[i] for i in some])
            responses, top = model.maxima(a, b, edges)
            hidden = np.maximum(top + model.bias, 0)
            z = hidden @ model.weights + model.offset
            error = ((1 / (1 + np.exp(-np.clip(z, -40, 40)))) - labels[some]) * weight[some] / len(some)
            back = error[:, None] * model.weights * (top + model.bias > 0)
            grads = [np.zeros_like(f) for f in model.filters]
            where = np.empty(top.shape, np.int64)
            for i, (s, e) in enumerate(edges.reshape(-1, 2)):
                where[i] = s + responses[s:e].argmax(axis=0)
            rows_a, rows_b, changes = [], [], []
            for k, filters in enumerate(model.filters):
                g, at = back[:, k * FILTERS : (k + 1) * FILTERS], where[:, k * FILTERS : (k + 1) * FILTERS]
                for j in range(len(filters)):
                    place = np.minimum(at + j, len(a) - 1)
                    x = model.first[a[place]] + model.second[b[place]]
                    grads[k][j] = np.einsum("if,ifs->sf", g, x)
                    live = (g != 0) & (a[place] < ROWS)
                    rows_a.append(a[place][live])
                    rows_b.append(b[place][live])
                    changes.append((g[:, :, None] * filters[j].T[None])[live])
            for p, g, s in zip(dense, [*grads, back.sum(axis=0), hidden.T @ error], squares.dense, strict=True):
                s += g * g
                p -= (rate * g / np.sqrt(s)).astype(np.float32)
            g = float(error.sum())
            squares.offset += g * g
            model.offset -= rate * g / squares.offset**0.5
            change = np.concatenate(changes)
            for t, (table, rows) in enumerate(((model.first, np.concatenate(rows_a)), (model.second, np.concatenate(rows_b)))):
                found, inverse = np.unique(rows, return_inverse=True)
                g = np.zeros((len(found), SIZE), np.float32)
                np.add.at(g, inverse, change)
                squares.tables[t, found] += (g * g).mean(axis=1)
                table[found] -= rate * g / np.sqrt(squares.tables[t, found])[:, None]


def _heavier(clean: int, toxic: int) -> float:
    return max(1.0, (clean / toxic) ** 0.5)


def _epochs(texts: int, steps: int, batch: int) -> int:
    return max(4, -(-steps * batch // max(texts, 1)))


def fit(texts: list[np.ndarray], labels: np.ndarray, *, steps: int = STEPS, rate: float = 0.1, batch: int = BATCH, seed: int = 7) -> Model:
    """`train` in one process, for texts that are all at hand: four fifths train, thresholds come from the others."""
    model = Model.new(seed)
    labels = np.asarray(labels, np.float32)
    if not len(labels) or labels.min() == labels.max():
        model.ready = False
        return model
    draw = np.random.default_rng(seed)
    aside = np.zeros(len(texts), bool)
    aside[draw.permutation(len(texts))[: len(texts) // 5]] = True
    chosen = np.flatnonzero(~aside)
    heavier = _heavier((labels == 0).sum(), (labels > 0).sum())
    learn(model, Squares.new(model), [texts[i] for i in chosen], labels[chosen], heavier, _epochs(len(chosen), steps, batch), draw, rate=rate, batch=batch)
    texts, labels = [texts[i] for i in np.flatnonzero(aside)], labels[aside]
    set_thresholds(model, np.array([language(t) for t in texts]), probabilities(model, texts), labels, np.ones(len(texts), np.int64))
    return model


def set_thresholds(model: Model, languages: np.ndarray, p: np.ndarray, labels: np.ndarray, n: np.ndarray) -> None:
    """Thresholds from rows that stand for `n` texts each."""
    model.thresholds[:] = best_threshold(p, labels, n) if n[labels > 0].sum() >= ENOUGH else 0.5
    for k in range(OTHER):
        own = languages == k
        if n[own & (labels > 0)].sum() >= ENOUGH:
            model.thresholds[k] = best_threshold(p[own], labels[own], n[own])


ENOUGH = 20  # toxic texts that a threshold is chosen by


def best_threshold(p: np.ndarray, labels: np.ndarray, n: np.ndarray) -> float:
    """Middle of the gap below the best F0.5 (precision counts double); the higher of equals, so doubtful texts pass."""
    order = np.argsort(-p, kind="stable")
    p, n, good = p[order], n[order], n[order] * (labels[order] > 0)
    hit, said = np.cumsum(good), np.cumsum(n)
    score = 1.25 * hit / (said + 0.25 * good.sum())
    score[:-1][p[:-1] == p[1:]] = -1  # a threshold can't part equal probabilities
    at = int(score.argmax())
    below = p[at + 1] if at + 1 < len(p) else 0.0
    return float(np.clip((p[at] + below) / 2, 0.1, 0.9))


WIDE = SIZE + 1  # numbers in a row of changes: those of a table's row and its square
CHANGES = "part int, at int, " + ", ".join(f"v{k} long" for k in range(WIDE))


def _vector(model: Model, squares: Squares) -> np.ndarray:
    """All but the tables, in rows of WIDE."""
    parts = [*model.dense(), [model.offset], *squares.dense, [squares.offset]]
    flat = np.concatenate([np.ravel(p).astype(np.float64) for p in parts])
    return np.concatenate([flat, np.zeros(-len(flat) % WIDE)]).reshape(-1, WIDE)


def _changes(model: Model, squares: Squares, was: Model, squares_was: Squares) -> pa.Table:
    """What has changed: rows of the tables (parts 0 and 1) and all else (part 2)."""
    blocks = []
    for t, (new, old) in enumerate(((model.first, was.first), (model.second, was.second))):
        at = np.flatnonzero(squares.tables[t] != squares_was.tables[t])
        step = np.column_stack([new[at].astype(np.float64) - old[at], squares.tables[t, at].astype(np.float64) - squares_was.tables[t, at]])
        blocks.append((t, at, step))
    step = _vector(model, squares) - _vector(was, squares_was)
    blocks.append((2, np.arange(len(step)), step))
    whole = np.rint(np.concatenate([step for *_, step in blocks]) * EXACT).astype(np.int64)
    part = np.concatenate([np.full(len(at), k, np.int32) for k, at, _ in blocks])
    place = np.concatenate([at for _, at, _ in blocks]).astype(np.int32)
    return pa.table([pa.array(part), pa.array(place), *(pa.array(np.ascontiguousarray(c)) for c in whole.T)], names=["part", "at", *(f"v{k}" for k in range(WIDE))])


def _follow(model: Model, squares: Squares, part: np.ndarray, at: np.ndarray, step: np.ndarray) -> None:
    """Apply averaged changes."""
    for t, table in enumerate((model.first, model.second)):
        own = part == t
        table[at[own]] += step[own, :SIZE].astype(np.float32)
        squares.tables[t, at[own]] += step[own, SIZE].astype(np.float32)
    flat = _vector(model, squares)
    own = part == 2
    flat[at[own]] += step[own]
    flat, low = flat.ravel(), 0
    for owner, pieces in ((model, model.dense()), (squares, squares.dense)):
        for piece in pieces:
            piece[...] = flat[low : low + piece.size].reshape(piece.shape)
            low += piece.size
        owner.offset = float(flat[low])
        low += 1


def _labelled(documents: DataFrame, labels: DataFrame, modulus: int) -> DataFrame:
    """Word hashes and label of every labelled document outside the held-out part, and whether it is kept from training."""
    usable = labels.where("toxic is not null and doc_id is not null").where(~held_out("doc_id", modulus)).select(F.col("doc_id").cast("long").alias("_id"), (F.col("toxic") > 0).alias("_toxic"))
    usable = usable.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    texts = documents.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text")).where("_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [word_hashes(t).tobytes() for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.binary())], names=["_id", "hashes"])

    # Labels grow with the documents, so both are shuffled at any size; hashes are smaller than texts.
    found = texts.mapInArrow(run, "_id long, hashes binary").join(usable.hint("shuffle_hash"), "_id")
    aside = F.pmod(F.xxhash64(F.lit("aside"), "_id"), F.lit(5)) == 0
    return found.select("_id", "hashes", F.col("_toxic").alias("toxic"), aside.alias("aside"))


def _round(rows: DataFrame, shards: int, model: Model, squares: Squares, heavier: float, epochs: int, seed: int) -> None:
    """Every shard learns from the same start, and the model takes the average of the changes."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((model, squares))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        was = shared.value
        model, squares = copy.deepcopy(was)
        found = sorted(zip(table["_id"].to_pylist(), table["hashes"].to_pylist(), table["toxic"].to_pylist(), strict=True))
        texts = [np.frombuffer(h, np.uint32) for _, h, _ in found]
        learn(model, squares, texts, np.array([t for *_, t in found]), heavier, epochs, np.random.default_rng([seed, key[0].as_py()]))
        return _changes(model, squares, *was)

    shard = F.pmod(F.xxhash64("_id", "hashes"), F.lit(shards)).cast("int").alias("shard")
    changes = rows.select(shard, "_id", "hashes", "toxic").groupBy("shard").applyInArrow(run, CHANGES)
    sums = materialise(changes.groupBy("part", "at").agg(F.count("*").alias("n"), *[F.sum(f"v{k}").alias(f"v{k}") for k in range(WIDE)]), "toxicity-round")
    got = sums.toArrow()  # rows of the model at most
    discard(sums)
    shared.destroy()
    step = np.column_stack([got[f"v{k}"].to_numpy() for k in range(WIDE)]) / EXACT / got["n"].to_numpy()[:, None]
    _follow(model, squares, got["part"].to_numpy(), got["at"].to_numpy(), step)


def _calibrate(rows: DataFrame, model: Model) -> None:
    """Thresholds from all rows, counted by language, label and BINS of the probability."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [np.frombuffer(h, np.uint32) for h in batch.column(0).to_pylist()]
            if texts:
                bins = np.rint(np.concatenate([probabilities(shared.value, texts[i : i + 256]) for i in range(0, len(texts), 256)]) * BINS)
                yield pa.RecordBatch.from_arrays([pa.array([language(t) for t in texts], pa.int32()), pa.array(bins.astype(np.int32)), batch.column(1)], names=["language", "bin", "toxic"])

    counted = rows.select("hashes", "toxic").mapInArrow(run, "language int, bin int, toxic boolean").groupBy("language", "bin", "toxic").count().orderBy("language", "bin", "toxic").toArrow()
    if counted.num_rows:
        set_thresholds(model, counted["language"].to_numpy(), counted["bin"].to_numpy() / BINS, counted["toxic"].to_numpy(), counted["count"].to_numpy())


def train(documents: DataFrame, labels: DataFrame, *, modulus: int = 4, seed: int = 7) -> Model:
    """Model fitted on all labelled rows whose crc32(doc_id as text) mod `modulus` is not 2.

    Labels that are null or have no document teach nothing; an id with several labels counts as toxic if one says so.
    With fewer than two different labels nothing is told apart and every score is 0.
    """
    model = Model.new(seed)
    rows = materialise(_labelled(documents, labels, modulus), "toxicity-labelled")
    size = (F.octet_length("hashes") / 4).cast("long")
    counts = {(r["toxic"], r["aside"]): r for r in rows.groupBy("toxic", "aside").agg(F.count("*").alias("n"), F.sum(size).alias("words")).collect()}
    taught = {t: counts[t, False]["n"] if (t, False) in counts else 0 for t in (False, True)}
    model.ready = all(taught.values())
    if model.ready:
        n, words = sum(taught.values()), sum(r["words"] for (_, aside), r in counts.items() if not aside)
        shards = max(1, -(-n // SHARD_TEXTS), -(-words // SHARD_WORDS))
        every = _epochs(n, STEPS, BATCH)
        rounds, epochs = (1, every) if shards == 1 else (every, 1)  # one shard has nobody to meet
        squares = Squares.new(model)
        for k in range(rounds):
            _round(rows.where("not aside"), shards, model, squares, _heavier(taught[False], taught[True]), epochs, seed + k)
        _calibrate(rows.where("aside"), model)
    discard(rows)
    return model


def with_scores(documents: DataFrame, model: Model) -> DataFrame:
    """`documents` with one more column _score (0 to 1); only `text` is read. Null texts count as empty."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    token, at = uuid.uuid4().hex, documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = per_worker(token, lambda: shared.value)
        for batch in batches:
            score = np.zeros(batch.num_rows)
            texts = as_bytes(batch.column(at))
            for low in range(0, len(texts) if model.ready else 0, 256):
                hashes = [word_hashes(t) for t in texts[low : low + 256]]
                score[low : low + 256] = model.bend(probabilities(model, hashes), np.array([language(h) for h in hashes]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "_score"])

    return documents.mapInArrow(run, ", ".join([f"`{c}` {kind}" for c, kind in documents.dtypes] + ["_score double"]))


def toxicity(documents: DataFrame, labels: DataFrame, *, modulus: int = 4) -> DataFrame:
    """One row per row of `documents` (doc_id, text): doc_id, held_out, score, predicted (1 if score >= 0.3).

    See `train` for labels and `with_scores` for nulls. No rows, no result.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = with_scores(rows, train(rows, labels, modulus=modulus))
    return scored.select("doc_id", held_out("doc_id", modulus).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= CUT).cast("int").alias("predicted"))


def clean(documents: DataFrame, labels: DataFrame, *, modulus: int = 4) -> DataFrame:
    """`documents` without the rows that the classifier rejects; all columns as they were."""
    return with_scores(documents, train(documents, labels, modulus=modulus)).where(F.col("_score") < CUT).select(*documents.columns)
