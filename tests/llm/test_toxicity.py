import random
import zlib

import numpy as np
import pytest
from helpers import AWKWARD, frame, with_extras

from vitrine.llm import toxicity
from vitrine.llm.toxicity import fit, language, probabilities, train, word_hashes

MEAN = ["vile", "nasty"]
CLEAN = "the and of river stone walk light paper cloud green seven table".split()


def _text(draw, toxic):
    words = [draw.choice(CLEAN) + draw.choice(["", "s", "er"]) for _ in range(draw.randrange(5, 60))]
    if toxic:
        for _ in range(draw.randrange(1, 3)):
            words.insert(draw.randrange(len(words)), draw.choice(MEAN).title() + ".")
    return " ".join(words)


def _rows(n, seed):
    draw = random.Random(seed)
    rows = [(1000 + i, draw.random() < 0.4) for i in range(n)]
    return [(i, _text(draw, t), "en", "s", 1) for i, t in rows], [(i, 1, int(t)) for i, t in rows]


@pytest.fixture(scope="module")
def model():
    rows, labels = _rows(400, 1)
    return fit([word_hashes(r[1].encode()) for r in rows], np.array([x[2] for x in labels]))


def test_maxima_are_those_of_a_plain_convolution(model):
    texts = [word_hashes(_text(random.Random(i), i % 2).encode()) for i in range(6)] + [word_hashes(b""), word_hashes(b"one")]
    a, b, edges = toxicity.lay_out(texts)
    _, top = model.maxima(a, b, edges)
    for text, found in zip(texts, top, strict=True):
        rows_a, rows_b = toxicity.rows_of(text)
        pad = np.zeros((4, toxicity.SIZE))
        x = np.concatenate([pad[:1], model.first[rows_a] + model.second[rows_b], pad])
        plain = [max(float((x[p : p + len(f)] * f[:, :, k]).sum()) for p in range(len(text) + 1)) for f in model.filters for k in range(toxicity.FILTERS)]
        assert np.allclose(found, plain, atol=1e-4)


def test_long_texts_in_parts_score_as_whole(model, monkeypatch):
    texts = [word_hashes((_text(random.Random(i), i % 2) * 5).encode()) for i in range(8)] + [word_hashes(b"")]
    whole = probabilities(model, texts)
    monkeypatch.setattr(toxicity, "BLOCK", 10)
    assert np.allclose(probabilities(model, texts), whole, atol=1e-5)


def test_language_from_function_words():
    names = list(toxicity.FUNCTION_WORDS)
    for text, name in (("It is the end of the day", "en"), ("Das ist nicht der Tag", "de"), ("les amis et la mer", "fr"), ("los amigos y el mar", "es")):
        assert names[language(word_hashes(text.encode()))] == name
    assert language(word_hashes(b"xyzzy")) == language(word_hashes(b"")) == toxicity.OTHER


def test_held_out_rows_are_told_apart(spark):
    rows, labels = _rows(600, 2)
    documents = with_extras(frame(spark, rows + AWKWARD)).repartition(3)
    got = toxicity.toxicity(documents, spark.createDataFrame([*labels, (77, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows) + len(AWKWARD)
    truth = {i: t for i, _, t in labels}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.doc_id in truth and r.held_out]
    assert sum(p == t for p, t in held) >= 0.95 * len(held)
    assert all(r.predicted == 0 for r in got if r.doc_id in (3, 4, 5))


def test_clean_keeps_columns(spark):
    rows, labels = _rows(300, 3)
    df = frame(spark, rows)
    kept = toxicity.clean(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == df.columns
    toxic = {i for i, _, t in labels if t}
    left = {r.doc_id for r in kept.collect()}
    assert len(left & toxic) <= 0.05 * len(toxic)
    assert len(left - toxic) >= 0.95 * (len(rows) - len(toxic))


def test_nothing_to_learn(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity(frame(spark), labels).collect()} == {0.0}
    assert toxicity.toxicity(frame(spark, []), labels).count() == 0
    one_kind = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert not train(frame(spark), one_kind).ready


def test_all_labelled_rows_teach_in_shards(spark, monkeypatch):
    rows, labels = _rows(900, 4)
    documents = frame(spark, rows)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    taught = {i for i, *_ in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    assert {r._id for r in toxicity._labelled(documents, table, 4).collect()} == taught
    monkeypatch.setattr(toxicity, "SHARD_TEXTS", 120)
    monkeypatch.setattr(toxicity, "STEPS", 300)
    model, other = train(documents, table), train(documents.repartition(5), table.repartition(3))
    for one, two in zip([model.first, model.second, model.thresholds, model.offset, *model.dense()], [other.first, other.second, other.thresholds, other.offset, *other.dense()], strict=True):
        assert np.array_equal(one, two)
    held = [(r, t) for r, (i, _, t) in zip(rows, labels, strict=True) if i not in taught]
    hashes = [word_hashes(r[1].encode()) for r, _ in held]
    found = model.bend(probabilities(model, hashes), np.array([language(h) for h in hashes])) >= toxicity.CUT
    assert sum(int(f) == t for f, (_, t) in zip(found, held, strict=True)) >= 0.95 * len(held)
    assert not np.array_equal(model.first, toxicity.Model.new().first)


def test_changes_add_up_to_the_model_learned():
    rows, labels = _rows(60, 5)
    was = toxicity.Model.new(), toxicity.Squares.new(toxicity.Model.new())
    model, squares = toxicity.copy.deepcopy(was)
    toxicity.learn(model, squares, [word_hashes(r[1].encode()) for r in rows], np.array([x[2] for x in labels]), 1.5, 2, np.random.default_rng(1))
    table = toxicity._changes(model, squares, *was)
    step = np.column_stack([table[f"v{k}"].to_numpy() for k in range(toxicity.WIDE)]) / toxicity.EXACT
    toxicity._follow(*was, table["part"].to_numpy(), table["at"].to_numpy(), step)
    for one, two in zip([*was[0].dense(), was[0].first, was[0].second, was[0].offset, *was[1].dense, was[1].tables, was[1].offset], [*model.dense(), model.first, model.second, model.offset, *squares.dense, squares.tables, squares.offset], strict=True):
        assert np.allclose(one, two, atol=1e-5)
