import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import gnat
from vitrine.llm.hard_negatives import Index, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def _expected(rows, every, positives=5, negatives=3, low=50, high=95, scale=256):
    fine = {(i, lab, tuple(math.floor(scale * float(np.float32(x))) for x in v)) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, lab, v in sorted(fine):
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, other) for i, other, w in fine if i != a)
        for s, p, _ in [r for r in scored if r[2] == lab][:positives]:
            found = [r for r in scored if r[2] != lab and low * -s <= 100 * -r[0] <= high * -s][:negatives]
            out += [(a, p, n + 1, r[1], -s, -r[0]) for n, r in enumerate(found)]
    return sorted(out)


def _rows(draw, n, width, labels=4):
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    return [(i, [x + draw.gauss(0, 0.3) for x in draw.choice(centres)], draw.randrange(labels)) for i in range(n)]


def test_tree_reaches_every_leaf_that_a_window_needs_and_skips_others():
    draw = np.random.default_rng(2)
    centres = draw.integers(-300, 300, (12, 8))
    x = np.concatenate([c + draw.integers(-25, 25, (40, 8)) for c in centres]).astype(float)
    tree = gnat.Tree(int((x * x).sum(axis=1).max()))
    tree.grow(x[::5], 4, 3)
    leaf, ranges = tree.assign(x)
    for node, (low, high) in ranges.items():
        tree.nodes[node].low, tree.nodes[node].high = low, high
    scores = (x @ x.T).astype(np.int64)
    visited = 0
    for q in range(0, len(x), 7):
        top = int(np.sort(scores[q])[-6])
        for least, most in ((top, -gnat.NONE), (top // 2, top * 95 // 100), (gnat.NONE, -gnat.NONE), (5, 4), (int(scores[q].max()) + 10**9, -gnat.NONE)):
            _, reached = tree.reach(x[q : q + 1], np.zeros(1, int), np.array([least]), np.array([most]))
            wanted = np.unique(leaf[(scores[q] >= least) & (scores[q] <= most)])
            assert set(wanted) <= set(reached)
            assert len(set(reached)) == len(reached)
            visited += len(reached) * (least == top)
    assert visited < 0.6 * tree.leaves * len(range(0, len(x), 7))


def test_best_rows_of_windows_with_ties():
    x, ids, labels = np.array([[1.0], [2.0], [2.0], [3.0]]), np.array([4, 5, 6, 9]), np.array([0, 0, 1, 1])
    one = lambda k, least, most, same: [a.tolist() for a in gnat.best(x, ids, labels, np.array([[1.0]]), np.array([0]), np.array([0]), np.array([least]), np.array([most]), k, same=same)[1:]]
    assert one(1, gnat.NONE, -gnat.NONE, True) == [[1], [2]]
    assert one(5, 3, 9, False) == [[3], [3]]
    assert gnat.best(x, ids, labels, np.array([[1.0]]), np.array([0]), np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), 2, same=True)[0].tolist() == []


@pytest.mark.parametrize(("leaf_rows", "block"), [(20, 7), (2048, 20_000)])
def test_against_all_pairs_with_awkward_rows(spark, monkeypatch, leaf_rows, block):
    from vitrine.llm import hard_negatives as module

    monkeypatch.setattr(module, "PART", 40)
    draw = random.Random(6)
    rows = _rows(draw, 260, 5)
    rows += [(400 + i, rows[3][1], 1 + i % 2) for i in range(130)]  # one vector, two labels: a third of all
    rows += [(20, rows[20][1], rows[20][2]), (40, rows[41][1], 0), (None, rows[1][1], 0), (900, None, 0), (901, rows[2][1], None), (902, [None, 1.0], 0), (903, [float("nan")] * 5, 0), (904, [float("inf")] * 5, 0), (905, [], 1), (910, [0.5], 1), (911, [0.0] * 5, 2), (-20, rows[5][1], 3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("query", F.lit("x")).withColumn("leaf", F.lit("x")).withColumn("score", F.lit("x"))
    got = sorted(tuple(r) for r in hard_negatives(df, every=10, leaf_rows=leaf_rows, fanout=3, sample=90, block=block).collect())
    assert got == _expected(rows, 10)
    assert len(got) > 100


def test_few_rows_none_and_too_long(spark):
    some = [(0, [1.0, 0.0], 1), (50, [1.0, 0.0], 1), (1, [0.9, 0.1], 2), (2, [1.0, 0.2], 1)]
    for rows in (some, some[:1], some[2:], []):
        got = sorted(tuple(r) for r in hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())
        assert got == _expected(rows, 50)
    with pytest.raises(Exception, match="too long"):
        hard_negatives(spark.createDataFrame([(0, [1e9, 0.0], 1)], SCHEMA)).collect()


def test_every_row_is_indexed(spark):
    rows = [(i, [int(x * 100) for x in v], lab) for i, v, lab in _rows(random.Random(7), 300, 4)]
    df = spark.createDataFrame(rows, "vec_id long, whole array<int>, label long")
    index = Index(df, fanout=3, leaf_rows=15, sample=60)
    assert index.tree.leaves > 5
    assert sorted(r.vec_id for r in index.leaves.collect()) == list(range(300))
