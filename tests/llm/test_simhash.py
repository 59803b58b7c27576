import random

import numpy as np
import xxhash
from helpers import AWKWARD, frame, with_extras

from vitrine.llm import simhash
from vitrine.llm.components import components


def _fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _classes(n, pairs):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    return [find(x) for x in range(n)]


def test_fingerprints_bit_by_bit(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 50)
    texts = [r[1] for r in AWKWARD]
    assert simhash.fingerprints([(t or "").encode() for t in texts], 3).tolist() == [_fingerprint(t) for t in texts]


def test_close_pairs_against_all_pairs(monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    draw = random.Random(1)
    base = [draw.getrandbits(64) for _ in range(40)]
    values = {v ^ sum(1 << draw.randrange(64) for _ in range(draw.randrange(4))) & (2**64 - 1) for v in base for _ in range(5)}
    bits = np.array(sorted(values, key=lambda v: v.bit_count()), np.uint64)
    found = {(int(i), int(j)) for a, b in simhash.close_pairs(bits, 2) for i, j in zip(a, b, strict=True)}
    assert found == {(i, j) for i in range(len(bits)) for j in range(i + 1, len(bits)) if (int(bits[i]) ^ int(bits[j])).bit_count() <= 2}


def test_links_join_what_all_pairs_join_also_in_hot_blocks(spark):
    draw = random.Random(2)
    base = [draw.getrandbits(64) for _ in range(60)]
    shared = [(draw.getrandbits(43) << 21) | 5 for _ in range(300)]  # one block value holds most rows
    values = sorted({v ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(4))) for v in base + shared for _ in range(4)})
    prints = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(values)], "bits long, owner long")
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2]
    for tile_rows in (20_000, 40):
        rows = [tuple(r) for r in simhash.links(prints, tile_rows=tile_rows).collect()]
        assert all((values[a] ^ values[b]).bit_count() <= 64 for a, b in rows)
        assert _classes(len(values), rows) == _classes(len(values), pairs)


def test_groups_with_awkward_rows(spark):
    near = "the quick brown fox jumps over the lazy dog and runs away from all the others in the field near home " * 4
    rows = [*AWKWARD, (20, near, "en", "s", 1), (21, near.upper(), "en", "s", 1), (22, near + "x", "en", "s", 1)]
    got = simhash.near_groups(with_extras(frame(spark, rows)).repartition(3)).collect()
    assert len(got) == len(rows)
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got if r.doc_id is not None}
    assert prints == {r[0]: _fingerprint(r[1]) for r in rows if r[0] is not None}
    ids = sorted(prints)
    classes = _classes(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if (prints[ids[i]] ^ prints[ids[j]]).bit_count() <= 2])
    expected = {x: ids[c] for x, c in zip(ids, classes, strict=True)}
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == expected
    left = [r.doc_id for r in simhash.thin(frame(spark, rows)).collect()]
    assert sorted(x for x in left if x is not None) == sorted(r[0] for r in rows if r[0] is not None and expected[r[0]] == r[0])
    assert left.count(None) == 2


def test_empty_table(spark):
    assert simhash.near_groups(frame(spark, [])).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    draw = random.Random(3)
    nodes = list(range(400))
    draw.shuffle(nodes)
    pairs = [(nodes[i], nodes[i + 1]) for i in range(150)] + [(nodes[200], nodes[i]) for i in range(201, 260)] + [(5, 5)]
    pairs += [(nodes[300 + i], nodes[300 + (i + 1) % 50]) for i in range(50)] + [(b, a) for a, b in pairs[:20]]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    classes = _classes(400, pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: classes[x] for x in linked}
