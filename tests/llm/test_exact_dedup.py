import hashlib
import random
from collections import defaultdict

from helpers import DOCS, frame, with_extras

from vitrine.llm.exact_dedup import Owners, Trie, dedup, exact_groups


def _groups(rows, choose):
    found = defaultdict(list)
    for doc_id, text, *_ in rows:
        found[(text or "").encode().lower()].append(doc_id)
    out = []
    for key, ids in found.items():
        known = [x for x in ids if x is not None]
        best = choose(known) if known else None
        out += [(x, best, len(ids), x == best, hashlib.sha256(key).hexdigest()) for x in ids]
    return sorted(out, key=str)


def _result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_groups_with_awkward_rows(spark):
    from helpers import AWKWARD

    for keep, choose in (("min", min), ("max", max)):
        assert _result(exact_groups(with_extras(frame(spark)).repartition(3), keep=keep)) == _groups(AWKWARD, choose)


def test_small_tries_meet_again(spark):
    rows = [(i, f"text {i % 37} " * (i % 37), "en", "s", 1) for i in range(600)]
    assert _result(exact_groups(frame(spark, rows).repartition(4), keep="max", memory=3000)) == _groups(rows, max)


def test_empty_table(spark):
    assert exact_groups(frame(spark, [])).count() == 0
    assert dedup(frame(spark, [])).count() == 0


def test_dedup_leaves_one_row_per_text_with_all_columns(spark):
    left = dedup(frame(spark).repartition(3), keep="max")
    assert left.columns == [field.split()[0] for field in DOCS.split(", ")]
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect())
    assert ids == [(False, x) for x in (2, 4, 5, 6, 7, 8, 9)] + [(True, 0)]


def test_trie_against_a_dictionary():
    draw = random.Random(5)
    words = [bytes(draw.choice(b"ab") for _ in range(draw.randrange(12))) for _ in range(3000)]
    trie, truth = Trie(), defaultdict(int)
    for w in words:
        node = trie.place(w)
        node.value = (node.value or 0) + 1
        truth[w] += 1
    assert dict(trie.items()) == truth


def test_owners_spill_by_subtree():
    draw = random.Random(6)
    words = [bytes(draw.choice(b"abcd") for _ in range(draw.randrange(40))) for _ in range(2000)]
    words += words[::2]
    truth = defaultdict(int)
    owners = Owners(lambda a, b: (a[0] + b[0],), memory=20_000)
    for w in words:
        owners.add(w, (1,))
        truth[w] += 1
    assert owners.spilled
    assert sorted((k, v[0]) for k, v in owners) == sorted(truth.items())
