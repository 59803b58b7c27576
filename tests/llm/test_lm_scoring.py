import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import AWKWARD, frame, with_extras

from vitrine.llm import lm_scoring
from vitrine.llm.lm_scoring import END, ORDER, START, Trie, context_strings, scores


def _train(texts):
    """Followers of every context of up to ORDER symbols."""
    after = defaultdict(Counter)
    for text in texts:
        symbols = [START] * ORDER + list(text) + [END]
        for i in range(ORDER, len(symbols)):
            for k in range(ORDER + 1):
                after[tuple(symbols[i - k : i])][symbols[i]] += 1
    return after


def _probability(after, context, symbol):
    p, gone = 1.0, set()
    for k in range(ORDER, -1, -1):
        seen = after.get(tuple(context[len(context) - k :]))
        if not seen:
            continue
        left = {s: n for s, n in seen.items() if s not in gone}
        total = sum(left.values())
        if symbol in left:
            return p * left[symbol] / (total + len(left))
        if left:
            p *= len(left) / (total + len(left))
        gone |= set(seen)
    return p / (256 - len(after.get((), ())))


def _log10(after, text):
    symbols = [START] * ORDER + list(text) + [END]
    return sum(math.log10(_probability(after, symbols[i - ORDER : i], symbols[i])) for i in range(ORDER, len(symbols)))


def _held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def _expected(rows):
    train = [(t or "").encode().lower() for i, t, *_ in rows if not _held(i)]
    after, c = _train(train), Counter()
    for t in train:
        c.update([*t.split(), None])
    total, kinds = sum(c.values()), len(c)
    out = []
    for i, t, *_ in rows:
        text = (t or "").encode().lower()
        tokens = [*text.split(), None]
        base = sum(math.log10((c[w] + 1) / (total + kinds + 1)) for w in tokens)
        out.append((str(i), _held(i), len(tokens), sum(w in c for w in tokens), total, base, _log10(after, text)))
    return sorted(out)


def _rows(draw):
    words = ["the", "of", "Then", "and", "öl", "zebra", "ran", "x"]
    return [*AWKWARD, *[(100 + i, " ".join(draw.choice(words) + draw.choice(["", "", "s", "q" * draw.randrange(3)]) for _ in range(draw.randrange(50))), "en", "s", 1) for i in range(60)]]


def _trie(texts):
    strings, _ = context_strings(texts)
    keys, counts = np.unique(strings, return_counts=True)
    return Trie(keys, counts, lm_scoring._sums(keys & np.uint64(0xFFFF), counts))


def test_probabilities_after_any_context_add_up_to_one():
    trie = _trie([b"abracadabra", b"abra", b"cad", b"", b"zz top"])
    for context in (b"\xfe\xfe\xfe\xfe\xfe", b"cadab", b"xxxab", b"qqqqq", b"\xfe\xfe\xfeab"):
        strings = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert np.isclose((10 ** trie.log10(strings)).sum(), 1.0, atol=1e-5)


def test_trie_against_counting_by_hand():
    draw = random.Random(2)
    texts = [bytes(draw.choice(b"abc ") for _ in range(draw.randrange(80))) for _ in range(60)]
    trie, after = _trie(texts), _train(texts)
    for text in [*texts[:10], b"", b"hello abc", "ünï".encode(), b"ccccccccc"]:
        strings, _ = context_strings([text])
        assert math.isclose(trie.log10(strings).sum(), _log10(after, text), rel_tol=1e-5, abs_tol=1e-6)
        assert math.isclose(trie.escape(strings).sum(), _log10(after, text), rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize(("portion", "head", "chunk"), [(4_000_000, 200_000, 1 << 19), (150, 5, 64)])
def test_query_rows(spark, monkeypatch, portion, head, chunk):
    monkeypatch.setattr(lm_scoring, "CHUNK", chunk)
    rows = _rows(random.Random(7))
    got = scores(with_extras(frame(spark, rows)).repartition(3), portion=portion, head=head).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    expected = _expected(rows)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(sorted(got, key=lambda r: (r[0], r[5])), sorted(expected, key=lambda r: (r[0], r[5])), strict=True):
        assert math.isclose(g[5], e[5], rel_tol=1e-9)
        assert math.isclose(g[6], e[6], rel_tol=1e-5)


def test_pieces_cut_texts_without_changing_strings(monkeypatch):
    draw = random.Random(1)
    texts = [bytes(draw.choice(b"ab ") for _ in range(n)) for n in (0, 5, 64, 65, 200, 0, 63, 127, 128, 3, 3)]
    whole = [sorted(context_strings([t])[0].tolist()) for t in texts]
    monkeypatch.setattr(lm_scoring, "CHUNK", 64)
    found = [[] for _ in texts]
    for first, strings, starts in lm_scoring.pieces(texts):
        for i, part in enumerate(np.split(strings, starts[1:])):
            found[first + i] += part.tolist()
    assert [sorted(f) for f in found] == whole


def test_nothing_to_learn_from_and_nothing_to_score(spark):
    held = [i for i in range(100) if _held(i)][:2]
    rows = [(i, "ab", "en", "s", 1) for i in held]
    got = scores(frame(spark, rows)).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(True, 2, 0, 0, 0.0)] * 2
    assert all(math.isclose(r.score, -3 * math.log10(256)) for r in got)
    assert scores(frame(spark, [])).count() == 0


def test_a_trie_holds_its_deepest_strings_once():
    grams, _ = lm_scoring.context_strings([b"a man a plan a canal", b"panama"])
    keys, counts = np.unique(grams, return_counts=True)
    shallow = np.unique(grams & np.uint64(0xFFFF), return_counts=True)
    trie = lm_scoring.Trie(keys, counts, shallow)
    assert np.shares_memory(trie.levels[-1].keys, keys)
    assert all(level.counts.itemsize == level.total.itemsize == level.excluded.itemsize == 4 for level in trie.levels[1:])
    for level in trie.levels:
        assert int(level.counts.sum()) == int(level.total.sum()) == len(grams)
