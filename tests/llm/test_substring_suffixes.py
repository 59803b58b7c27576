import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, frame, with_extras

from vitrine.llm import substring_suffixes
from vitrine.llm.substring_suffixes import anchors, joined, remove_repeats, repeats
from vitrine.llm.suffix_array import common_prefixes, suffix_array


def test_suffix_array_against_sorting():
    draw = random.Random(1)
    for _ in range(1500):
        text = [draw.randrange(draw.choice([1, 2, 3, 20])) for _ in range(draw.randrange(40))]
        order = suffix_array(text)
        assert order == sorted(range(len(text)), key=lambda i: text[i:])
        for k, n in enumerate(common_prefixes(text, order)):
            if k:
                a, b = text[order[k - 1] :], text[order[k] :]
                assert a[:n] == b[:n] and a[n : n + 1] != b[n : n + 1] or a[:n] == b[:n] and n == min(len(a), len(b))


def test_each_string_has_an_anchor_that_its_bytes_alone_decide():
    draw = random.Random(2)
    for alphabet in (b"ab", b"abcdefgh", b"a"):
        text = bytes(draw.choice(alphabet) for _ in range(900))
        where, hashes = anchors(text, 200)
        known = dict(zip(where.tolist(), hashes.tolist(), strict=True))
        for start in range(len(text) - 199):
            own, own_hashes = anchors(text[start : start + 200], 200)
            assert len(own) and all(known.get(start + p) == h for p, h in zip(own.tolist(), own_hashes.tolist(), strict=True))
    assert len(anchors(b"x" * 199, 200)[0]) == 0


def _brute(texts, length):
    uses = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        spans = joined([(i, i + length) for i in range(len(t) - length + 1) if uses[t[i : i + length]] > 1])
        kept = b"".join(t[a:b] for a, b in zip([0] + [e for _, e in spans], [s for s, _ in spans] + [len(t)], strict=True))
        out.append((len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def _corpus(seed, n):
    """Texts with copies, near copies, shared passages at all offsets, and texts that repeat themselves."""
    draw = random.Random(seed)
    fresh = lambda k: "".join(draw.choice("abcdefghij klmnoé ") for _ in range(k))
    passages = [fresh(k) for k in (150, 199, 200, 201, 215, 216, 217, 260, 500, 1200)]
    texts = []
    for _ in range(n):
        kind = draw.randrange(7)
        if kind == 0 and texts:
            texts.append(draw.choice(texts))
        elif kind == 1 and texts:
            base = list(draw.choice(texts))
            for _ in range(draw.randrange(1, 4)):
                if base:
                    base[draw.randrange(len(base))] = draw.choice(["", "X", "YZ"])
            texts.append("".join(base))
        elif kind == 2:
            texts.append(fresh(draw.randrange(300)))
        elif kind == 3:
            texts.append((fresh(draw.randrange(1, 40)) * 60)[: draw.randrange(700)])
        else:
            texts.append("".join(draw.choice([fresh(draw.randrange(90)), draw.choice(passages)[draw.randrange(30) :]]) for _ in range(draw.randrange(1, 5))))
    return texts


def _result(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize(("length", "hot", "giant"), [(200, 1000, 20_000), (64, 1000, 20_000), (200, 1, 1000), (200, 2, 6), (64, 0, 0)])
def test_query_rows_against_all_strings(spark, monkeypatch, length, hot, giant):
    monkeypatch.setattr(substring_suffixes, "HOT", hot)
    monkeypatch.setattr(substring_suffixes, "GIANT", giant)
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(_corpus(length, 150))] + [*AWKWARD, (7001, "zq" * 400, "en", "s", 1), (7002, "m" * 1000, "en", "s", 1), (7003, "m" * 201, "en", "s", 1)]
    got = remove_repeats(with_extras(frame(spark, rows)).repartition(3), length=length)
    expected = _brute([(r[1] or "").encode() for r in rows], length)
    assert _result(got) == sorted((str(r[0]), *e) for r, e in zip(rows, expected, strict=True))
    assert all(len(r.kept) == r.n_bytes - r.n_removed == r.n_bytes - sum(s.end - s.start for s in r.spans) for r in got.collect())


@pytest.mark.parametrize(("hot", "giant"), [(20, 1000), (20, 30)])
def test_one_line_and_one_passage_in_every_text(spark, monkeypatch, hot, giant):
    monkeypatch.setattr(substring_suffixes, "HOT", hot)
    monkeypatch.setattr(substring_suffixes, "GIANT", giant)
    draw = random.Random(8)
    fresh = lambda k: "".join(draw.choice("abcdefghij klmnop") for _ in range(k))
    line, passage = fresh(120), fresh(330)
    texts = [fresh(300 + i % 7) + line + fresh(250) + (passage if i % 3 else passage[i % 90 :]) + fresh(i % 40) for i in range(120)]
    texts += [texts[5] + "tail", texts[6][3:], fresh(20_000) + passage[:230] + fresh(9000)]
    got = remove_repeats(frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]).repartition(3), length=200)
    assert _result(got) == sorted((str(i), *e) for i, e in enumerate(_brute([t.encode() for t in texts], 200)))


def test_runs_name_each_string_once():
    draw = np.random.default_rng(3)
    content = bytes(draw.integers(97, 123, 368, dtype=np.uint8))
    for before, cut in ((168, content), (40, content[128:]), (168, content[:300])):
        starts = [at - back for _, at, low, high, around in substring_suffixes.runs_around(cut, before, 200) for back, s in substring_suffixes.strings_around(low, high, around, 24) if len(s) == 24]
        assert sorted(starts) == list(range(-before, len(cut) - before - 200 + 1))


def test_windows_of_one_anchor():
    draw = np.random.default_rng(1)
    anchor, a, b, c = (bytes(draw.integers(97, 123, n, dtype=np.uint8)) for n in (32, 168, 168, 168))
    windows = [(a + anchor + b, 168, False), (a + anchor + c, 168, False), (c[:50] + anchor + b, 50, False)]
    assert [joined(s) for s in repeats(windows, 200)] == [[(-168, 200)], [(-168, 32)], [(0, 200)]]
    assert repeats(windows[:1], 200) == [[]]
    assert repeats([(*windows[0][:2], True)], 200) == [[(-168, 200)]]


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
