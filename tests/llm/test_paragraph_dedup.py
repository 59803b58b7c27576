import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import AWKWARD, frame, with_extras

from vitrine.llm import paragraph_dedup
from vitrine.llm.paragraph_dedup import close_forest, paragraphs_of, remove_near, shingle_sets, tuned


def _shingles(words, size=5):
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))}


def _corpus(seed, n):
    draw = random.Random(seed)
    fresh = lambda k: " ".join("".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(k))
    shared = [fresh(k) for k in (3, 5, 6, 30, 60, 80, 120)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(draw.randrange(5)):
            line = draw.choice(shared) if draw.random() < 0.6 else fresh(draw.randrange(40))
            words = line.split()
            for _ in range(draw.choice([0, 0, 1, 2, 5])):
                if words:
                    words[draw.randrange(len(words))] = draw.choice(["zz", "yy yy", "QQ"])
            lines.append(draw.choice([" ", "  "]).join(words))
        rows.append((i, "\n".join(lines), "en", "s", 1))
    return rows


def _brute(rows, threshold=0.8, least=5):
    """(removed places, first docs) by row, from all pairs of paragraphs."""
    places = [(r[0] is None, r[0] or 0, k, i, p) for k, r in enumerate(rows) for i, p in enumerate(paragraphs_of((r[1] or "").encode())) if len(p) >= least]
    sets = [_shingles(p[4]) for p in places]
    label = list(range(len(places)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(places)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                label[find(a)] = find(b)
    clusters = defaultdict(list)
    for i in range(len(places)):
        clusters[find(i)].append(places[i])
    removed, firsts = defaultdict(list), defaultdict(set)
    for members in clusters.values():
        if len(members) > 1:
            first = min(members)
            for m in members:
                if m != first:
                    removed[m[2]].append(m[3])
                if not first[0]:
                    firsts[m[2]].add(first[1])
    return [(sorted(removed[k]), sorted(firsts[k])) for k in range(len(rows))]


def test_bands_reach_the_recall():
    for threshold, miss in ((0.8, 0.001), (0.5, 0.01), (0.9, 1e-6)):
        bands, rows = tuned(threshold, miss)
        assert (1 - threshold**rows) ** bands <= miss


def test_shingles_are_equal_where_words_are():
    paragraphs = [p for r in _corpus(1, 30) for p in paragraphs_of(r[1].encode()) if p]
    hashes, begins = shingle_sets(paragraphs, 5)
    found = [set(part.tolist()) for part in np.split(hashes, begins[1:])]
    for a in range(len(paragraphs)):
        for b in range(a + 1):
            assert len(found[a] & found[b]) == len(_shingles(paragraphs[a]) & _shingles(paragraphs[b]))


def test_forest_is_exact():
    draw = random.Random(4)
    for _ in range(60):
        base = [draw.randrange(10**9) for _ in range(12)]
        sets = [np.array(sorted({x if draw.random() < 0.93 else draw.randrange(10**9) for x in base}), np.uint64) if draw.random() < 0.7 else np.array(sorted({draw.randrange(50) for _ in range(6)}), np.uint64) for _ in range(draw.randrange(1, 15))]
        label = list(range(len(sets)))
        for a in range(len(sets)):
            for b in range(a):
                if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b])):
                    old, new = max(label[a], label[b]), min(label[a], label[b])
                    label = [new if x == old else x for x in label]
        assert close_forest(sets, 0.8).tolist() == label


@pytest.mark.parametrize("tile_rows", [5000, 4])
def test_query_rows_against_all_pairs(spark, tile_rows):
    rows = [*_corpus(3, 70), *[(1000 + i, t, *rest) for i, (_, t, *rest) in enumerate(r for r in AWKWARD if r[0] is not None)]]
    got = {r.doc_id: r for r in remove_near(with_extras(frame(spark, rows)).repartition(3), miss=1e-7, tile_rows=tile_rows, with_text=True).collect()}
    assert len(got) == len(rows)
    for row, (removed, firsts) in zip(rows, _brute(rows), strict=True):
        r = got[row[0]]
        lines = (row[1] or "").split("\n")
        assert (r.n_paragraphs, r.n_removed, r.removed, r.first_docs) == (len(lines), len(removed), removed, firsts)
        assert r.kept == "\n".join(x for i, x in enumerate(lines) if i not in removed)


def test_rows_that_repeat_or_have_no_id(spark):
    got = remove_near(frame(spark).repartition(3)).collect()
    assert len(got) == len(AWKWARD)
    # Four rows hold the same line, up to case: all but one of the smallest id lose it.
    cats = [r for r in got if r.first_docs == [1]]
    assert sorted((str(r.doc_id), r.n_removed) for r in cats) == [("1", 0), ("2", 1), ("2", 1), ("None", 1)]


def test_empty_table(spark):
    assert remove_near(frame(spark, [])).count() == 0
    assert paragraph_dedup.remove_near(frame(spark, [(1, "no other line is like this one", "en", "s", 1)])).first().n_removed == 0


def test_pieces_do_not_depend_on_what_is_around():
    draw = random.Random(9)
    fresh = lambda k: [b"w%d" % draw.randrange(10**6) for _ in range(k)]
    for _ in range(40):
        passage, before, after = fresh(60), fresh(draw.randrange(40)), fresh(draw.randrange(40))
        alone = {(a, b) for a, b in paragraph_dedup.pieces(passage, 6) if a > 7 and b < 53}
        inside = {(a - len(before), b - len(before)) for a, b in paragraph_dedup.pieces(before + passage + after, 6)}
        assert alone <= inside
        ranges = paragraph_dedup.pieces(before + passage, 6)
        assert [x for r in ranges for x in range(*r)] == list(range(len(before) + 60))
    assert paragraph_dedup.pieces([], 6) == []
    assert paragraph_dedup.pieces([b"ha"] * 120, 6)[-2:] == [(51, 101), (101, 120)]  # the first word has none before it


def test_passages_inside_other_lines(spark):
    """Repeated passages within longer lines, over line ends and in texts that repeat themselves, against all pieces."""
    draw = random.Random(8)
    fresh = lambda k: [f"w{draw.randrange(10**6)}" for _ in range(k)]
    shared = [fresh(k) for k in (57, 64, 90, 200)]
    whole = " ".join(fresh(9))
    rows, planted = [], []
    for i in range(60):
        words, at = fresh(draw.randrange(60, 90)), []
        for _ in range(draw.randrange(3)):
            k = draw.randrange(len(shared))
            at.append((k, len(words), len(words) + len(shared[k])))
            words += [w.upper() if draw.random() < 0.1 else w for w in shared[k]] + fresh(draw.randrange(60, 90))
        text = "".join(w + draw.choice([" "] * 60 + ["  ", "\n", "\n\n"]) for w in words)
        planted.append(at)
        rows.append((i, text.replace("\n\n", f"\n{whole}\n") if i % 4 == 0 else text, "en", "s", 1))
    rows.append((60, "ha " * 200, "en", "s", 1))
    reach = 6
    got = {r.doc_id: r for r in remove_near(frame(spark, rows).repartition(3), miss=1e-7, passage_miss=1e-7, passage_reach=reach, with_text=True).collect()}
    lines = {r.doc_id: r for r in remove_near(frame(spark, rows).repartition(3), miss=1e-7).collect()}
    assert all((got[i].removed, got[i].first_docs) == (lines[i].removed, lines[i].first_docs) for i in lines)
    units, cut = [], {}
    for i, text, *_ in rows:
        words, _, ranges = cut[i] = paragraph_dedup.pieces_left(text.encode(), got[i].removed, reach)
        units += [(i, a, b, _shingles(words[a:b])) for a, b in ranges if b - a > reach]
    label = list(range(len(units)))
    for x in range(len(units)):
        for y in range(x):
            if len(units[x][3] & units[y][3]) >= 0.8 * len(units[x][3] | units[y][3]) and label[x] != label[y]:
                old, new = max(label[x], label[y]), min(label[x], label[y])
                label = [new if k == old else k for k in label]
    caught, later, before = 0, 0, set()
    for i, text, *_ in rows:
        words = cut[i][0]
        gone = {k for n, (j, a, b, _) in enumerate(units) if j == i and label[n] != n for k in range(a, b)}
        kept_lines = [m for m in paragraph_dedup.WORD.finditer(text.encode()) if text.encode()[: m.start()].count(b"\n") not in got[i].removed]
        assert {k for k, m in enumerate(kept_lines) if any(s.start <= m.start() < s.end for s in got[i].spans)} == gone
        assert got[i].kept.lower().split() == [w.decode() for k, w in enumerate(words) if k not in gone]
        for k, *_ in planted[i] if i < 60 and i % 4 else []:
            later += k in before
            caught += k in before and bool(gone)
        before.update(k for k, *_ in (planted[i] if i < 60 else []))
    assert later > 20
    assert caught >= 0.95 * later


def test_one_line_and_one_passage_in_every_text(spark):
    draw = random.Random(10)
    fresh = lambda k: " ".join(f"w{draw.randrange(10**6)}" for _ in range(k))
    line, passage = fresh(12), fresh(70)
    rows = [(i, f"{fresh(25)}\n{line}\n{fresh(20)} {passage} {fresh(15)}", "en", "s", 1) for i in range(150)]
    got = {r.doc_id: r for r in remove_near(frame(spark, rows).repartition(3), passage_reach=6, tile_rows=40).collect()}
    assert [got[i].removed for i in range(150)] == [[]] + [[1]] * 149
    assert [bool(got[i].spans) for i in range(150)] == [False] + [True] * 149


def test_passages_of_texts_that_are_empty_or_lose_all(spark):
    line = "one two three four five six seven eight nine"
    rows = [(1, line, "en", "s", 1), (2, line, "en", "s", 1), (3, "", "en", "s", 1), (4, None, "en", "s", 1), (5, " \n ", "en", "s", 1)]
    got = {r.doc_id: r for r in remove_near(frame(spark, rows).repartition(2), passage_reach=6, with_text=True).collect()}
    assert {i: (r.n_paragraphs, r.removed, r.spans, r.kept) for i, r in got.items()} == {
        1: (1, [], [], line), 2: (1, [0], [], ""), 3: (1, [], [], ""), 4: (1, [], [], ""), 5: (2, [], [], " \n ")
    }
