import random
import re

from helpers import AWKWARD, frame, with_extras
from pyspark.sql import functions as F

from vitrine.llm.decontamination import clean, compile_items, contamination, hits, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def _brute(text, items, window):
    words = WORD.findall(_lower(text))
    hit, found = set(), set()
    for item, other in items:
        theirs = WORD.findall(_lower(other))
        size = min(window, len(theirs))
        for s in range(len(theirs) - size + 1) if size else ():
            for p in range(len(words) - size + 1):
                if words[p : p + size] == theirs[s : s + size]:
                    hit |= set(range(p, p + size))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def _items(draw, n):
    return [(i, " ".join(draw.choice("abcd") for _ in range(draw.choice([0, 1, 2, 3, 9, 10, 11, 14])))) for i in range(n)]


def test_search_against_all_positions():
    draw = random.Random(8)
    for window in (1, 2, 4, 10):
        items = [(i, t) for i, t in _items(draw, 12)]
        lengths = compile_items([(str(i), t.encode()) for i, t in items], window)
        for _ in range(60):
            text = " ".join(draw.choice("abcde") for _ in range(draw.randrange(40))) + " " + draw.choice(items)[1]
            spans, found = hits(words_of(text.encode()), lengths)
            n, hit, names = _brute(text, items, window)
            assert (len(words_of(text.encode())), sum(b - a for a, b in spans), sorted(found)) == (n, hit, names)


def test_query_rows_in_one_round_and_in_several(spark):
    draw = random.Random(3)
    rows = [*AWKWARD, *[(100 + i, " ".join(draw.choice("abcdE") for _ in range(draw.randrange(60))) + "; Ünï-cödé 10 x", "en", "s", 1) for i in range(40)]]
    items = [*_items(draw, 25), (99, "Ünï cödé 10"), (98, None), (97, ""), (97, "SAT on the mat"), (96, "漢字かな")]
    bench = spark.createDataFrame([*items, (None, "the moon")], "item_id long, text string")
    expected = sorted((str(i), *_brute(t, items, 10)[:2], _brute(t, items, 10)[2]) for i, t, *_ in rows)
    for portion in (1 << 20, 60):
        got = contamination(with_extras(frame(spark, rows)).repartition(3), bench.withColumn("_items", F.lit("x")).withColumn("text_", F.lit(1)), portion=portion)
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.item_ids) for r in got.collect()) == expected
        assert all(r.n_items == len(r.item_ids) and r.contaminated == (r.n_hit > 0) == bool(r.spans) for r in got.collect())
    kept = clean(frame(spark, rows), bench)
    assert kept.columns == frame(spark).columns
    assert kept.count() == sum(1 for x in expected if x[2] == 0)


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination(frame(spark, []), bench).count() == 0
    assert contamination(frame(spark), bench.limit(0)).where("contaminated").count() == 0
