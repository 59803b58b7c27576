import hashlib
import random
import re

from helpers import AWKWARD, DOCS, frame, with_extras
from pyspark.sql import functions as F

from vitrine.llm import bottom_k


def _shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {" ".join(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def _sketch(text, k):
    return sorted({hashlib.md5(s.encode()).hexdigest()[:12] for s in _shingles(text)})[:k]


def _near(a, b, k):
    union = sorted({*a, *b})[:k]
    return len({*union} & {*a} & {*b}) / len(union) if union else 1.0


def _expected(rows, k):
    rows = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        a, b, c = (_sketch(t, k) for t in (text, edited, following))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), round(_near(a, b, k), 12), round(_near(a, c, k), 12)))
    return sorted(out, key=str)


def _found(df):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted(((*r[:5], round(r[5], 12), round(r[6], 12)) for r in df.select(names).collect()), key=str)


def test_awkward_rows_by_hand_over_several_ranges(spark):
    docs = with_extras(frame(spark)).withColumn("range", F.lit("x")).withColumn("guest", F.lit("x")).withColumn("sketch", F.lit("x"))
    for k in (4, 128):
        assert _found(bottom_k.fingerprints(docs, k=k)) == _expected(AWKWARD, k)


def test_one_row_no_ids_and_no_rows(spark):
    for rows in ([(5, "a b c d e f g", None, None, None)], [(None, t, None, None, None) for t in ("b c", None, "a b c d e f")], []):
        assert _found(bottom_k.fingerprints(frame(spark, rows, DOCS))) == _expected(rows, 128)


def test_long_texts_and_equal_texts(spark):
    draw = random.Random(3)
    long = " ".join(f"w{draw.randrange(9000)}" for _ in range(40_000))
    rows = [(i, t, None, None, None) for i, t in enumerate([long, long + " tail", "short text", long, "x" * 300_000, "one " + "y" * 200_000, "    é😀" * 20])]
    assert _found(bottom_k.fingerprints(frame(spark, rows, DOCS))) == _expected(rows, 128)


def test_sketches_of_parts_merge_and_estimate(spark):
    draw = random.Random(4)
    words = [f"w{draw.randrange(10**6)}" for _ in range(6000)]
    texts = [" ".join(words[a:b]) for a, b in ((0, 3000), (2996, 6000), (0, 6000), (1500, 4500))]
    df = frame(spark, [(i, t, None, "hot" if i < 2 else None, None) for i, t in enumerate(texts)], DOCS)
    own = bottom_k.with_sketch(df, "text", "sketch", k=256)
    groups = {r.source: r.sketch for r in bottom_k.merge_groups(own, "source", "sketch", k=256).collect()}
    assert groups["hot"] == _sketch(texts[2], 256) == groups[None]
    pair = own.alias("a").join(own.alias("b"), F.col("a.doc_id") < F.col("b.doc_id"))
    a, b = F.col("a.sketch"), F.col("b.sketch")
    for r in pair.select(F.col("a.doc_id").alias("i"), F.col("b.doc_id").alias("j"), bottom_k.likeness(a, b, 256)["resemblance"].alias("near"), bottom_k.likeness(a, b, 256)["containment"].alias("part"), bottom_k.distinct_shingles(bottom_k.merged(a, b, 256), 256).alias("n")).collect():
        x, y = _shingles(texts[r.i]), _shingles(texts[r.j])
        assert abs(r.near - len(x & y) / len(x | y)) < 0.12
        assert abs(r.part - len(x & y) / len(x)) < 0.17
        assert abs(r.n / len(x | y) - 1) < 0.25
