"""Small tables with awkward rows, and brute-force pieces that several tests use."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

AWKWARD = [
    (1, "The cat sat on the mat and looked at the moon.", "en", "a", 1),
    (2, "the CAT sat on the mat and looked at the moon.", "en", "a", 1),
    (2, "the CAT sat on the mat and looked at the moon.", "en", "a", 1),  # a repeated row
    (3, "", "en", None, 0),
    (4, None, None, "b", None),
    (5, " \t\n ", "xx", "b", 3),
    (6, "word", "de", "b", 4),
    (None, "the cat sat on the mat and looked at the moon.", "en", "a", 1),
    (None, "nobody knows my number", "en", "c", 1),
    (7, "Ünïcödé — ß İ ŋ ▁ \x00 \x1c 漢字かな 😀 é" * 3, "zz", "c", 9),
    (8, "a " * 6000 + "end", "en", "c", 12003),
    (9, "one two", "en", "c", 7),
    (-3, "one two", "en", "c", 7),
]


def frame(spark, rows=AWKWARD, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def with_extras(df):
    """The same rows with columns named like those of results and of inner steps."""
    from pyspark.sql import functions as F

    for name in ("component_id", "fingerprint", "bits", "owner", "key", "part", "class", "hash", "length", "rows", "score", "node", "item_id", "word", "n_tokens", "kept", "keep_id"):
        df = df.withColumn(name, F.lit("x"))
    return df
