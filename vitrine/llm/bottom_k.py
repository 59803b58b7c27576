"""Fingerprints of documents: bottom-k sketches of their word shingles, made of DataFrame functions only.

A sketch is the ascending array of the k smallest distinct hashes of a text's shingles (words split at ASCII white
space, `shingle` words joined by one space; fewer words make one shingle, none make no shingle). A hash is the first
12 hex digits of MD5, so equal texts have equal sketches on any engine. The k smallest of two sketches together are the
sketch of both texts together, so sketches of parts merge into that of the whole, per row (`merged`) or per group
(`merge_groups`). Two sketches tell resemblance and containment of the shingle sets; a sketch of fewer than k hashes is
the whole set and every estimate from it is exact.

Nulls count as empty texts. Very long texts are one row and cost memory in proportion to their words. An empty table
gives an empty result. Only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 12  # hex digits of a hash
BLANKS = "[\\x20\\x09-\\x0D]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def _least(joined: Column, k: int, shingle: int, short: Column) -> Column:
    """The k smallest hashes of the shingles of words joined by blanks; all of them are one shingle where `short` holds."""
    # One pass of a possessive pattern; cutting runs out of an array of words one by one takes twice the time.
    pattern = rf"(?=([^ ]++(?: [^ ]++){{{shingle - 1}}}))[^ ]++" if shingle > 1 else r"([^ ]++)"
    shingles = F.when(short, F.array(joined)).otherwise(F.regexp_extract_all(joined, F.lit(pattern), F.lit(1)))
    hashes = F.transform(shingles, lambda s: F.substring(F.md5(s.cast("binary")), 1, DIGITS))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: str, into: str, *, k: int = 128, shingle: int = 5) -> DataFrame:
    """`df` with the sketch of column `text` (no nulls) in column `into`."""
    words, joined = f"__{into}_words", f"__{into}_joined"  # read more than once, so Catalyst leaves them columns
    cut = df.withColumn(words, _words(F.col(text))).withColumn(joined, F.array_join(words, " "))
    return cut.withColumn(into, _least(F.col(joined), k, shingle, F.size(words).between(1, shingle - 1))).drop(words, joined)


def merged(a: Column, b: Column, k: int = 128) -> Column:
    """Sketch of two texts' shingles together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(sketches: DataFrame, key: str, sketch: str, *, k: int = 128, salts: int = 64) -> DataFrame:
    """(key, sketch): one sketch for all rows of a key, such as a source. Rows without key make a group of their own.

    Hashes, not sketches, are gathered: at most k distinct ones a key and salt pass a shuffle, so a key with a third of
    all rows is `salts` bounded groups first.
    """
    hashes = sketches.select(F.col(key).alias("key"), F.explode_outer(sketch).alias("hash"))
    hashes = hashes.withColumn("salt", F.pmod(F.crc32(F.col("hash").cast("binary")), F.lit(salts))).distinct()
    per_salt = Window.partitionBy("key", "salt").orderBy("hash")
    least = hashes.withColumn("place", F.row_number().over(per_salt)).where(F.col("place") <= k)
    grouped = least.groupBy("key").agg(F.slice(F.sort_array(F.collect_list("hash")), 1, k).alias("sketch"))  # salts x k hashes at most
    return grouped.select(F.col("key").alias(key), F.col("sketch").alias(sketch))


def likeness(a: Column, b: Column, k: int = 128) -> Column:
    """Struct of estimates: resemblance (share of common shingles among all of both texts) and containment (share of the
    shingles of `a` that are also in `b`). Without any shingle in the base of a share it is 1."""
    largest = F.element_at(merged(a, b, k), -1)

    def shares(x: Column) -> Column:  # x.common: hashes of both; x.largest: end of the sketch of both together
        common = F.size(F.filter(x["common"], lambda h: h <= x["largest"])).cast("double")
        own, other = F.size(F.filter(a, lambda h: h <= x["largest"])), F.size(F.filter(b, lambda h: h <= x["largest"]))
        return F.struct((common / (own + other - common)).alias("resemblance"), F.when(own > 0, common / own).otherwise(F.lit(0.0)).alias("containment"))

    some = F.transform(F.array(F.struct(F.array_intersect(a, b).alias("common"), largest.alias("largest"))), shares)[0]
    fixed = lambda r, c: F.struct(F.lit(r).alias("resemblance"), F.lit(c).alias("containment"))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), fixed(1.0, 1.0)).when(F.size(a) == 0, fixed(0.0, 1.0)).when(F.arrays_overlap(a, b), some).otherwise(fixed(0.0, 0.0))


def distinct_shingles(sketch: Column, k: int = 128) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    largest = F.conv(F.element_at(sketch, -1), 16, 10).cast("double") / float(16**DIGITS)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / largest)


def as_text(sketch: Column) -> Column:
    """The sketch as one string: its hashes one after the other, "" for none."""
    return F.array_join(sketch, "")


def _in_ranges(documents: DataFrame, ranges: int) -> DataFrame:
    """(range, doc_id, text, guest): rows dealt out by ranges of doc_id, each range with the first row of the next one.

    Bounds are ids of the table, so the largest id of a range is a bound, and a row knows by itself that the range above
    needs it as a guest. The range of the smallest ids, which also has the rows without id, gets the first row of all.
    """
    shares = [i / ranges for i in range(1, ranges)] or [1.0]
    ids = documents.agg(F.percentile_approx("doc_id", shares, 20_000).alias("cuts"), F.max("doc_id").alias("top")).first()
    bounds = F.array(*[F.lit(c) for c in sorted(set(ids.cuts or []) - {ids.top})]).cast("array<bigint>")
    below = F.size(F.filter(bounds, lambda b: b < F.col("doc_id")))
    own = F.struct(F.coalesce(F.when(F.col("doc_id").isNotNull(), below), F.lit(0)).alias("range"), F.lit(False).alias("guest"))
    above = F.when(F.array_contains(bounds, F.col("doc_id")), F.struct((below + 1).alias("range"), F.lit(True).alias("guest")))
    around = F.when(F.col("doc_id") == F.lit(ids.top).cast("long"), F.struct(F.lit(0).alias("range"), F.lit(True).alias("guest")))
    places = documents.select("doc_id", "text", F.explode(F.array_compact(F.array(own, above, around))).alias("place"))
    return places.select("place.range", "doc_id", "text", "place.guest")


def fingerprints(documents: DataFrame, *, k: int = 128, shingle: int = 5) -> DataFrame:
    """Fingerprint of every text and of an edited text whose last third comes from the next document.

    One row per row of `documents` (doc_id, text): doc_id, n_chars (code points), edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next (estimated resemblance to the edited text and to the next document), and
    n_shingles, in_edited (estimated distinct shingles, and containment of the text in the edited one). The next
    document is the one of the next smaller doc_id, after the last one the first; rows of one doc_id are in order of
    their texts, rows without doc_id come after all others. The edited text is the text less its last floor(n_chars / 3)
    code points and then as many of the next text's first, or all it has. One document alone is next to itself.

    Texts pass one shuffle, by ranges of doc_id; four ranges to a partition keep their sizes even. The part that a text
    and its edited text share is sketched once and merged with the sketch of either rest.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _in_ranges(rows, min(4 * partitions, 4000)).repartition("range")
    # The text and its edited text share all before the cut, less the word that may go on there.
    cut = dealt.withColumn("third", F.floor(F.length("text") / 3).cast("int")).withColumn("before", F.substring("text", F.lit(1), F.length("text") - F.col("third")))
    cut = cut.withColumn("at", F.length(F.regexp_extract("before", "(?s)^.*[\\x20\\x09-\\x0D]", 0)))
    shared = cut.withColumn("words", _words(F.substring("text", F.lit(1), F.col("at")))).withColumn("n_shared", F.size("words"))
    shared = shared.withColumn("start", _least(F.array_join("words", " "), k, shingle, F.lit(False)))
    # The rest begins with the last words shared, so that every shingle is in one part or the other.
    shared = shared.withColumn("lead_in", F.slice("words", F.greatest(F.col("n_shared") - (shingle - 2), F.lit(1)), shingle - 1))

    def rest(df: DataFrame, text: Column, into: str) -> DataFrame:
        told = df.withColumn("rest", F.concat("lead_in", _words(text))).withColumn("joined", F.array_join("rest", " "))
        return told.withColumn(into, merged(F.col("start"), _least(F.col("joined"), k, shingle, (F.size("start") == 0) & F.size("rest").between(1, shingle - 1)), k)).drop("rest", "joined")

    own = rest(shared, F.expr("substring(text, at + 1)"), "sketch")
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    # Without any doc_id there is no guest; the first row of the one range is next to its last.
    following = own.select(
        "guest", "doc_id", "text", "third", "before", "at", "lead_in", "start", "sketch",
        F.coalesce(F.lead("text").over(order), F.first("text").over(order)).alias("next_text"),
        F.coalesce(F.lead("sketch").over(order), F.first("sketch").over(order)).alias("next_sketch"),
    ).where("not guest")
    edited = following.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", F.concat("before", F.substring("next_text", F.lit(1), F.col("third"))))
    both = rest(edited, F.expr("substring(edited, at + 1)"), "edited_sketch").withColumn("like", likeness(F.col("sketch"), F.col("edited_sketch"), k))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        F.col("like.resemblance").alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch"), k)["resemblance"].alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("n_shingles"),
        F.col("like.containment").alias("in_edited"),
    )
