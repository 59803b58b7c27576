"""Registered queries of the corpus operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import bottom_k, decontamination, exact_dedup, hard_negatives, html_text, lm_scoring, paragraph_dedup, ptolemaic_clusters, sentence_pieces, simhash, substring_suffixes, token_counts, toxicity


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(_table(spark, folder, "documents"), shingle=3, radius=2)


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.token_counts(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", counts.n_tokens > 2048)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"), modulus=4)


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(_table(spark, folder, "pages"))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, folder, "documents"), keep="max", fold_case=True)


def op6_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraph_dedup.remove_near(_table(spark, folder, "documents"), shingle=5, threshold=0.8, passage_reach=6)


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_suffixes.remove_repeats(_table(spark, folder, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_pieces.encode(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", decontamination.items_digest("item_ids").alias("items_sha256"), "contaminated")


def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.scores(_table(spark, folder, "documents"), modulus=7)


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.col("label").cast("long")
    vectors = _table(spark, folder, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.hard_negatives(vectors, every=50, positives=5, negatives=3, low=50, high=95, scale=256)


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return ptolemaic_clusters.clusters(_table(spark, folder, "embeddings"), count=8, rounds=10, scale=1024, width=64, seed="3")


def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return bottom_k.fingerprints(_table(spark, folder, "documents"), k=128, shingle=5)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_token_counts, op3_toxicity, op4_html_text, op5_exact_dedup, op6_paragraph_dedup, op7_suffix_dedup, op8_sentence_pieces, op9_decontamination, op10_lm_scoring, op11_hard_negatives, op12_centroids, op13_fingerprints)}


FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sketch(text: str) -> str:
    words = rf"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    starts = "CASE WHEN len(w) = 0 THEN [] ELSE range(1, greatest(len(w) - 4, 1) + 1) END"
    hashes = f"list_distinct(list_transform({starts}, lambda i: substr(md5(array_to_string(w[i:i + 4], ' ')), 1, 12)))"
    return f"(SELECT list_sort({hashes})[1:128] FROM (SELECT {words} AS w))"


def _near(a: str, b: str, of: str) -> str:
    common = f"len(list_intersect(u, list_intersect({a}, {b})))"
    if of == "resemblance":
        return f"(SELECT CASE WHEN len(u) = 0 THEN 1.0::DOUBLE ELSE {common}::DOUBLE / len(u) END FROM (SELECT list_sort(list_distinct(list_concat({a}, {b})))[1:128] AS u))"
    own = f"len(list_intersect(u, {a}))"
    return f"(SELECT CASE WHEN len({a}) = 0 THEN 1.0::DOUBLE WHEN {own} = 0 THEN 0.0::DOUBLE ELSE {common}::DOUBLE / {own} END FROM (SELECT list_sort(list_distinct(list_concat({a}, {b})))[1:128] AS u))"


def _clusters() -> str:
    parts = [
        """v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
             WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "x AS MATERIALIZED (SELECT r, unnest(range(64)) AS pos, unnest(w) AS x FROM v)",
        "c0 AS MATERIALIZED (SELECT c, unnest(range(64)) AS pos, unnest(w) AS y FROM (SELECT w, row_number() OVER (ORDER BY sha256('3:' || vec_id), w) - 1 AS c FROM v WHERE vec_id IS NOT NULL QUALIFY c < 8))",
    ]
    for i in range(11):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM
            (SELECT r, c, sum((x - y) * (x - y))::BIGINT AS d FROM x JOIN c{i} USING (pos) GROUP BY r, c) GROUP BY r)""")
        if i < 10:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, pos, CASE WHEN n IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END::BIGINT AS y FROM c{i}
                LEFT JOIN (SELECT c, pos, sum(x)::BIGINT AS s, count(*) AS n FROM x JOIN a{i} USING (r) GROUP BY c, pos) USING (c, pos))""")
    return "WITH " + ", ".join(parts) + """
        SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM v JOIN a10 USING (r) JOIN (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY pos)) AS centroid_sha256 FROM c10 GROUP BY c) USING (c)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_exact_dedup": f"""
            SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
                   doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
            FROM (SELECT doc_id, {FOLD} AS t FROM documents)""",
        "op9_decontamination": r"""
            WITH d AS (SELECT doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS w FROM documents),
            doc AS (SELECT doc_id, list_filter(w, lambda x: x <> '') AS w FROM d),
            b AS (SELECT item_id, string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS w FROM benchmark),
            item AS (SELECT item_id, w, least(len(w), 10) AS size FROM (SELECT item_id, list_filter(w, lambda x: x <> '') AS w FROM b) WHERE len(w) > 0),
            test AS (SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS t FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM item)),
            sizes AS (SELECT DISTINCT size FROM test),
            place AS (SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS t FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM doc CROSS JOIN sizes)),
            hit AS (SELECT doc_id, p, place.size, item_id FROM place JOIN test ON place.size = test.size AND place.t = test.t),
            words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY doc_id),
            items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
            SELECT doc.doc_id, len(doc.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
            FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
        "op11_hard_negatives": """
            WITH v AS MATERIALIZED (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
                FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, list_inner_product(a.w, b.w)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
            p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
            SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
            FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3""",
        "op12_centroids": _clusters(),
        "op13_fingerprints": f"""
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
            n AS (SELECT doc_id, t, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nt FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, t)),
            e AS (SELECT doc_id, t, nt, concat(substr(t, 1, length(t) - length(t) // 3), substr(nt, 1, length(t) // 3)) AS et FROM n),
            s AS MATERIALIZED (SELECT doc_id, length(t) AS n_chars, sha256(et) AS edited_sha256, {_sketch("t")} AS a, {_sketch("et")} AS b, {_sketch("nt")} AS c FROM e)
            SELECT doc_id, n_chars, edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
                   {_near("a", "b", "resemblance")} AS near_edited, {_near("a", "c", "resemblance")} AS near_next,
                   CASE WHEN len(a) < 128 THEN len(a)::DOUBLE ELSE 127 / (('0x' || a[128])::BIGINT::DOUBLE / 281474976710656.0::DOUBLE) END AS n_shingles,
                   {_near("a", "b", "containment")} AS in_edited
            FROM s""",
    }
