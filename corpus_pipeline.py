"""Corpus cleaning pipeline: filter, deduplicate and encode documents, one written table per stage.

Each stage takes the session, the documents its predecessor kept and the folder of the other tables. All but the last
return the columns of documents; `run` chains them through the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import decontamination, exact_dedup, sentence_pieces, simhash, toxicity
from vitrine.storage import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave the documents that the classifier scores below 0.3."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), modulus=4)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave one row, that of the largest doc_id, of each group of texts equal but for the case of A-Z."""
    return exact_dedup.dedup(docs, keep="max", fold_case=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave the document of the smallest doc_id of each group of near copies."""
    return simhash.thin(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave the documents that hold no run of ten words of a benchmark item, nor a whole shorter item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents left, with digests of the ids and of the text decoded from them."""
    return sentence_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]

#: Fingerprints and merges have no counterpart in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the whole documents table of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
