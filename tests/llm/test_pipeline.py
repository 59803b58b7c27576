import hashlib
import random
from collections import defaultdict

import public_tokenizers
import pytest
from helpers import DOCS, frame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from test_decontamination import _brute as _hits
from test_simhash import _classes, _fingerprint

import corpus_pipeline
from vitrine.llm import toxicity

MEAN = ["vile", "nasty"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(21)
    word = lambda: "".join(draw.choice("aeioulnrst") for _ in range(draw.randrange(2, 6)))
    item = " ".join(word() for _ in range(14))
    rows, labels = [], []
    for i in range(260):
        words = [word() for _ in range(draw.randrange(1, 50))]
        kind = draw.randrange(8)
        toxic = draw.random() < 0.3
        if kind == 0 and rows:
            text = draw.choice(rows)[1] or ""
            toxic = any(m in text for m in MEAN)
        elif kind == 1 and rows:
            text = (draw.choice(rows)[1] or "").upper()
            toxic = any(m.upper() in text for m in MEAN)
        elif kind == 2:
            text = " ".join(words) + " " + " ".join(item.split()[draw.randrange(4) :]) + ". " + word()
            toxic = False
        else:
            text = " ".join(words)
            if toxic:
                text += " " + draw.choice(MEAN) + " " + word() + " " + draw.choice(MEAN)
        rows.append((i, text, draw.choice(["en", "de", None]), "s", len(text)))
        labels.append((i, 1, int(toxic)))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0), (905, rows[7][1], "en", "s", 1), (905, rows[7][1], "en", "s", 1)]
    path = tmp_path_factory.mktemp("corpus")
    frame(spark, rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, item


def _expected(spark, path, rows, item):
    documents = spark.read.parquet(f"{path}/documents.parquet")
    scored = toxicity.toxicity(documents, spark.read.parquet(f"{path}/labels.parquet"))
    toxic = {r.doc_id for r in scored.where("predicted = 1").collect()}
    left = {r[0]: r[1] or "" for r in rows if r[0] not in toxic}
    groups = defaultdict(list)
    for i, t in left.items():
        groups[t.lower()].append(i)
    left = {max(ids): left[max(ids)] for ids in groups.values()}
    ids = sorted(left)
    prints = [_fingerprint(left[i]) for i in ids]
    classes = _classes(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2])
    left = {ids[c]: left[ids[c]] for c in set(classes)}
    left = {i: t for i, t in left.items() if not _hits(t, [(1, item)], 10)[1]}
    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = []
    for i, t in left.items():
        encoded = model.encode(t)
        out.append((i, len(encoded), sha(",".join(map(str, encoded))), sha(model.decode(encoded) if encoded else "")))
    return sorted(out), toxic


def test_run_equals_the_stages_worked_by_hand(spark, folder):
    path, rows, item = folder
    expected, toxic = _expected(spark, path, rows, item)
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, path).collect())
    assert got == expected
    assert toxic and 50 < len(got) < len(rows) - len(toxic)


def test_every_stage_takes_awkward_tables(spark, folder):
    path, rows, _ = folder
    odd = frame(spark, [(None, None, None, None, None), (None, "a b", None, "s", 1), *rows[:20]]).withColumn("score", F.lit("x")).withColumn("key", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (odd, odd.limit(0), frame(spark, [])):
            kept = stage(spark, df, path)
            assert kept.columns == df.columns, name
            assert kept.count() <= df.count()
    assert corpus_pipeline.STAGES[-1][1](spark, odd, path).count() == odd.count()
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"
    assert frame(spark, []).columns == [f.split()[0] for f in DOCS.split(", ")]
