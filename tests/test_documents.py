"""Documents, shards, and many strategies in one run."""

import hashlib
import json
import zlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fixtures import ACCOUNT, AS_OF, CATALOG, RETAILER, leaf, pair_tables, ranking_tables, tree
from vitrine.functions import sharding
from vitrine.operators import documents, publish
from vitrine.plans import fan_out, pairings, rankings
from vitrine.plans.strategy import AccountSettings, Strategy

CART = tree("and", leaf("startswith", "product_type", "any_item_in_cart", function=True))
SENT = datetime(2024, 3, 15, 12, 34, 56)


def sha1(text):
    return hashlib.sha1(text.lower().encode()).hexdigest()


def as_json(df):
    return [json.loads(line) for line in df.toJSON().collect()]


def test_shard_range(spark):
    key = sharding.shard_key(F.lit(123))
    row = spark.range(1).select(key, sharding.shard_low(key), sharding.shard_high(key)).first()
    assert tuple(row) == (549842, 524288, 655360)
    docs = spark.createDataFrame(
        [((123,), ("RECSET_RECS", 7, None, None, None, None, None)), ((123,), ("RECSET_COLLAB_RECS", 7, None, None, None, None, None)), ((123,), ("RECSET_COLLAB_RECS_PID", None, 123, None, 9, "view_also_view", 30))],
        "account struct<id: bigint>, schema struct<feed_type: string, id: int, account_id: bigint, market_id: bigint, retailer_id: bigint, algorithm: string, lookback_days: int>",
    )
    shard = zlib.crc32(b"123None9") % (1 << 20) // 131072 * 131072
    assert [r[0] for r in docs.select(publish.label(docs, SENT)).collect()] == [
        "recs_global-20240315T123400.000Z_PT1M-524288-655360-precompute_123_7_new.json.gz",
        "recs_global-20240315T123400.000Z_PT1M-524288-655360-precompute_123_7.json.gz",
        f"recs_global_pid_pid-20240315T123400.000Z_PT1M-{shard}-{shard + 131072}-precompute_123_None_9_view_also_view_30.json.gz",
    ]


def test_global_document(spark):
    s = Strategy(1001, "view", RETAILER, CATALOG, 7, tree("and"), account_id=ACCOUNT)
    ranks = rankings.recommend(s, ranking_tables(spark), AS_OF)
    (doc,) = as_json(documents.global_documents(ranks, (), ACCOUNT, 1001, SENT))
    assert doc["document"]["pushdown_filter_hash"] == sha1("product_type=")
    assert [(d["id"][-1], d["rank"]) for d in doc["document"]["data"]] == [("2", 1), ("5", 2), ("6", 3), ("3", 4)]
    assert [d["normalized_score"] for d in doc["document"]["data"]] == [1000.0, 714.29, 714.29, 428.58]
    assert doc["account"] == {"id": ACCOUNT}
    assert doc["schema"] == {"feed_type": "RECSET_NONCOLLAB_RECS", "id": 1001}
    assert doc["sent_time"] == "2024-03-15 12:34:00"


def test_bucket_names(spark):
    s = Strategy(5, "purchase_value", RETAILER, CATALOG, 7, CART, geo_target="region", account_id=ACCOUNT)
    ranks = rankings.recommend(s, ranking_tables(spark), AS_OF)
    geo = sharding.geo_columns("region")
    older = {d["document"]["pushdown_filter_hash"] for d in as_json(documents.global_documents(ranks, geo, ACCOUNT, 5, SENT))}
    assert len(older) == 11
    assert sha1("product_type=Clothing > Jeans/country_code=CA/region=ON") in older
    unified = as_json(documents.unified_documents(ranks, geo, ACCOUNT, 5, SENT))
    texts = {d["document"]["pushdown_filter_json"] for d in unified}
    assert len(texts) == 11 and '{"_country_code":"us","_region":"pa","product_type":"clothing > pants"}' in texts
    assert all(d["document"]["pushdown_filter_hash"] == sha1(d["document"]["pushdown_filter_json"]) for d in unified)
    assert {d["document"]["lookup_key"] for d in unified} == {""}
    assert {d["schema"]["feed_type"] for d in unified} == {"RECSET_RECS"}


def test_pair_documents(spark):
    s = Strategy(8, "view_also_view", RETAILER, CATALOG, 7, CART, account_id=ACCOUNT)
    tables = pair_tables(spark)
    lists = pairings.recommend(s, tables, AS_OF)
    unified = as_json(documents.unified_documents(lists, (), ACCOUNT, 8, SENT))
    assert {(d["document"]["lookup_key"], d["document"]["pushdown_filter_json"]) for d in unified} >= {
        ("TP-00004", '{"product_type":"clothing > jeans"}'), ("TP-00005", '{"product_type":""}')
    }
    plain = pairings.recommend(Strategy(8, "view_also_view", RETAILER, CATALOG, 7, account_id=ACCOUNT), tables, AS_OF)
    docs = {d["document"]["lookup_key"]: d for d in as_json(documents.pair_documents(plain, ACCOUNT, 8, SENT))}
    assert [e["id"] for e in docs["TP-00004"]["document"]["data"]] == ["SKU-00006", "SKU-00005"]
    assert docs["TP-00004"]["schema"]["feed_type"] == "RECSET_COLLAB_RECS"


def test_many_strategies_share_their_start(spark, tmp_path):
    tables = pair_tables(spark)

    def pair_strategy(n, algorithm, filter_json=tree("and")):
        return Strategy(n, algorithm, RETAILER, CATALOG, 30, filter_json, account_id=ACCOUNT)

    outputs = [
        fan_out.Output(pair_strategy(1, "purchase_also_purchase"), ACCOUNT, unified=True),
        fan_out.Output(pair_strategy(2, "bought_together"), ACCOUNT),
        fan_out.Output(
            pair_strategy(3, "similar_products_v2"), ACCOUNT, AccountSettings(similarity_weights=(("color", 0.5),))
        ),
    ]
    assert fan_out.shared_key(outputs[0]) == fan_out.shared_key(outputs[1])
    docs = fan_out.all_documents(outputs, tables, AS_OF, SENT)
    manifest = publish.publish(docs, str(tmp_path / "out"), SENT, [(ACCOUNT, 1), (ACCOUNT, 2), (ACCOUNT, 3), (99, 9)])
    back = publish.published(spark, str(tmp_path / "out"))
    found = {(r.output, r.unified, r.feed): r.n for r in back.groupBy("output", "unified", F.col("schema.feed_type").alias("feed")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert found == {
        (f"{ACCOUNT}_1", False, "RECSET_COLLAB_RECS"): 5, (f"{ACCOUNT}_1", True, "RECSET_RECS"): 5, (f"{ACCOUNT}_2", False, "RECSET_COLLAB_RECS"): 5, (f"{ACCOUNT}_3", False, "RECSET_COLLAB_RECS"): 5,
    }
    bought = back.where(f"output = '{ACCOUNT}_2' AND document.lookup_key = 'TP-00002'").first()
    assert [e.id for e in bought.document.data] == ["SKU-00001", "SKU-00005"]
    files = list((tmp_path / "out").rglob("*.json.gz"))
    assert files and all("recs_global-20240315T123400.000Z_PT1M-" in str(f) for f in files)
    entries = back.where("not unified").groupBy("output").agg(F.sum(F.size("document.data")).alias("n")).collect()
    assert {f"{e['account']}_{e['strategy']}": e["n"] for e in manifest["entries"]} == {r.output: r.n for r in entries} | {"99_9": 0}


def _docs(spark, strategy, value, algorithm=None):
    schema = ("RECSET_COLLAB_RECS_PID", None, None, None, RETAILER, algorithm, 30) if algorithm else ("RECSET_COLLAB_RECS", strategy, None, None, None, None, None)
    return spark.createDataFrame(
        [((ACCOUNT,), schema, ("TP", [(value,)]))],
        "account struct<id: bigint>, schema struct<feed_type: string, id: int, account_id: bigint, market_id: bigint, retailer_id: bigint, algorithm: string, lookback_days: int>, document struct<lookup_key: string, data: array<struct<id: string>>>",
    )


def test_runs_of_one_minute_replace_their_own_labels_only(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(ValueError):
        publish.published(spark, path)
    publish.publish(_docs(spark, 1, "old").unionByName(_docs(spark, 2, "two")), path, SENT)
    publish.publish(_docs(spark, None, "views", "view_also_view"), path, SENT)
    publish.publish(_docs(spark, None, "bought", "purchase_also_purchase"), path, SENT)
    publish.publish(_docs(spark, 1, "new"), path, SENT)
    publish.publish(_docs(spark, 1, "later"), path, datetime(2024, 3, 15, 12, 35))

    def seen(**some):
        return sorted((r.minute[-4:], r.output, r.document.data[0].id) for r in publish.published(spark, path, **some).collect())

    first = [
        ("1234", f"{ACCOUNT}_1", "new"), ("1234", f"{ACCOUNT}_2", "two"),
        ("1234", f"None_None_{RETAILER}_purchase_also_purchase_30", "bought"), ("1234", f"None_None_{RETAILER}_view_also_view_30", "views"),
    ]
    assert seen() == sorted([*first, ("1235", f"{ACCOUNT}_1", "later")])
    assert seen(minutes=[SENT]) == first

    def broken(x):
        raise RuntimeError("executor lost")

    half = _docs(spark, 2, "half").unionByName(_docs(spark, 1, "half")).withColumn("sent_time", F.udf(broken)(F.lit(1)))
    with pytest.raises(Exception, match="executor lost"):
        publish.publish(half, path, SENT)
    _docs(spark, 1, "orphan").withColumn("label", publish.label(_docs(spark, 1, ""), SENT)).write.partitionBy("label").json(f"{path}/runs/run=killed")
    assert seen(minutes=[SENT]) == first
    assert publish.sweep(spark, path) >= 1
    assert seen(minutes=[SENT]) == first


def test_nothing_to_render(spark):
    with pytest.raises(ValueError):
        fan_out.all_documents([], ranking_tables(spark), AS_OF, SENT)


def _many(n):
    """Strategies of all shapes: with and without buckets, tests on merged texts, geo targets, dynamic filters."""
    cart = leaf("startswith", "product_type", "any_item_in_cart", function=True)
    base = "items_from_base_recommendation_on"
    shapes = [
        ("view", tree("and", leaf(">", "price", 2)), "none"), ("view", tree("or", leaf("not contains", "product_type", ["jeans"])), "none"),
        ("most_popular", tree("and", cart), "none"), ("view", tree("and", leaf("startswith", "product_type", ["Clothing > %,"])), "none"), ("view", tree("and"), "country"),
    ]
    lists = [
        ("view_also_view", tree("and", leaf("in", "color", base, function=True)), "none"), ("view_also_view", tree("and", leaf("not startswith", "product_type", base, function=True)), "none"),
        ("view_also_view", tree("and", cart), "none"), ("view_also_view", tree("and", leaf("<", "price", 6)), "none"), ("similar_products_v2", tree("and", leaf("in", "color", base, function=True)), "none"),
    ]
    for family in (shapes, lists):
        yield [Strategy(k, a, RETAILER, CATALOG, 30, f, geo_target=g, account_id=ACCOUNT) for k, (a, f, g) in zip(range(n), family * n)]


WEIGHTS = AccountSettings(similarity_weights=(("color", 0.5), ("brand", 0.25)))


def test_strategies_rendered_together_equal_each_alone(spark):
    for strategies, tables in zip(_many(5), (ranking_tables(spark), pair_tables(spark))):
        outputs = [fan_out.Output(s, ACCOUNT, WEIGHTS) for s in strategies]
        got = {}
        for d in as_json(fan_out.all_documents(outputs, tables, AS_OF, SENT)):
            got.setdefault(d["schema"]["id"], []).append(json.dumps(d, sort_keys=True))
        for s in strategies:
            geo = sharding.geo_columns(s.geo_target)
            if s.algorithm in ("view", "most_popular"):
                alone = documents.global_documents(rankings.recommend(s, tables, AS_OF, WEIGHTS), geo, ACCOUNT, s.id, SENT)
            else:
                alone = documents.pair_documents(pairings.recommend(s, tables, AS_OF, WEIGHTS), ACCOUNT, s.id, SENT)
            assert sorted(got.get(s.id, [])) == sorted(json.dumps(d, sort_keys=True) for d in as_json(alone)), s


def _nodes(df):
    return str(df._jdf.queryExecution().optimizedPlan().toString()).count("\n")


def test_plan_does_not_grow_with_strategies(spark):
    tables = ranking_tables(spark)

    def plan(n):
        outputs = [
            fan_out.Output(Strategy(k, "view", RETAILER, CATALOG, 30, tree("and", leaf(">", "price", k / 50), leaf("contains", "product_type", [f"t{k}", "Pants"])), account_id=ACCOUNT), ACCOUNT)
            for k in range(n)
        ]
        return fan_out.all_documents(outputs, tables, AS_OF, SENT)

    few, many = plan(3), plan(200)
    assert _nodes(many) == _nodes(few)
    found = {d["schema"]["id"]: [e["id"] for e in d["document"]["data"]] for d in as_json(many)}
    assert len(found) > 100
    for k in (0, 99, 149):
        (alone,) = as_json(plan_of_one(tables, k))
        assert found[k] == [e["id"] for e in alone["document"]["data"]]


def plan_of_one(tables, k):
    s = Strategy(k, "view", RETAILER, CATALOG, 30, tree("and", leaf(">", "price", k / 50), leaf("contains", "product_type", [f"t{k}", "Pants"])), account_id=ACCOUNT)
    return documents.global_documents(rankings.recommend(s, tables, AS_OF), (), ACCOUNT, k, SENT)
