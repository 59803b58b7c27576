"""Scans, scopes, sessions, catalog reduction and the strategies in use."""

import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

import fixtures as fx
from fixtures import ACCOUNT, AS_OF, CATALOG, D6, D29, POS_ACCOUNT, RETAILER, sku
from vitrine.functions import filters, product_types
from vitrine.functions.times import lookback_window, session_window
from vitrine.operators import collab, pairs, ranking, representatives, scopes, sessions, spread
from vitrine.sources import catalogs, facts
from vitrine.sources.star_schema import StarSchema


def test_windows():
    assert lookback_window(AS_OF, 7) == (datetime(2024, 3, 8), datetime(2024, 3, 15))
    assert session_window((datetime(2024, 3, 8), datetime(2024, 3, 15)))[0] == datetime(2024, 3, 7)


def test_product_type_lists(spark):
    text = "test ,    Clothing > Jeans,\"a, b\" ,x"
    row = spark.range(1).select(
        product_types.parse_list(F.lit(text)).alias("parsed"),
        product_types.trimmed_list_text(F.lit("a ,  b")).alias("trimmed"),
        product_types.buckets(F.lit("a , b")).alias("buckets"),
    ).first()
    assert row.parsed == ["test ", "Clothing > Jeans", "a, b ", "x"]
    assert row.trimmed == "a,b"
    assert row.buckets == ["a", "b", ""]
    a, b = F.array(F.lit("test ")), F.array(F.lit("test"))
    assert spark.range(1).select(
        product_types.any_startswith(a, b), product_types.any_startswith(b, a), product_types.any_contains(a, b)
    ).first()[:] == (True, False, True)


def test_null_and_empty_product_types(spark):
    rows = [sku("S1", "G", product_type=None), sku("S2", "G", product_type=""), sku("S3", "G", product_type="a")]
    stock = fx.catalog(spark, rows)
    assert {(r.id, r.split_product_type) for r in ranking.exploded(stock.select("id", "product_type")).collect()} == {
        ("S2", ""), ("S3", "a"), ("S3", "")
    }
    assert {r.id for r in representatives.representatives(stock).collect()} == {"S2", "S3"}


def test_freshness_and_stock(spark):
    rows = [sku("S1", "G"), sku("S2", "G", update_time=AS_OF - timedelta(days=400), availability="in stock"),
            sku("S3", "G", dataset_id=77), sku("S4", "G", availability="preorder")]
    stock = fx.catalog(spark, rows)
    assert {r.id for r in catalogs.latest(stock, fx.expiration(spark)).collect()} == {"S1", "S4"}
    assert {r.id for r in catalogs.in_stock(stock).collect()} == {"S1", "S2", "S3"}
    assert {r.id for r in catalogs.dataset(stock, RETAILER, CATALOG).collect()} == {"S1", "S2", "S4"}


def test_representatives_keep_fifty_looks(spark):
    rows = [sku(f"S{n:03}", "G", color=f"c{n}") for n in range(120)] + [sku("T1", "H"), sku("T2", "H", image_link="http://img/T1.jpg")]
    kept = representatives.representatives(fx.catalog(spark, rows)).collect()
    assert sorted(r.id for r in kept if r.item_group_id == "G") == [f"S{n:03}" for n in range(70, 120)]
    assert [r.id for r in kept if r.item_group_id == "H"] == ["T2"]


def test_sku_passes_on_a_siblings_product_type(spark):
    rows = [sku("S1", "G", product_type="wanted", image_link="i"), sku("S2", "G", product_type="other", image_link="i")]
    late = {"type": "and", "filters": [fx.leaf("startswith", "product_type", ["wanted"])]}
    spanning = {"type": "and", "filters": [fx.leaf("startswith", "product_type", ["wanted,oth"])]}
    stock = fx.catalog(spark, rows)
    assert [r.id for r in representatives.representatives(stock, [late]).collect()] == ["S2"]
    assert [r.id for r in representatives.representatives(stock, [spanning]).collect()] == ["S2"]


def test_sessions_are_closed_intervals_over_midnight(spark):
    start = datetime(2024, 3, 10, 23, 30)
    session = dict(account_id=1, start_time=start, end_time=start + timedelta(hours=3), mid_ts=1, mid_rnd=1, mid_epoch=0,
                   country_code=None, region="PA")
    base = dict(account_id=1, mid_ts=1, mid_rnd=1, mid_epoch=5)
    times = [start - timedelta(seconds=1), start, start + timedelta(hours=1), start + timedelta(hours=3),
             start + timedelta(hours=3, seconds=1)]
    views = fx.frame(spark, "product_views", [base | dict(fact_time=t, product_id=str(n)) for n, t in enumerate(times)])
    other = fx.frame(spark, "product_views", [base | dict(fact_time=start, product_id="x", mid_rnd=2)])
    accounts = spark.createDataFrame([(1,)], "account_id bigint")
    window = lookback_window(AS_OF, 30)
    places = facts.sessions_between(fx.frame(spark, "sessions", [session]), accounts, session_window(window))
    joined = sessions.join_sessions(views.unionByName(other), places, window).collect()
    assert sorted((r.product_id, r.country_code, r.region) for r in joined) == [(n, "", "PA") for n in "123"]


def test_point_of_sale_dedup(spark):
    line = fx._pos(fx.POS_DATASET, "c", D6, 1)
    rows = [line, line | {"time": D29, "update_time": D6}, line | {"quantity": 4}, line | {"product_id": "null"},
            line | {"customer_id": "d", "update_time": AS_OF - timedelta(days=500)}, line | {"dataset_id": 99}]
    pairs_ = spark.createDataFrame([(POS_ACCOUNT, fx.POS_DATASET)], "account_id bigint, dataset_id bigint")
    got = facts.point_of_sale(fx.frame(spark, "pos_lines", rows), pairs_, fx.expiration(spark), datetime(2024, 1, 1))
    assert sorted((r.customer_id, r.product_id, r.quantity, r.fact_time) for r in got.collect()) == [
        ("c", "TP-00001", 1, D6), ("c", "TP-00001", 4, D6)
    ]


def test_hot_customer_with_repeated_lines(spark):
    """Half of all rows belong to one customer who buys the same things at many prices."""
    rows = [(1, 2, "hot", f"P{n % 5}", n) for n in range(60)] + [(1, 2, f"c{n}", f"P{n % 5}", 1) for n in range(60)]
    schema = "account_id bigint, dataset_id bigint, customer_id string, product_id string, quantity int"
    baskets = spark.createDataFrame(rows, schema).withColumn("fact_time", F.current_timestamp())
    got = pairs.together(baskets, pairs.CUSTOMER).collect()
    assert {(r.pid1, r.pid2) for r in got} == {(f"P{a}", f"P{b}") for a in range(5) for b in range(5) if a != b}
    assert {r.score for r in got} == {144}


def test_scopes(spark):
    accounts, market = fx.accounts(spark), fx.market_accounts(spark)
    ids = lambda df: {r.account_id for r in df.collect()}
    assert ids(scopes.fact_accounts(accounts, market, account_id=ACCOUNT)) == {ACCOUNT}
    assert ids(scopes.fact_accounts(accounts, market, market_id=7)) == {ACCOUNT, POS_ACCOUNT}
    assert ids(scopes.fact_accounts(accounts, market, retailer_id=RETAILER, whole_retailer=True)) == {ACCOUNT, POS_ACCOUNT}
    features = spark.createDataFrame([(ACCOUNT, "precompute")], "account_id bigint, feature string")
    assert ids(scopes.output_accounts(accounts, features, "precompute", retailer_id=RETAILER)) == {ACCOUNT}
    assert ids(scopes.output_accounts(accounts, features, "precompute", account_id=POS_ACCOUNT)) == set()


def test_strategies_in_use(spark):
    old, new = AS_OF - timedelta(days=90), AS_OF - timedelta(days=3)
    strategies = spark.createDataFrame(
        [(1, True, old), (2, False, new), (3, False, old), (4, False, old), (5, False, old), (6, False, old), (7, False, old)],
        "id bigint, is_component boolean, updated timestamp",
    )
    inputs = spark.createDataFrame(
        [
            (10, 1, 10, None, "root"), (10, 2, 3, 3, "recset_id"),  # live action with root
            (11, 1, 10, None, "rec_set_ids"), (11, 2, 3, 4, "item"), (11, 10, 11, 5, "item"),  # 4 inside the list, 5 outside
            (12, 1, 10, None, "root"), (12, 2, 3, 6, "strategy_id"),  # archived group
            (13, 2, 3, 7, "strategy_id"),  # no root
        ],
        "action_id bigint, lft int, rgt int, int_value bigint, name string",
    )
    chain = [(10, 1), (11, 2), (12, 3), (13, 1)]
    actions = spark.createDataFrame(chain, "id bigint, where_id bigint")
    placements = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id bigint, campaign_id bigint")
    campaigns = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id bigint, campaign_group_id bigint")
    groups = spark.createDataFrame(
        [(1, 0, old, 1, None, "page"), (2, 0, old, 0, old, "email_exp"), (3, 1, new, 1, None, "page")],
        "id bigint, archived int, last_modified_time timestamp, active int, end_time timestamp, campaign_type string",
    )
    used = scopes.active_strategies(strategies, inputs, actions, placements, campaigns, groups, AS_OF)
    assert {r.id for r in used.collect()} == {1, 2, 3, 4}


def test_date_partitions_are_pruned(spark, tmp_path):
    """Time bounds reach the date partitions of views, purchases and sessions."""
    rows = [(d, f"2024-03-{d:02d} 10:00:00", 1) for d in range(1, 31)]
    stored = spark.createDataFrame(rows, "n int, at string, account_id bigint").selectExpr(
        "account_id", "CAST(at AS TIMESTAMP) AS fact_time", "CAST(at AS TIMESTAMP) AS start_time", "CAST(at AS TIMESTAMP) AS end_time",
        "CAST(at AS DATE) AS fact_date", "CAST(at AS DATE) AS start_date", "'' AS country_code", "'' AS region", "1L AS mid_ts", "1L AS mid_rnd",
    )
    accounts = spark.createDataFrame([(1,)], "account_id bigint")
    window = (datetime(2024, 3, 10), datetime(2024, 3, 12))
    for day, scan in (
        ("fact_date", lambda df: facts.facts_between(df, accounts, window)),
        ("fact_date", lambda df: facts.facts_since(df, accounts, *window)),
        ("start_date", lambda df: facts.sessions_between(df, accounts, window)),
    ):
        path = str(tmp_path / f"{day}-{len(list(tmp_path.iterdir()))}")
        stored.write.partitionBy(day).parquet(path)
        found = scan(spark.read.parquet(path))
        plan = found._jdf.queryExecution().toString()
        assert re.search(rf"PartitionFilters: \[[^\]]*{day}", plan)
        assert found.count() == 2


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_purchase_sessions_start_from_orders(spark, tmp_path):
    """Orders with several lines, without any, of a customer that comes twice, of low priority, and without a time."""
    tables = dict(
        region=("r_regionkey int, r_name string", [(0, "R")]),
        nation=("n_nationkey int, n_name string, n_regionkey int", [(3, "N", 0)]),
        customer=("c_custkey bigint, c_nationkey int", [(1, 3), (1, 3), (2, 3), (None, 3)]),
        orders=("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string", [
            (10, 1, AS_OF, "1-URGENT"), (11, 1, AS_OF + timedelta(hours=2), "2-HIGH"), (11, 1, AS_OF, "2-HIGH"), (12, 2, AS_OF, "5-LOW"),
            (13, 2, AS_OF, "1-URGENT"), (14, 2, None, "1-URGENT"), (15, None, AS_OF, "1-URGENT"), (None, 1, AS_OF, "1-URGENT"),
        ]),
        lineitem=("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_extendedprice double, l_suppkey bigint", [
            (n, i, 8, 1.0, 2.0, 1) for n in (10, 11, 12, 14, 15, None) for i in (1, 2)
        ]),
    )
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    star = StarSchema(spark, str(tmp_path))
    got = star.purchase_sessions()
    assert sorted(map(str, got.collect())) == sorted(map(str, star._sessions(star.purchase_lines()).collect()))
    assert got.select("mid_ts", "start_time", "end_time").distinct().count() == 2
    assert "LeftSemi" in plan(got)


def test_rows_are_dealt_out_by_their_number(spark, monkeypatch):
    """The file of a catalog is one task, and ids compress well: neither may decide how many rows one task sorts."""
    monkeypatch.setattr(spread, "ROWS_A_TASK", 10)
    assert spread.spread(spark.range(95), "id").rdd.getNumPartitions() == 10
    assert spread.spread(spark.range(95), "id", copies=3).rdd.getNumPartitions() == 29
    catalog = spark.range(95).selectExpr(
        "concat('S', id) AS id", "concat('G', id DIV 4) AS item_group_id", "concat('i', id DIV 4) AS image_link", "concat('c', id DIV 4) AS color", "'a' AS product_type", "'{}' AS custom"
    )
    variants = representatives.variants_for_many(catalog, [[], []], [[], []], lambda f: catalog[f])
    assert variants.rdd.getNumPartitions() == 19 and variants.count() == 48
    none = filters.split_for_pairs(filters.no_filter(), {})
    copied = collab.admitted(catalog, [(none, none)] * 3, {})
    assert copied.rdd.getNumPartitions() == 29 and copied.count() == 285


def test_strategies_in_use_are_dealt_out_by_rows(spark):
    ids = "id bigint, {} bigint"
    inputs = spark.createDataFrame([(1, 1, 100, None, "x"), (1, 2, 3, 7, "recset_id")], "action_id bigint, lft int, rgt int, int_value bigint, name string")
    used = scopes.active_strategies(
        spark.createDataFrame([(7, False, None), (8, False, None)], "id bigint, is_component boolean, updated timestamp"), inputs,
        spark.createDataFrame([(1, 2)], ids.format("where_id")), spark.createDataFrame([(2, 3)], ids.format("campaign_id")),
        spark.createDataFrame([(3, 4)], ids.format("campaign_group_id")),
        spark.createDataFrame([(4, 0, AS_OF, 1, None, "page")], "id bigint, archived int, last_modified_time timestamp, active int, end_time timestamp, campaign_type string"),
        AS_OF,
    )
    assert [r.id for r in used.collect()] == [7]
    assert plan(used).count("RepartitionByExpression") >= 3
