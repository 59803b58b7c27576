"""Item-to-item lists on the hand-made tables, worked out by hand."""

import pytest

from fixtures import ACCOUNT, AS_OF, CATALOG, CATALOG_FIELDS, RETAILER, catalog, leaf, pair_tables, sku, tree
from vitrine.functions import filters
from vitrine.operators import collab, pairs, ranking
from vitrine.plans import pairings
from vitrine.plans.strategy import AccountSettings, Strategy

BASE = "items_from_base_recommendation_on"
ONLY_FIRST = tree("and", leaf("startswith", "product_type", ["Clothing > Shirt"]))


def strategy(algorithm, days, filter_json=tree("and"), **more):
    more.setdefault("account_id", ACCOUNT)
    return Strategy(1, algorithm, RETAILER, CATALOG, days, filter_json, **more)


def lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(int(r["lookup_key"][-1]), []).append((r["rank"], int(r["id"][-1])))
    return {k: [i for _, i in sorted(v)] for k, v in out.items()}


TOGETHER_30 = {1: [4, 3, 2, 6, 5], 2: [4, 3, 1, 6, 5], 3: [4, 2, 1, 6, 5], 4: [3, 2, 1, 6, 5], 5: [4, 3, 2, 1]}
VIEWED_30 = {4: [6, 5, 3, 2, 1], 1: [3, 2, 6, 5, 4], 3: [2, 1, 6, 5, 4], 5: [4, 3, 2, 1], 2: [3, 1, 6, 5, 4]}
MARKET = {"account_id": None, "market_id": 7, "source": "online_offline"}
RETAIL = {"account_id": None, "whole_retailer": True, "source": "offline"}


@pytest.mark.parametrize(
    "algorithm, days, more, expected",
    [
        ("purchase_also_purchase", 30, {}, TOGETHER_30),
        ("purchase_also_purchase", 2, RETAIL, {1: [4, 3, 2], 4: [3, 2, 1], 3: [4, 2, 1], 2: [4, 3, 1]}),
        ("purchase_also_purchase", 2, MARKET,
         {1: [6, 5, 4, 3, 2], 4: [6, 5, 3, 2, 1], 3: [4, 2, 1], 5: [4, 2, 1], 2: [6, 5, 4, 3, 1]}),
        ("bought_together", 30, {}, {1: [4, 3, 2, 6, 5], 4: [3, 2, 1], 3: [4, 1, 6, 5], 5: [3, 2, 1], 2: [1, 5]}),
        ("bought_together", 7, {}, {1: [4, 2, 6, 5, 3], 4: [2, 1, 3], 3: [4, 1], 5: [2, 1], 2: [1, 5]}),
        ("bought_together", 2, RETAIL, {1: [4, 3, 2], 4: [3, 2, 1], 3: [4, 1], 2: [1]}),
        ("bought_together", 2, MARKET, {1: [6, 5, 4, 3, 2], 4: [3, 2, 1], 3: [4, 1], 5: [2, 1], 2: [5, 1]}),
        ("subsequently_purchased", 30, {}, {1: [3, 2], 4: [2, 3, 1], 3: [6, 5, 4, 2, 1], 5: [4, 2, 1], 2: [1]}),
        ("subsequently_purchased", 7, {}, {4: [2, 1], 5: [4, 2, 1], 2: [1]}),
        ("subsequently_purchased", 2, RETAIL, {4: [1], 3: [4, 2, 1], 2: [4, 1]}),
        ("subsequently_purchased", 2, MARKET, {4: [2, 1], 3: [4, 2, 1], 5: [4, 2, 1], 2: [4, 1]}),
        ("view_also_view", 30, {}, VIEWED_30),
        ("view_also_view", 30, {"account_id": None, "market_id": 7}, VIEWED_30),
        ("view_also_view", 30, {"account_id": None, "whole_retailer": True}, VIEWED_30),
        ("view_also_view", 7, {}, {4: [6, 5], 5: [4]}),
        ("purchase_also_purchase", 30, {"filter_json": ONLY_FIRST}, {2: [1], 3: [1], 4: [1], 5: [1]}),
        ("view_also_view", 30, {"filter_json": ONLY_FIRST}, {2: [1], 3: [1], 4: [1], 5: [1]}),
        ("subsequently_purchased", 30, {"filter_json": ONLY_FIRST}, {2: [1], 3: [1], 4: [1]} | {5: [1]}),
    ],
)
def test_lists(spark, algorithm, days, more, expected):
    assert lists(pairings.recommend(strategy(algorithm, days, **more), pair_tables(spark), AS_OF)) == expected


def test_base_item_colour(spark):
    s = strategy("view_also_view", 30, tree("and", leaf("in", "color", BASE, function=True)))
    assert lists(pairings.recommend(s, pair_tables(spark), AS_OF)) == {1: [2], 2: [1], 3: [4], 4: [3]}


def test_base_item_brand_twice(spark):
    s = strategy("view_also_view", 7, tree("and", *[leaf("not in", "brand", BASE, function=True)] * 2))
    assert lists(pairings.recommend(s, pair_tables(spark), AS_OF)) == {4: [6, 5], 5: [4]}


def test_base_item_custom_field(spark):
    s = strategy("view_also_view", 30, tree("and", leaf("<", "product_category", BASE, function=True)))
    # Any comparison with the base item is equality: blank and underscore differ.
    assert lists(pairings.recommend(s, pair_tables(spark), AS_OF)) == {
        1: [3, 2, 4], 2: [3, 1, 4], 3: [2, 1, 4], 4: [3, 2, 1]
    }


def test_base_item_startswith(spark):
    s = strategy("view_also_view", 30, tree("and", leaf("startswith", "product_category", BASE, function=True)))
    got = lists(pairings.recommend(s, pair_tables(spark), AS_OF))
    # LIKE reads the underscore of the base item as any character.
    assert got == {1: [3, 2, 4], 2: [3, 1, 4], 3: [2, 1, 4], 4: [3, 2, 1], 5: [4, 3, 2, 1]}


def test_buckets(spark):
    s = strategy("view_also_view", 7, tree("and", leaf("startswith", "product_type", "any_item_in_cart", function=True)))
    rows = pairings.recommend(s, pair_tables(spark), AS_OF).collect()
    got = {}
    for r in rows:
        got.setdefault((r["lookup_key"][-1], r["split_product_type"]), []).append((r["rank"], int(r["id"][-1])))
    assert {k: [i for _, i in sorted(v)] for k, v in got.items()} == {
        ("4", ""): [6, 5], ("4", "Clothing > Jeans"): [6, 5], ("4", "test"): [6],
        ("5", ""): [4], ("5", "Clothing > Jeans"): [4], ("5", "test"): [4],
    }


def test_minimum_purchases(spark):
    s = strategy("purchase_also_purchase", 30)
    got = pairings.product_pairs(s, pair_tables(spark), AS_OF, AccountSettings(minimum_purchases=3))
    assert {(r.pid1[-1], r.pid2[-1], r.score) for r in got.collect()} == {
        (a, b, 3) for a in "1234" for b in "1234" if a != b
    }


def test_pos_strategy_without_pos_data_runs_online(spark):
    tables = pair_tables(spark, settings=spark.createDataFrame([], "account_id bigint, pos_dataset_id bigint"))
    s = strategy("purchase_also_purchase", 30, source="offline")
    settings = AccountSettings(has_point_of_sale=False)
    assert lists(pairings.recommend(s, tables, AS_OF, settings)) == TOGETHER_30


def test_merge_of_sequences(spark):
    one = spark.createDataFrame([(1, "a", "b", 5)], "account_id bigint, pid1 string, pid2 string, score bigint")
    two = spark.createDataFrame([(1, "a", "b", 4), (1, "b", "a", 4)], one.schema)
    assert {(r.pid1, r.score) for r in pairs.merged(one, two, "source_count").collect()} == {("a", 2), ("b", 1)}
    assert {(r.pid1, r.score) for r in pairs.merged(one, two).collect()} == {("a", 9), ("b", 4)}


def test_view_cap_drops_devices(spark):
    s = strategy("view_also_view", 30)
    got = pairings.product_pairs(s, pair_tables(spark), AS_OF, monthly_view_cap=5)
    # Devices 0 and 2 saw five products, which is not below the cap; one device is left and no pair is seen twice.
    assert got.count() == 0
    assert pairings.product_pairs(s, pair_tables(spark), AS_OF, monthly_view_cap=6).count() == 20


def test_large_baskets_are_split_exactly(spark, monkeypatch):
    s = strategy("subsequently_purchased", 30)
    t = strategy("purchase_also_purchase", 30)
    whole = [sorted(pairings.product_pairs(x, pair_tables(spark), AS_OF).collect()) for x in (s, t)]
    monkeypatch.setattr(pairs, "BASKET_ROWS", 2)
    split = [sorted(pairings.product_pairs(x, pair_tables(spark), AS_OF).collect()) for x in (s, t)]
    assert whole == split


def test_normalised_scores_and_ordinals(spark):
    ranked = pairings.ranked_products(pairings.product_pairs(strategy("view_also_view", 30), pair_tables(spark), AS_OF))
    rows = ranking.pair_ordinals(ranked).collect()
    assert {float(r.normalized_score) for r in rows if r.score == 3} == {1000.0}
    assert {float(r.normalized_score) for r in rows if r.score == 2} == {0.01}
    first = sorted((r.ordinal, r.product_id[-1]) for r in rows if r.lookup_key == "TP-00001")
    assert first == [(1, "3"), (2, "2"), (3, "5"), (4, "4")]


@pytest.mark.parametrize("algorithm", ["view_also_view", "bought_together"])
def test_lists_of_few_looks_are_not_tested_to_the_end(spark, monkeypatch, algorithm):
    """Three looks over 60 products: the lists are full after the best of them, the highest SKU of a look among them or not."""
    rows = [sku(f"S-{n:03}", f"TP-{n:03}", color=f"c{n % 3}", image_link="i", product_type=f"t{n}") for n in range(60)]
    scored = spark.createDataFrame([(1, "TP-000", f"TP-{n:03}", 100 - n) for n in range(1, 60)], "account_id bigint, lookup_key string, product_id string, score bigint")
    own = filters.split_for_pairs(filters.with_algorithm_filter(tree("and"), algorithm), CATALOG_FIELDS)
    none = filters.split_for_pairs(filters.no_filter(), CATALOG_FIELDS)
    exploded, test = [], collab.sku_lists

    def recorded(sku_pairs, *more):
        exploded.append(sku_pairs.count())
        return test(sku_pairs, *more)

    monkeypatch.setattr(collab, "sku_lists", recorded)
    got = collab.explode_pairs(scored, catalog(spark, rows), own, none, CATALOG_FIELDS, limit=3).collect()
    assert sorted((r["rank"], r["id"]) for r in got) == [(1, "S-001"), (2, "S-002"), (3, "S-003")]
    assert exploded == [collab.FIRST_LOOK * 3]


def test_short_feeds_take_one_shuffle(spark):
    rows = [(1, "a", f"p{n:03}", n % 7) for n in range(100)] + [(1, "b", "p1", 1), (2, "a", "p1", 1)]
    scored = spark.createDataFrame(rows, "account_id bigint, lookup_key string, product_id string, score int")
    short = ranking.pair_ordinals(scored, limit=5)
    assert short._jdf.queryExecution().sparkPlan().toString().count("WindowGroupLimit") == 2  # in the task, then after the shuffle
    expected = sorted(r for r in ranking.pair_ordinals(scored).collect() if r.ordinal <= 5)
    assert sorted(short.collect()) == expected
