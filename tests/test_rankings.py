"""Global rankings on the hand-made tables, worked out by hand."""

import pytest

from fixtures import ACCOUNT, AS_OF, CATALOG, RETAILER, leaf, ranking_tables, tree
from vitrine.plans import rankings
from vitrine.plans.strategy import AccountSettings, Strategy


def strategy(algorithm, days, filter_json=tree("and"), **more):
    more.setdefault("account_id", ACCOUNT)
    return Strategy(1, algorithm, RETAILER, CATALOG, days, filter_json, **more)


def ranks(df, *bucket):
    out = {}
    for row in df.collect():
        out.setdefault(tuple(row[b] for b in bucket), []).append((row["rank"], int(row["id"][-1])))
    return {k: [i for _, i in sorted(v)] for k, v in out.items()}


def simple(spark, *args, trend=False, **more):
    got = ranks(rankings.recommend(strategy(*args, **more), ranking_tables(spark, trend), AS_OF))
    return got.get((), [])


@pytest.mark.parametrize(
    "algorithm, days, source, expected",
    [
        ("purchase", 7, "online", [5, 6, 2, 3]),
        ("purchase", 7, "offline", [2, 3, 4, 1, 5, 6]),
        ("purchase", 7, "online_offline", [2, 5, 6, 3, 4, 1]),
        ("purchase", 30, "online", [5, 6, 2, 3, 4]),
        ("purchase", 30, "offline", [1, 2, 3, 4, 5, 6]),
        ("purchase", 30, "online_offline", [5, 6, 2, 3, 4, 1]),
        ("purchase_value", 7, "online", [2, 5, 6, 3]),
        ("purchase_value", 7, "offline", [2, 3, 4, 1, 5, 6]),
        ("purchase_value", 7, "online_offline", [2, 3, 5, 6, 4, 1]),
        ("purchase_value", 30, "offline", [1, 2, 3, 4, 5, 6]),
        ("view", 7, "online", [2, 5, 6, 3]),
        ("view", 30, "online", [2, 3, 5, 6, 4]),
        ("most_popular", 7, "online", [2, 5, 6, 3]),
    ],
)
def test_order(spark, algorithm, days, source, expected):
    assert simple(spark, algorithm, days, source=source) == expected


@pytest.mark.parametrize(
    "source, expected", [("online", [5, 6, 4]), ("offline", [1, 2, 3, 4, 5, 6]), ("online_offline", [5, 6, 4, 1, 2, 3])]
)
def test_trending(spark, source, expected):
    assert simple(spark, "trending", 7, source=source, trend=True) == expected


def test_trending_pos_over_thirty_days(spark):
    s = strategy("trending", 7, source="offline")
    got = ranks(rankings.recommend(s, ranking_tables(spark), AS_OF, pos_history="30d"))[()]
    # Equal purchases collapse to their latest time, so all six customers' lines of a product lie in one window.
    assert got == [5, 6, 2, 3, 4, 1]


@pytest.mark.parametrize("scope", [{"whole_retailer": True}, {"market_id": 7}])
def test_wider_scopes(spark, scope):
    s = strategy("purchase", 7, account_id=None, **scope)
    assert ranks(rankings.recommend(s, ranking_tables(spark), AS_OF))[()] == [5, 6, 2, 3]


def test_country(spark):
    s = strategy("purchase", 30, geo_target="country")
    assert ranks(rankings.recommend(s, ranking_tables(spark), AS_OF), "country_code") == {
        ("CA",): [5, 6, 3, 2, 4],
        ("US",): [5, 6, 2],
    }


def test_region(spark):
    s = strategy("purchase", 30, geo_target="region")
    assert ranks(rankings.recommend(s, ranking_tables(spark), AS_OF), "country_code", "region") == {
        ("CA", "ON"): [5, 6, 3, 2, 4],
        ("US", "NJ"): [5, 6],
        ("US", "PA"): [2, 5, 6],
    }


def test_trending_by_place(spark):
    s = strategy("trending", 7, geo_target="region")
    assert ranks(rankings.recommend(s, ranking_tables(spark, True), AS_OF), "country_code", "region") == {
        ("CA", "ON"): [5, 6],
        ("US", "PA"): [4],
    }


CART = tree("and", leaf("startswith", "product_type", "any_item_in_cart", function=True))


def test_product_type_buckets(spark):
    got = ranks(rankings.recommend(strategy("view", 30, CART), ranking_tables(spark), AS_OF), "split_product_type")
    assert got == {
        ("",): [2, 3, 5, 6, 4],
        ("Clothing > Jeans",): [5, 6, 4],
        ("Clothing > Pants",): [2, 3],
        ("test",): [2, 6, 4],
    }


def test_buckets_by_region(spark):
    s = strategy("purchase_value", 7, CART, geo_target="region")
    got = ranks(rankings.recommend(s, ranking_tables(spark), AS_OF), "country_code", "region", "split_product_type")
    assert got == {
        ("CA", "ON", ""): [3, 2, 5, 6],
        ("CA", "ON", "Clothing > Jeans"): [5, 6],
        ("CA", "ON", "Clothing > Pants"): [3, 2],
        ("CA", "ON", "test"): [2, 6],
        ("US", "NJ", ""): [5, 6],
        ("US", "NJ", "Clothing > Jeans"): [5, 6],
        ("US", "NJ", "test"): [6],
        ("US", "PA", ""): [2, 5, 6],
        ("US", "PA", "Clothing > Jeans"): [5, 6],
        ("US", "PA", "Clothing > Pants"): [2],
        ("US", "PA", "test"): [2, 6],
    }


def complex_tree(top, brand, bundle):
    return tree(
        "and",
        leaf("not contains", "product_type", ["jean"]),
        leaf("contains", "brand", [brand]),
        leaf(">=", "price", 2.99),
        leaf(top, "price", 3.99),
        leaf("==", "is_bundle", bundle),
        leaf("==", "unknown_field", False),
    )


@pytest.mark.parametrize(
    "filter_json, expected",
    [
        (tree("and", leaf("startswith", "product_type", ["Clothing > Jeans"])), [5, 6]),
        (tree("and", leaf("startswith", "product_type", ["Clothing > Jeans", "Clothing > Pants"])), [5, 6, 2, 3]),
        (tree("and", leaf("contains", "product_type", ["jean"])), [5, 6]),
        (tree("and", leaf("not contains", "product_type", ["jean"])), [2, 3]),
        (tree("and", leaf("not startswith", "product_type", ["test"])), [5, 3]),
        (tree("and", leaf("startswith", "product_type", ["Clothing_> Pants"])), [2, 3]),
        (tree("and", leaf("==", "product_type", "Clothing > Pants,test")), [2]),
        (complex_tree("<=", "c", True), [2, 3]),
        (complex_tree("<", "c", True), [2]),
        (complex_tree("<=", "d", True), [3]),
        (complex_tree("<=", "d", False), []),
        (tree("or", leaf("contains", "brand", ["c"]), leaf("==", "unknown", False)), [5, 6, 2, 3]),
        (tree("or", leaf("contains", "brand", ["c"]), leaf("dd", "is_bundle", False)), [5, 6, 2, 3]),
        (tree("or", leaf("contains", "brand", ["c"]), leaf("==", "is_bundle", False)), [5, 2, 3]),
        (tree("or", leaf("contains", "brand", ["c"]), leaf("startswith", "product_type", ["test"])), [5, 6, 2, 3]),
        (tree("and", leaf("!=", "id", ["SKU-00002"])), [5, 6, 3]),
        (tree("and", leaf("!=", "id", ["SKU-00002", "SKU-00003"])), [5, 6, 2, 3]),
        (tree("and", leaf("in", "id", ["sku-00003", "SKU-00005"])), [5, 3]),
        (tree("and", leaf("not in", "brand", ["EF"])), [6, 2, 3]),
        (tree("and", leaf("startswith", "brand", [])), []),
        (tree("and", leaf("not startswith", "brand", [])), [5, 6, 2, 3]),
        (tree("and", leaf("startswith", "product_category", ["Daily W"])), [2, 3]),
        (tree("and", leaf("==", "update_time", "2020-01-01")), [5, 6, 2, 3]),
        (tree("and", leaf("in", "color", "items_from_base_recommendation_on", function=True)), [5, 6, 2, 3]),
    ],
)
def test_filters(spark, filter_json, expected):
    assert simple(spark, "purchase", 7, filter_json) == expected


def test_account_filter_is_added(spark):
    s = strategy("purchase", 7, tree("and", leaf("not contains", "product_type", ["jean"])))
    shared = AccountSettings(filter_json=tree("or", leaf("==", "brand", "bc")))
    assert ranks(rankings.recommend(s, ranking_tables(spark), AS_OF, shared))[()] == [2]


def test_scores(spark):
    rows = rankings.recommend(strategy("purchase", 7), ranking_tables(spark), AS_OF).collect()
    assert {r["id"]: float(r["score"]) for r in rows} == {
        "SKU-00005": 1000.0, "SKU-00006": 1000.0, "SKU-00002": 833.34, "SKU-00003": 500.0,
    }


def test_accounts_ranked_side_by_side(spark):
    tables = ranking_tables(spark)
    s = strategy("purchase", 7, account_id=None, whole_retailer=True, source="online_offline")
    table = rankings.metric(s, tables, AS_OF)
    got = ranks(rankings.rank(s, tables, AccountSettings(), table, per_account=True), "account_id")
    assert got == {(ACCOUNT,): [2, 5, 6, 3, 4, 1]}


def test_missing_pos_data_is_an_error(spark):
    with pytest.raises(ValueError):
        rankings.recommend(strategy("purchase", 7, source="offline"), ranking_tables(spark, settings=None), AS_OF)


@pytest.mark.parametrize("filter_json", [tree("and"), tree("and", leaf("startswith", "product_type", "any_item_in_cart", function=True))])
def test_facts_are_read_once(spark, filter_json):
    """The highest score and the rows both start from the written scores."""
    df = rankings.recommend(strategy("purchase", 30, filter_json, geo_target="country"), ranking_tables(spark), AS_OF)
    assert any("/scores-" in file for file in df.inputFiles())
    assert "start_time" not in df._jdf.queryExecution().optimizedPlan().toString()
