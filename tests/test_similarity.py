"""Similar products: hand-worked lists, and brute force on random catalogs."""

import random
from decimal import Decimal, ROUND_HALF_UP

import pytest

from fixtures import AS_OF, CATALOG, CATALOG_FIELDS, RETAILER, catalog, expiration, accounts, leaf, sku, tree
from vitrine.operators import similarity
from vitrine.plans import pairings
from vitrine.plans.strategy import AccountSettings, Strategy, Tables

BASE = "items_from_base_recommendation_on"


def run(spark, weights, filter_json=tree("and"), rows=None):
    tables = Tables(catalog=catalog(spark, rows), expiration=expiration(spark), accounts=accounts(spark),
                    catalog_fields=CATALOG_FIELDS)
    s = Strategy(1, "similar_products_v2", RETAILER, CATALOG, 30, filter_json, account_id=41)
    return pairings.recommend(s, tables, AS_OF, AccountSettings(similarity_weights=weights))


def lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(int(r["lookup_key"][-1]), []).append((r["rank"], int(r["id"][-1])))
    return {k: [i for _, i in sorted(v)] for k, v in out.items()}


COLOUR = {4: [3, 6, 5, 2, 1], 1: [2, 6, 5, 4, 3], 3: [4, 6, 5, 2, 1], 5: [4, 3, 2, 1], 2: [1, 6, 5, 4, 3]}


@pytest.mark.parametrize(
    "weights, filter_json, expected",
    [
        ((("color", 0.5), ("product_type", 0.1)), tree("and"), COLOUR),
        ((("color", None), ("product_type", None)), tree("and"), COLOUR),
        ((("color", 0), ("product_type", 0), ("no_such_field", 3)), tree("and"), COLOUR),
        ((("product_category", 0.5),), tree("and"),
         {4: [3, 2, 1, 6, 5], 1: [4, 3, 2, 6, 5], 3: [4, 2, 1, 6, 5], 5: [4, 3, 2, 1], 2: [4, 3, 1, 6, 5]}),
        ((("color", 0.5), ("product_type", 0.1)),
         tree("and", leaf("startswith", "product_type", ["Clothing > Shirt"])), {2: [1], 3: [1], 4: [1], 5: [1]}),
        ((("color", 0.5),), tree("and", leaf("in", "color", BASE, function=True)), {1: [2], 2: [1], 3: [4], 4: [3]}),
    ],
)
def test_lists(spark, weights, filter_json, expected):
    assert lists(run(spark, weights, filter_json)) == expected


def test_negative_weights_are_refused(spark):
    with pytest.raises(ValueError):
        run(spark, (("color", -1.0),))


def brute_force(rows, weights, limit, dynamic=None):
    """Every SKU pair, then the list of each lookup key, in plain Python."""
    six = Decimal("0.000001")
    shares = {}
    for name, weight in weights:
        for r in rows:
            n = sum(1 for x in rows if x[name] == r[name])
            shares[name, r[name]] = (
                Decimal(str(weight)) if weight else (Decimal(1) / n).quantize(six, ROUND_HALF_UP)
            )
    scores = {}
    for a in rows:
        for b in rows:
            if a["item_group_id"] != b["item_group_id"]:
                s = sum((shares[n, a[n]] for n, _ in weights if a[n] is not None and a[n] == b[n]), Decimal(0))
                scores.setdefault((a["item_group_id"], b["item_group_id"]), set()).add(s)
    out = {}
    for (look, group), values in scores.items():
        for r in rows:
            if r["item_group_id"] != group:
                continue
            if dynamic and not any(
                c["item_group_id"] == look and c[dynamic] is not None and c[dynamic] == r[dynamic] for c in rows
            ):
                continue
            for s in values:
                key = (s, r["color"], r["image_link"])
                best = out.setdefault(look, {})
                best[key] = max(best.get(key, ""), r["id"])
    return {
        look: sorted(((s, i) for (s, _, _), i in best.items()), reverse=True)[:limit] for look, best in out.items()
    }


@pytest.mark.parametrize("seed, dynamic", [(1, None), (2, None), (3, "brand"), (4, None)])
def test_against_all_pairs(spark, monkeypatch, seed, dynamic):
    """Few looks, a dominating colour and a dominating group, NULLs, and a limit small enough to prune."""
    rng = random.Random(seed)
    rows = []
    for n in range(90):
        rows.append(sku(
            f"SKU-{rng.randrange(10**6):06d}-{n}",
            "TP-0" if n % 3 == 0 else f"TP-{rng.randrange(1, 20)}",
            color=rng.choice(["black"] * 5 + ["red", "blue", None]),
            brand=rng.choice(["x", "x", "x", "y", "z", None]),
            category="c",
            image_link=rng.choice(["same", "same", "other", f"own-{n}"]),
        ))
    weights = (("color", 0.5), ("brand", None if seed % 2 else 0.25))
    limit = 3
    fields = CATALOG_FIELDS
    from vitrine.functions import filters

    trees = tree("and", *([leaf("in", dynamic, BASE, function=True)] if dynamic else []))
    nothing = filters.split_for_pairs(tree("and"), fields)
    stock = catalog(spark, rows)
    got = similarity.similar_skus(
        stock, stock, weights, filters.split_for_pairs(trees, fields), nothing, fields, limit=limit
    ).where(f"rank <= {limit}")
    found = {}
    for r in got.collect():
        found.setdefault(r["lookup_key"], []).append((r["rank"], r["score"], r["id"]))
    found = {k: [(s, i) for _, s, i in sorted(v)] for k, v in found.items()}
    assert found == brute_force(rows, weights, limit, dynamic)


def test_score_range(spark):
    rows = [sku("SKU-1", "TP-1", color="red"), sku("SKU-2", "TP-1", color="red"), sku("SKU-3", "TP-2", color="red"),
            sku("SKU-4", "TP-2", color="blue", brand=None)]
    weights = similarity.usable_weights((("color", 0.5), ("brand", 0.25)), CATALOG_FIELDS)
    sets = similarity.attribute_sets(catalog(spark, rows), weights, CATALOG_FIELDS)
    low, high = similarity.score_range(sets, similarity.weighted_tuples(sets, weights), weights).first()
    assert (low, high) == (Decimal("0"), Decimal("0.75"))


def test_buckets_against_all_pairs(spark):
    """With product-type buckets every bucket of a lookup key has its own top list."""
    rng = random.Random(7)
    rows = [
        sku(f"SKU-{rng.randrange(10**6):06d}-{n}", "TP-0" if n % 3 == 0 else f"TP-{rng.randrange(1, 9)}",
            color=rng.choice(["black", "black", "red"]), image_link=rng.choice(["same", f"own-{n}"]),
            product_type=rng.choice(["a", "a, b", "b"]))
        for n in range(60)
    ]
    cart = leaf("startswith", "product_type", "any_item_in_cart", function=True)
    stock, limit, weights = catalog(spark, rows), 3, (("color", 0.5),)
    from vitrine.functions import filters

    got = similarity.similar_skus(
        stock, stock, weights, filters.split_for_pairs(tree("and", cart), CATALOG_FIELDS),
        filters.split_for_pairs(tree("and"), CATALOG_FIELDS), CATALOG_FIELDS, limit=limit,
    )
    found = {}
    for r in got.where(f"rank <= {limit}").collect():
        found.setdefault((r.lookup_key, r.split_product_type), []).append((r["rank"], r.score, r.id))
    expected = {}
    for a in rows:
        for b in rows:
            if a["item_group_id"] == b["item_group_id"]:
                continue
            score = Decimal("0.5") if a["color"] == b["color"] else Decimal(0)
            for r in rows:
                if r["item_group_id"] == b["item_group_id"]:
                    key = (score, r["color"], r["image_link"], r["product_type"])
                    for bucket in [*r["product_type"].split(", "), ""]:
                        best = expected.setdefault((a["item_group_id"], bucket), {})
                        best[key] = max(best.get(key, ""), r["id"])
    assert {k: [(s, i) for _, s, i in sorted(v)] for k, v in found.items()} == {
        k: sorted(((key[0], i) for key, i in best.items()), reverse=True)[:limit] for k, best in expected.items()
    }


def test_lists_meet_no_more_rows_than_places(spark):
    """A group that stands in no row of its tuple meets one row a place, and only the places of a list; another meets all."""
    rows = [("t", "0.5", f"look {p}", f"g{p}{n}", f"SKU-{9 - p}{2 - n}", p, n) for p in (1, 2, 3, 4) for n in (1, 2)]
    best = spark.createDataFrame(rows, "tuple_key string, score string, color string, item_group_id string, id string, place int, nth int")
    lookups = spark.createDataFrame([("other", "t"), ("g11", "t")], "lookup_key string, tuple_key string")
    met = {(r.lookup_key, r.id) for r in similarity._met(best, lookups, 2).collect()}
    assert met == {("other", "SKU-81"), ("other", "SKU-71")} | {("g11", r[4]) for r in rows if r[3] != "g11"}


@pytest.mark.parametrize(
    "rows, expected",
    [
        # red agrees with red of the same group alone: that is no pair
        ([("g1", "red", "S"), ("g1", "red", "M"), ("g2", "blue", "L")], ("0.000000", "0.000000")),
        ([("g1", "red", "S"), ("g1", "red", "M"), ("g2", "blue", "L"), ("g3", "red", "X")], ("0.000000", "0.500000")),
        ([("g1", "red", "S"), ("g2", "red", "S"), ("g3", "red", "S")], ("0.750000", "0.750000")),
        ([("g1", "red", "S"), ("g1", "blue", "M")], (None, None)),
        ([("g1", None, "S"), ("g2", None, "S")], ("0.250000", "0.250000")),
    ],
)
def test_score_range_leaves_out_the_own_group(spark, rows, expected):
    weights = (("color", 0.5), ("size", 0.25))
    sets = spark.createDataFrame([(*r, 1) for r in rows], "item_group_id string, a0 string, a1 string, skus long")
    found = similarity.score_range(sets, similarity.weighted_tuples(sets, weights), weights).first()
    assert tuple(None if x is None else str(x) for x in (found.low, found.high)) == expected


def test_tuples_and_candidates_meet_in_many_tasks(spark, monkeypatch):
    """Few bytes on both sides, but many rows: the join is dealt out by the rows it forms, with the same lists."""
    weights = (("color", 0.5), ("product_type", 0.1))
    whole = sorted(run(spark, weights).collect())
    parts, join = [], similarity._join_by_mask

    def recorded(many, spread_by, few, names, *more):
        rows = join(many, spread_by, few, names, *more)
        if "id" in few.columns:
            parts.append(rows.rdd.getNumPartitions())
        return rows

    monkeypatch.setattr(similarity, "_join_by_mask", recorded)
    monkeypatch.setattr(similarity, "ROWS_A_TASK", 5)
    assert sorted(run(spark, weights).collect()) == whole
    assert len(parts) == 1 and parts[0] > 4  # the session's shuffles have 4
