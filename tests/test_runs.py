"""Selecting the outputs of a run, item lists with a best-seller, and limits of similarity."""

import random
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fixtures import ACCOUNT, CATALOG, RETAILER
from vitrine.functions import filters
from vitrine.operators import collab, neighbours, numbers, pairs, ranking, similarity
from vitrine.plans import fan_out
from vitrine.plans.strategy import AccountSettings, Strategy
from vitrine.storage import materialise

SENT = datetime(2024, 3, 15, 12, 34, 56)


def test_selection_of_outputs(spark):
    accounts = spark.createDataFrame([(1, 9, 0), (2, 9, 0), (3, 9, 1), (4, 8, 0)], "account_id bigint, retailer_id bigint, archived int")
    features = spark.createDataFrame(
        [(1, fan_out.DOCUMENTS), (2, fan_out.DOCUMENTS), (3, fan_out.DOCUMENTS), (4, fan_out.DOCUMENTS), (2, fan_out.UNIFIED)],
        "account_id bigint, feature string",
    )
    strategies = [
        Strategy(1, "view", 9, 5, whole_retailer=True), Strategy(2, "purchase", 9, None, whole_retailer=True),
        Strategy(3, "view", 8, 5, account_id=4), Strategy(4, "view", 9, 5, account_id=1),
    ]
    active = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    chosen = fan_out.select(strategies, accounts, features, active, {1: AccountSettings(minimum_purchases=3)}, {2: 77})
    assert [(o.strategy.id, o.account_id, o.strategy.catalog_id, o.unified, o.settings.minimum_purchases) for o in chosen] == [
        (1, 1, 5, False, 3), (1, 2, 5, True, 1), (2, 2, 77, True, 1), (3, 4, 5, False, 1),
    ]


def test_views_and_most_popular_share_their_start():
    keys = [fan_out.shared_key(fan_out.Output(Strategy(n, a, RETAILER, CATALOG), ACCOUNT)) for n, a in enumerate(("view", "most_popular"))]
    assert keys[0] == keys[1]


NONE = '{"type": "and", "filters": []}'
SAME_GRADE = '{"type": "and", "filters": [{"type": "in", "left": {"type": "field", "field": "grade"}, "right": {"type": "function", "value": "items_from_base_recommendation_on"}}]}'


@pytest.mark.parametrize("bucketed", [False, True])
@pytest.mark.parametrize("dynamic", [False, True])
def test_lists_cut_early_equal_lists_cut_late(spark, monkeypatch, bucketed, dynamic):
    """One best-seller stands in every list; many scores tie; products share looks; two accounts count the same pairs."""
    draw = random.Random(4)
    catalog = spark.createDataFrame(
        [
            (f"S{n:04}", f"P{n % 90}", draw.choice(["red", None]), draw.choice([f"i{n % 50}", f"j{n}", None]), draw.choice(["a,b", "a", "b,c", None]), draw.choice(['{"grade": "x"}', '{"grade": "y"}', "{}"]))
            for n in range(600)
        ],
        "id string, item_group_id string, color string, image_link string, product_type string, custom string",
    )
    pairs_ = spark.createDataFrame([(a, f"P{k}", f"P{p}", draw.randrange(4)) for a in (1, 2) for k in range(12) for p in [0, *draw.sample(range(1, 90), 45)]], "account_id bigint, lookup_key string, product_id string, score bigint")
    fields = {"grade": "STRING"}
    own = replace(filters.split_for_pairs(SAME_GRADE if dynamic else NONE, fields), bucketed=bucketed)
    shared = filters.split_for_pairs(filters.no_filter(), fields)
    monkeypatch.setattr(collab, "FIRST_LOOK", 1)  # some lists are full after the first look, others not
    early = collab.explode_pairs(pairs_, catalog, own, shared, fields, limit=7)
    got = sorted(map(tuple, early.collect()))
    monkeypatch.setattr(collab, "within_reach", lambda rows, *_: rows.drop("lane"))
    monkeypatch.setattr(collab, "_passing_from_the_top", lambda rows, sets, passing, *_: passing(rows.join(sets, ["product_id", "share"])))
    assert got == sorted(map(tuple, collab.explode_pairs(pairs_, catalog, own, shared, fields, limit=7).collect()))
    assert len(got) > 60


def test_pairs_of_baskets_of_all_sizes(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BASKET_ROWS", 5)
    rows = [(1, 0, d, 0, f"p{(d * 7 + n) % 23}", datetime(2024, 1, 1 + n % 20)) for d in range(9) for n in range(d * 3)]
    last = pairs.last_purchases(spark.createDataFrame(rows, "account_id bigint, mid_epoch bigint, mid_ts bigint, mid_rnd bigint, product_id string, fact_time timestamp"))
    baskets = last.collect()
    for form, fits in ((pairs.together, lambda a, b: a.product_id != b.product_id), (pairs.in_sequence, lambda a, b: a.product_id != b.product_id and a.fact_time < b.fact_time)):
        truth = {}
        for a in baskets:
            for b in baskets:
                if a.mid_ts == b.mid_ts and fits(a, b):
                    truth[a.product_id, b.product_id] = truth.get((a.product_id, b.product_id), 0) + 1
        assert {(r.pid1, r.pid2): r.score for r in form(last, pairs.DEVICE).collect()} == truth


def test_hot_products_are_dealt_out_and_sources_counted_at_once(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BASKET_ROWS", 6)
    monkeypatch.setattr(pairs, "HOT_ROWS", 2)
    monkeypatch.setattr(pairs, "PAIRS_A_TASK", 20)
    rows = [(1, 0, d, 0, f"p{(d * 5 + n) % 11 * (n % 3 > 0)}", datetime(2024, 1, 1 + n % 20)) for d in range(9) for n in range(d)]
    last = pairs.last_purchases(spark.createDataFrame(rows, "account_id bigint, mid_epoch bigint, mid_ts bigint, mid_rnd bigint, product_id string, fact_time timestamp"))
    sold = [(7, f"c{c}", 1, f"p{(c + n) % 5}", datetime(2024, 1, 1 + n)) for c in range(4) for n in range(c + 2)]
    sold += sold[:7]
    pos = spark.createDataFrame(sold, "dataset_id bigint, customer_id string, account_id bigint, product_id string, fact_time timestamp")
    truth = []
    for found in ([((r.mid_ts,), r.product_id, r.fact_time) for r in last.collect()], [((d, c), p, t) for d, c, _, p, t in sold]):
        n = {}
        for x, a, s in found:
            for y, b, t in found:
                if x == y and a != b and s < t:
                    n[a, b] = n.get((a, b), 0) + 1
        truth.append(n)
    both = set(truth[0]) | set(truth[1])
    for by, score in (("sum", lambda k: sum(n.get(k, 0) for n in truth)), ("source_count", lambda k: sum(k in n for n in truth))):
        assert {(r.pid1, r.pid2): r.score for r in pairs.in_sequence_of_both(last, pos, by).collect()} == {k: score(k) for k in both}
    rows, most = pairs._folded(last, pairs.DEVICE, False)
    lists = pairs._partner_lists(pairs._with_shares([rows])[0], pairs.DEVICE, False)
    assert lists.agg({"share": "max"}).first()[0] > 0 and most >= lists.selectExpr("sum(size(pids))").first()[0]


@pytest.mark.parametrize("timed", [False, True])
@pytest.mark.parametrize("kind", ["plain", "split", "threshold"])
def test_lists_straight_from_baskets(spark, monkeypatch, timed, kind):
    """Lists and range of scores are those of all pairs, of which no table is written; keys go through in rounds."""
    draw = random.Random(7)
    key = "account_id bigint, mid_epoch bigint, mid_ts bigint, mid_rnd bigint, product_id string, fact_time timestamp"
    lines = [(1 + d % 2, 0, d, 0, f"P{min(draw.randrange(40), draw.randrange(40))}", datetime(2024, 1, 1 + draw.randrange(5))) for d in range(24) for _ in range(d % 9)]
    online = pairs.last_purchases(spark.createDataFrame(lines, key))
    sold = [(7, f"c{c}", 1 + (kind == "split") * (n % 2), f"P{draw.randrange(12)}", datetime(2024, 1, 1 + n)) for c in range(9) for n in range(c)]
    pos = spark.createDataFrame(sold + sold[:9], "dataset_id bigint, customer_id string, account_id bigint, product_id string, fact_time timestamp")
    catalog = spark.createDataFrame(
        [(f"S{n:03}", f"P{n % 35}", f"c{n % 3}", f"i{n % 5}", "a", ['{"grade": "x"}', '{"grade": "y"}', "{}"][n % 7 % 3], n % 4 > 0) for n in range(90)],
        "id string, item_group_id string, color string, image_link string, product_type string, custom string, is_bundle boolean",
    )
    fields = {"grade": "STRING", "is_bundle": "BOOLEAN"}
    own = filters.split_for_pairs(SAME_GRADE if kind == "plain" else NONE, fields)
    shared = filters.split_for_pairs('{"type": "and", "filters": [{"type": "==", "left": {"type": "field", "field": "is_bundle"}, "right": {"type": "value", "value": true}}]}', fields)
    least = 2 if kind == "threshold" else 1
    both = pairs.in_sequence_of_both(online, pos, "sum", least) if timed else pairs.mirrored(pairs.unordered_of_both(online, pos, least))
    truth = collab.explode_pairs(pairs.as_lookup(both), catalog, own, shared, fields, limit=5)
    monkeypatch.setattr(neighbours, "ROUND_PAIRS", 300)
    monkeypatch.setattr(collab, "FIRST_LOOK", 1)
    if kind == "split":
        monkeypatch.setattr(pairs, "BASKET_ROWS", 6)
        monkeypatch.setattr(pairs, "HOT_ROWS", 5)
    written = []
    for module in (collab, neighbours, numbers):
        monkeypatch.setattr(module, "materialise", lambda df, name: written.append(name) or materialise(df, name))
    lists, ends = collab.lists_of_baskets([(online, pairs.DEVICE), (pos, pairs.CUSTOMER)], timed, catalog, own, shared, fields, least, limit=5)
    assert sorted(lists.select("lookup_key", "id", "rank", "score").collect()) == sorted(truth.select("lookup_key", "id", "rank", "score").collect())
    assert truth.count() > 20
    assert tuple(ends.first()) == tuple(both.agg(F.min("score"), F.max("score")).first())
    assert written.count("first-look") > 1 and not {"pairs", "known-pairs"} & set(written)


@pytest.mark.parametrize("form", ["together", "in_sequence"])
def test_pairs_and_feeds_in_rounds(spark, monkeypatch, form):
    """Lists of products are shuffled for some products after others; rows are as those of one round."""
    rows = [(1 + d % 2, 0, d, 0, f"p{(d * 5 + n) % 13}", datetime(2024, 1, 1 + n)) for d in range(9) for n in range(d)]
    last = pairs.last_purchases(spark.createDataFrame(rows, "account_id bigint, mid_epoch bigint, mid_ts bigint, mid_rnd bigint, product_id string, fact_time timestamp"))
    whole = getattr(pairs, form)(last, pairs.DEVICE)
    feed = ranking.pair_ordinals(pairs.as_lookup(whole), limit=2)
    monkeypatch.setattr(pairs, "ROUND_PAIRS", 20)
    monkeypatch.setattr(ranking, "ROUND_ROWS", 40)
    turns = getattr(pairs, form)(last, pairs.DEVICE)
    folders = lambda df: {file.rpartition("/")[0] for file in df.inputFiles()}
    assert sorted(turns.collect()) == sorted(whole.collect()) and len(folders(turns)) > 2
    short = ranking.pair_ordinals(pairs.as_lookup(turns), limit=2)
    assert sorted(short.collect()) == sorted(feed.collect()) and len(folders(short)) > 1


def test_too_many_similarity_attributes_are_refused():
    fields = {f"f{n}": "STRING" for n in range(6)}
    with pytest.raises(ValueError, match="4 attributes at most"):
        similarity.usable_weights(tuple((f, 1.0) for f in fields), fields)
