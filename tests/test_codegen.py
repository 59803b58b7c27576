"""The other tests run without generated code, which is quicker on tiny inputs; here both ways must give the same rows."""

import pytest

from fixtures import ACCOUNT, AS_OF, CATALOG, RETAILER, leaf, pair_tables, ranking_tables, tree
from vitrine.plans import fan_out, pairings, rankings
from vitrine.plans.strategy import AccountSettings, Strategy

BASE = "items_from_base_recommendation_on"
CART = leaf("startswith", "product_type", "any_item_in_cart", function=True)


@pytest.fixture(scope="module")
def compiled(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.codegen.wholeStage", "true")
    session.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session


def _ranking(session):
    s = Strategy(1, "purchase_value", RETAILER, CATALOG, 30, tree("and", leaf("contains", "product_type", ["Pants", "Jeans"]), CART), geo_target="region", account_id=ACCOUNT)
    return rankings.recommend(s, ranking_tables(session), AS_OF)


def _list(session):
    s = Strategy(2, "bought_together", RETAILER, CATALOG, 30, tree("and", leaf("in", "color", BASE, function=True)), account_id=ACCOUNT)
    return pairings.recommend(s, pair_tables(session), AS_OF)


def _sequence(session):
    return pairings.recommend(Strategy(3, "subsequently_purchased", RETAILER, CATALOG, 30, account_id=ACCOUNT), pair_tables(session), AS_OF)


def _similar(session):
    s = Strategy(4, "similar_products_v2", RETAILER, CATALOG, account_id=ACCOUNT)
    return pairings.recommend(s, pair_tables(session), AS_OF, AccountSettings(similarity_weights=(("color", 0.5), ("product_type", None))))


def _documents(session):
    outputs = [fan_out.Output(Strategy(n, a, RETAILER, CATALOG, 30, f, account_id=ACCOUNT), ACCOUNT, unified=True) for n, (a, f) in enumerate((("purchase_also_purchase", tree("and")), ("bought_together", tree("and", leaf(">", "price", 2)))))]
    docs = fan_out.all_documents(outputs, pair_tables(session), AS_OF, AS_OF)
    return docs.selectExpr("to_json(struct(*)) AS text")


@pytest.mark.parametrize("plan", [_ranking, _list, _sequence, _similar, _documents])
def test_generated_code_gives_the_same_rows(spark, compiled, plan):
    interpreted = sorted(map(str, plan(spark).collect()))
    assert interpreted == sorted(map(str, plan(compiled).collect()))
    assert interpreted
