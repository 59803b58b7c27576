"""Small hand-made tables: six SKUs, five sessions, three devices, three customers."""

import json
from datetime import datetime, timedelta
from decimal import Decimal

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_type

from vitrine.plans.strategy import Tables
from vitrine.schemas import schema_of

AS_OF = datetime(2024, 3, 15, 12, 0, 0)
RETAILER, CATALOG, ACCOUNT, POS_ACCOUNT, POS_DATASET = 9, 50, 41, 1, 2
D1, D5, D6, D29, D40 = (AS_OF - timedelta(days=n) for n in (1, 5, 6, 29, 40))

CATALOG_FIELDS = {
    "id": "STRING", "title": "STRING", "description": "STRING", "link": "STRING", "image_link": "STRING",
    "availability": "STRING", "availability_date": "DATETIME", "price": "NUMBER", "product_type": "STRING",
    "brand": "STRING", "adult": "BOOLEAN", "is_bundle": "BOOLEAN", "color": "STRING",
    "product_category": "STRING",
}

_SKUS = [
    ("SKU-00001", "TP-00001", "1.99", "Clothing > Shirt", "ab", False, "black", "Daily Wear"),
    ("SKU-00002", "TP-00002", "2.99", "Clothing > Pants, test", "bc", True, "black", "Daily Wear"),
    ("SKU-00003", "TP-00003", "3.99", "Clothing > Pants", "cd", True, "red", "Daily Wear"),
    ("SKU-00004", "TP-00004", "4.99", "test ,    Clothing > Jeans", "de", False, "red", "Daily Wear"),
    ("SKU-00005", "TP-00005", "5.99", "Clothing > Jeans", "ef", False, "blue", "Daily_Wear"),
    ("SKU-00006", "TP-00005", "6.99", "test,Clothing > Jeans", "fg", True, "white", "Daily_Wear"),
]


def frame(spark, table, rows):
    """A table from dicts; by way of Arrow, so that Spark holds it as a local relation."""
    schema = schema_of(table)
    if not rows:
        return spark.createDataFrame([], schema)
    columns = {f.name: pa.array([r.get(f.name) for r in rows], to_arrow_type(f.dataType)) for f in schema}
    return spark.createDataFrame(pa.table(columns), schema)


def sku(id, group, price="1.00", product_type="x", brand="b", is_bundle=False, color="red", category="c", **more):
    row = dict(
        retailer_id=RETAILER, dataset_id=CATALOG, id=id, description="test", image_link=f"http://img/{id}.jpg",
        item_group_id=group, link="http://shop", price=Decimal(price), product_type=product_type, title=id,
        update_time=AS_OF - timedelta(seconds=1), brand=brand, is_bundle=is_bundle, color=color,
        availability="In Stock", custom=json.dumps({"product_category": category}),
    )
    return row | more


def catalog(spark, rows=None):
    return frame(spark, "catalog", rows if rows is not None else [sku(*r) for r in _SKUS])


def _session(n, country, region, when):
    start = when - timedelta(hours=1)
    return dict(
        start_date=start.date(), account_id=ACCOUNT, start_time=start, end_time=start + timedelta(hours=2),
        mid_epoch=0, mid_ts=n, mid_rnd=n, country_code=country, region=region,
    )


# device number, country, region, time
_PLACES = {"PA": (1, "US", "PA", D6), "NJ": (2, "US", "NJ", D6), "ON": (3, "CA", "ON", D6),
           "ON29": (4, "CA", "ON", D29), "ON40": (5, "CA", "ON", D40), "PA29": (6, "US", "PA", D29)}


def sessions(spark):
    return frame(spark, "sessions", [_session(*p) for p in _PLACES.values()])


def _line(place, product, quantity, price):
    n, _, _, when = _PLACES[place]
    return dict(
        account_id=ACCOUNT, fact_time=when, mid_epoch=0, mid_ts=n, mid_rnd=n, purchase_id="po", line=1,
        product_id=f"TP-0000{product}", sku="x", quantity=quantity, currency="USD",
        currency_unit_price=Decimal(price), usd_unit_price=Decimal(price), usd_unit_cost=Decimal(price),
    )


_LINES = [("PA", 5, 3, "2"), ("PA", 2, 3, "3"), ("NJ", 5, 2, "2"), ("ON", 5, 1, "2"), ("ON", 2, 2, "3"),
          ("ON", 3, 3, "3"), ("ON29", 5, 3, "2"), ("ON29", 4, 1, "4"), ("ON40", 1, 50, "2"), ("ON40", 4, 50, "4")]
_TREND_LINES = [("PA", 5, 3, "2"), ("PA", 2, 3, "3"), ("PA", 4, 5, "4"), ("NJ", 5, 2, "2"), ("ON", 5, 7, "2"),
                ("ON", 2, 2, "3"), ("ON", 3, 3, "3"), ("ON29", 5, 3, "2"), ("ON29", 4, 1, "4"),
                ("PA29", 4, 10, "4"), ("ON40", 1, 50, "2"), ("ON40", 4, 50, "4")]


def purchase_lines(spark, trend=False):
    return frame(spark, "purchase_lines", [_line(*r) for r in (_TREND_LINES if trend else _LINES)])


_VIEWS = [("PA", 5, 2), ("PA", 2, 5), ("NJ", 5, 2), ("ON", 5, 1), ("ON", 2, 2), ("ON", 3, 3), ("ON29", 3, 3),
          ("ON29", 4, 2), ("ON29", 2, 2), ("ON40", 5, 5), ("ON40", 1, 5)]


def product_views(spark):
    rows = []
    for place, product, times in _VIEWS:
        n, _, _, when = _PLACES[place]
        rows += [dict(fact_date=when.date(), account_id=ACCOUNT, fact_time=when, mid_epoch=0, mid_ts=n, mid_rnd=n,
                      product_id=f"TP-0000{product}", qty_in_stock=8)] * times
    return frame(spark, "product_views", rows)


def _pos(dataset, customer, when, product):
    return dict(retailer_id=RETAILER, dataset_id=dataset, customer_id=customer, time=when, purchase_id="p", line=1,
                product_id=f"TP-0000{product}", sku="x", currency="USD", currency_unit_price=Decimal(3), quantity=1,
                store_id=2, update_time=when)


_POS = [("customer0", D6, "1234"), ("customer0", D29, "1234"), ("customer1", D6, "23"), ("customer1", D29, "1234"),
        ("customer2", D6, "45"), ("customer2", D29, "1234")]


def pos_lines(spark):
    return frame(spark, "pos_lines", [_pos(ACCOUNT, c, t, p) for c, t, ps in _POS for p in ps])


def accounts(spark):
    base = dict(name="n", instance="p", domain="d", timezone="EST", currency="USD", archived=0, retailer_id=RETAILER,
                retailer_name="r")
    return frame(spark, "accounts", [base | {"account_id": a} for a in (ACCOUNT, POS_ACCOUNT)])


def expiration(spark):
    cutoff = AS_OF - timedelta(days=365)
    return frame(spark, "expiration", [dict(id=n, dataset_id=d, cutoff_time=cutoff, availability_time=AS_OF)
                                       for n, d in enumerate((CATALOG, ACCOUNT, POS_DATASET))])


def exchange_rates(spark):
    return frame(spark, "exchange_rates", [dict(from_currency_code="USD", to_currency_code="USD",
                                                effective_date=d.date(), rate=Decimal(1)) for d in (D6, D29, D40)])


def market_accounts(spark):
    return spark.createDataFrame([(7, ACCOUNT), (7, POS_ACCOUNT)], "market_id bigint, account_id bigint")


def ranking_tables(spark, trend=False, **changes):
    parts = dict(
        catalog=catalog(spark), expiration=expiration(spark), accounts=accounts(spark),
        product_views=product_views(spark), purchase_lines=purchase_lines(spark, trend), sessions=sessions(spark),
        pos_lines=pos_lines(spark), exchange_rates=exchange_rates(spark),
        settings=spark.createDataFrame([(ACCOUNT, ACCOUNT)], "account_id bigint, pos_dataset_id bigint"),
        market_accounts=market_accounts(spark), catalog_fields=CATALOG_FIELDS,
    )
    return Tables(**(parts | changes))


# ---- item-to-item facts: device number, time, products

_MID_VIEWS = [(0, D5, "345"), (0, D29, "12345"), (1, D5, "23"), (1, D29, "12"), (2, D5, "45"), (2, D29, "123")]
_MID_LINES = [(0, D5, "1234"), (0, D29, "1234"), (1, D5, "23"), (1, D29, "1234"), (2, D5, "45"), (2, D29, "1234")]
T1, T2, T3, T4, T5 = (D1 + timedelta(minutes=m) for m in (50, 10, 5, 20, 25))
_LATE_LINES = [(T1, 1), (T2, 4), (T3, 5), (T4, 1), (T5, 2)]
_CUSTOMERS = [("customer0", D5, "1234"), ("customer0", D29, "1234"), ("customer1", D5, "23"),
              ("customer1", D29, "1234"), ("customer2", D5, "45"), ("customer2", D29, "1234")]
_LATE_CUSTOMER = [(T1, 1), (T2, 2), (T3, 3), (T4, 4)]


def pair_tables(spark, **changes):
    def device(n, when, product):
        return dict(account_id=ACCOUNT, fact_time=when, mid_epoch=0, mid_ts=n, mid_rnd=n, fact_date=when.date(),
                    product_id=f"TP-0000{product}", quantity=1, currency="USD", currency_unit_price=Decimal(3))

    views = [device(n, t, p) for n, t, ps in _MID_VIEWS for p in ps]
    lines = [device(n, t, p) for n, t, ps in _MID_LINES for p in ps] + [device(2, t, p) for t, p in _LATE_LINES]
    pos = [_pos(POS_DATASET, c, t, p) for c, t, ps in _CUSTOMERS for p in ps]
    pos += [_pos(POS_DATASET, "customer2", t, p) for t, p in _LATE_CUSTOMER]
    parts = dict(
        catalog=catalog(spark), expiration=expiration(spark), accounts=accounts(spark),
        product_views=frame(spark, "product_views", views), purchase_lines=frame(spark, "purchase_lines", lines),
        pos_lines=frame(spark, "pos_lines", pos),
        settings=spark.createDataFrame([(POS_ACCOUNT, POS_DATASET)], "account_id bigint, pos_dataset_id bigint"),
        market_accounts=market_accounts(spark), catalog_fields=CATALOG_FIELDS,
    )
    return Tables(**(parts | changes))


def leaf(op, field, value, function=False):
    return {"type": op, "left": {"type": "field", "field": field},
            "right": {"type": "function" if function else "value", "value": value}}


def tree(kind, *leaves):
    return json.dumps({"type": kind, "filters": list(leaves)})
