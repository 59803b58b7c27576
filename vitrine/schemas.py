"""Schemas of the logical tables the plans read."""

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    return T._parse_datatype_string(spec)  # needs an active SparkSession


# Column names and types of the input tables.
DDL = {
    "product_views": (
        "fact_date date, account_id bigint, fact_time timestamp, mid_epoch bigint, "
        "mid_ts bigint, mid_rnd bigint, product_id string, qty_in_stock int"
    ),
    "purchase_lines": (
        "account_id bigint, fact_time timestamp, mid_epoch bigint, mid_ts bigint, mid_rnd bigint, "
        "purchase_id string, line int, product_id string, sku string, quantity int, currency string, "
        "currency_unit_price decimal(18,4), usd_unit_price decimal(18,4), usd_unit_cost decimal(18,4)"
    ),
    "sessions": (
        "start_date date, account_id bigint, start_time timestamp, end_time timestamp, mid_epoch bigint, "
        "mid_rnd bigint, mid_ts bigint, country_code string, region string"
    ),
    "pos_lines": (
        "retailer_id bigint, dataset_id bigint, customer_id string, time timestamp, purchase_id string, "
        "line int, product_id string, sku string, currency string, currency_unit_price decimal(18,4), "
        "quantity int, store_id int, update_time timestamp"
    ),
    "catalog": (
        "retailer_id bigint, dataset_id bigint, id string, description string, image_link string, "
        "item_group_id string, link string, price decimal(18,4), product_type string, title string, "
        "update_time timestamp, brand string, is_bundle boolean, color string, availability string, "
        "custom string"
    ),
    "expiration": "id bigint, dataset_id bigint, cutoff_time timestamp, availability_time timestamp",
    "accounts": (
        "account_id bigint, name string, instance string, domain string, timezone string, currency string, "
        "archived int, session_cutover_time timestamp, retailer_id bigint, retailer_name string"
    ),
    "exchange_rates": (
        "from_currency_code string, to_currency_code string, effective_date date, rate decimal(18,6)"
    ),
}


def schema_of(table: str) -> T.StructType:
    """StructType of a logical table (a SparkSession must be active)."""
    return _struct(DDL[table])
