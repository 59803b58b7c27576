"""The logical tables derived from an order-and-event star schema.

Orders of low priority become point-of-sale lines, all others online purchase
lines; view events become product views, parts the catalog. Everything is a projection or join of the stored tables, so the work
of any plan grows with them.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.plans.strategy import Tables

ORDERS_AS_OF = datetime(2001, 8, 2)
EVENTS_AS_OF = datetime(2024, 1, 31)
RETAILER = 1
CATALOG = 100

# Data types of the catalog fields.
CATALOG_FIELDS = {
    "id": "STRING",
    "item_group_id": "STRING",
    "title": "STRING",
    "image_link": "STRING",
    "availability": "STRING",
    "price": "NUMBER",
    "product_type": "STRING",
    "brand": "STRING",
    "color": "STRING",
    "is_bundle": "BOOLEAN",
    "update_time": "DATETIME",
    "size_class": "STRING",
    "size_value": "NUMBER",
    "grade": "STRING",
}


class StarSchema:
    """Reads <folder>/<table>.parquet and exposes the logical tables lazily."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._stored: dict[str, DataFrame] = {}

    def read(self, table: str) -> DataFrame:
        """A stored table; its footer is read once per instance."""
        if table not in self._stored:
            self._stored[table] = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        return self._stored[table]

    def _customers(self) -> DataFrame:
        return self.read("customer").selectExpr(
            "c_custkey AS device", "CAST(c_nationkey % 5 AS BIGINT) AS account_id", "c_nationkey"
        )

    def _orders(self, point_of_sale: bool) -> DataFrame:
        """Orders with the account of their customer; joined before their lines, which are many times as many."""
        in_store = "o_orderpriority = '5-LOW'"
        orders = self.read("orders").where(in_store if point_of_sale else f"NOT {in_store}").selectExpr(
            "o_orderkey", "o_custkey AS device", "CAST(o_orderdate AS TIMESTAMP) AS fact_time"
        )
        return orders.join(self._customers(), "device").select("o_orderkey", "device", "fact_time", "account_id")

    def _lines(self, point_of_sale: bool) -> DataFrame:
        lines = self.read("lineitem").selectExpr(
            "l_orderkey AS o_orderkey",
            "l_linenumber",
            "concat('TP-', l_partkey DIV 4) AS product_id",
            "CAST(l_quantity AS BIGINT) AS quantity",
            "CAST(l_extendedprice AS DECIMAL(18,2)) AS currency_unit_price",
            "CASE l_suppkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency",
        )
        return lines.join(self._orders(point_of_sale), "o_orderkey")

    def purchase_lines(self) -> DataFrame:
        return self._lines(False).selectExpr(
            "account_id",
            "fact_time",
            "0L AS mid_epoch",
            "device AS mid_ts",
            "0L AS mid_rnd",
            "CAST(o_orderkey AS STRING) AS purchase_id",
            "l_linenumber AS line",
            "product_id",
            "quantity",
            "currency",
            "currency_unit_price",
        )

    def pos_lines(self) -> DataFrame:
        return self._lines(True).selectExpr(
            f"{RETAILER}L AS retailer_id",
            "account_id AS dataset_id",
            "CAST(device AS STRING) AS customer_id",
            "fact_time AS time",
            "product_id",
            "quantity",
            "currency",
            "currency_unit_price",
            "CAST(date_add(DATE '1995-01-01', CAST(o_orderkey % 100 AS INT)) AS TIMESTAMP) AS update_time",
        )

    def product_views(self) -> DataFrame:
        viewed = self.read("events").where("event_type = 'view'").selectExpr(
            "user_id AS device",
            "CAST(ts AS TIMESTAMP) AS fact_time",
            "CASE WHEN event_id % 97 = 0 THEN 'null' WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN '' "
            "ELSE concat('TP-', get_json_object(props, '$.k')) END AS product_id",
        )
        return viewed.join(self._customers(), "device").selectExpr(
            "CAST(fact_time AS DATE) AS fact_date",
            "account_id",
            "fact_time",
            "0L AS mid_epoch",
            "device AS mid_ts",
            "0L AS mid_rnd",
            "product_id",
        )

    def _sessions(self, facts: DataFrame) -> DataFrame:
        """One session per account, device and day, placed by the customer's nation and region."""
        nations = self.read("nation").join(self.read("region"), F.expr("n_regionkey = r_regionkey"))
        places = self._customers().join(nations, F.expr("c_nationkey = n_nationkey")).selectExpr(
            "device", "n_name AS country_code", "r_name AS region"
        )
        days = facts.groupBy("account_id", "mid_ts", F.expr("CAST(fact_time AS DATE) AS start_date")).agg(
            F.expr("min(fact_time) AS start_time"), F.expr("max(fact_time) AS end_time")
        )
        return days.join(places, F.expr("mid_ts = device")).selectExpr(
            "start_date",
            "account_id",
            "start_time",
            "end_time",
            "0L AS mid_epoch",
            "0L AS mid_rnd",
            "mid_ts",
            "country_code",
            "region",
        )

    def purchase_sessions(self) -> DataFrame:
        """An order has one time, so one row of each that has lines will do."""
        lines = self.read("lineitem").selectExpr("l_orderkey AS o_orderkey")
        orders = self._orders(False).join(lines, "o_orderkey", "left_semi")
        return self._sessions(orders.withColumnRenamed("device", "mid_ts"))

    def view_sessions(self) -> DataFrame:
        return self._sessions(self.product_views())

    def catalog(self) -> DataFrame:
        return self.read("part").selectExpr(
            f"{RETAILER}L AS retailer_id",
            f"{CATALOG}L AS dataset_id",
            "concat('SKU-', lpad(CAST(p_partkey AS STRING), 8, '0')) AS id",
            "concat('TP-', p_partkey DIV 4) AS item_group_id",
            "p_name AS title",
            "concat('img/', replace(p_name, ' ', '-')) AS image_link",
            "CAST(p_retailprice AS DECIMAL(18,4)) AS price",
            "concat(p_type, ' > ', split_part(p_name, ' ', 2), ', ', split_part(p_name, ' ', 1)) AS product_type",
            "p_brand AS brand",
            "split_part(p_name, ' ', 1) AS color",
            "p_size % 2 = 0 AS is_bundle",
            "CASE WHEN p_size % 10 = 0 THEN 'Out of Stock' ELSE 'in stock' END AS availability",
            "CAST(date_sub(DATE '2001-08-01', CAST(p_size % 7 AS INT)) AS TIMESTAMP) AS update_time",
            "to_json(named_struct('size_class', concat('class ', p_size % 5), 'size_value', p_size, "
            "'grade', IF(p_size % 7 = 0, NULL, concat('grade ', p_size % 3)))) AS custom",
        )

    def expiration(self) -> DataFrame:
        """Cutoffs: five days for the catalog; point-of-sale deliveries of the first ten days are out of date."""
        pos = self.accounts().selectExpr("account_id AS dataset_id", "TIMESTAMP '1995-01-11' AS cutoff_time")
        catalog = self.read("region").where("r_regionkey = 0").selectExpr(
            f"{CATALOG}L AS dataset_id", "TIMESTAMP '2001-07-27' AS cutoff_time"
        )
        return pos.unionByName(catalog)

    def accounts(self) -> DataFrame:
        """Nation keys modulo five: five accounts, alternating between two currencies."""
        return self.read("nation").selectExpr(
            "CAST(n_nationkey % 5 AS BIGINT) AS account_id",
            f"{RETAILER}L AS retailer_id",
            "CASE WHEN n_nationkey % 5 % 2 = 0 THEN 'USD' ELSE 'EUR' END AS currency",
            "0 AS archived",
        ).distinct()

    def market_accounts(self) -> DataFrame:
        """Market 7 joins the accounts 1 and 3."""
        return self.accounts().where("account_id IN (1, 3)").selectExpr("7L AS market_id", "account_id")

    def features(self) -> DataFrame:
        """Accounts 1 to 4 get documents; of these, the even ones get the unified feed, too."""
        live = self.accounts().where("account_id >= 1")
        return live.selectExpr("account_id", "'recommendations' AS feature").unionByName(
            live.where("account_id % 2 = 0").selectExpr("account_id", "'unified_feed' AS feature")
        )

    def settings(self) -> DataFrame:
        return self.accounts().selectExpr("account_id", "account_id AS pos_dataset_id")

    def exchange_rates(self) -> DataFrame:
        """A rate for each order day and currency pair; 29 February has none."""
        days = self.read("orders").selectExpr("CAST(o_orderdate AS DATE) AS effective_date").distinct()
        pairs = ", ".join(
            f"named_struct('source', '{a}', 'target', '{b}', 'step', {n})"
            for n, (a, b) in enumerate((a, b) for a in ("USD", "EUR", "GBP") for b in ("USD", "EUR"))
        )
        dated = days.where("NOT (month(effective_date) = 2 AND day(effective_date) = 29)").selectExpr(
            "effective_date", f"explode(array({pairs})) AS pair"
        )
        return dated.selectExpr(
            "pair.source AS from_currency_code",
            "pair.target AS to_currency_code",
            "effective_date",
            "CAST(CASE WHEN pair.source = pair.target THEN 1.000 "
            "ELSE CAST(900 + pair.step * 100 + day(effective_date) AS DECIMAL(10,0)) * 0.001 END AS DECIMAL(18,6)) AS rate",
        )

    # ---- experience configuration, for the question which strategies are in use

    def strategies(self) -> DataFrame:
        return self.read("part").selectExpr(
            "p_partkey AS id",
            "p_size = 50 AS is_component",
            "CAST(date_add(DATE '2001-06-01', p_size) AS TIMESTAMP) AS updated",
        )

    def action_inputs(self) -> DataFrame:
        """Order lines as the leaves of nested sets, the order itself as their parent node."""
        parents = self.read("orders").selectExpr(
            "o_orderkey AS action_id",
            "IF(o_orderstatus = 'P', 0, 1) AS lft",
            "1000 AS rgt",
            "CAST(NULL AS BIGINT) AS int_value",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'rec_set_ids' WHEN '2-HIGH' THEN 'fallback_rec_set_ids' "
            "ELSE 'templated_recommendation' END AS name",
        )
        leaves = self.read("lineitem").selectExpr(
            "l_orderkey AS action_id",
            "l_linenumber * 2 AS lft",
            "l_linenumber * 2 + 1 AS rgt",
            "l_partkey AS int_value",
            "CASE l_returnflag WHEN 'A' THEN 'recset_id' WHEN 'R' THEN 'strategy_id' ELSE 'item' END AS name",
        )
        return parents.unionByName(leaves)

    def actions(self) -> DataFrame:
        return self.read("orders").selectExpr("o_orderkey AS id", "o_orderkey AS where_id")

    def placements(self) -> DataFrame:
        return self.read("orders").selectExpr("o_orderkey AS id", "o_custkey AS campaign_id")

    def campaigns(self) -> DataFrame:
        return self.read("customer").selectExpr("c_custkey AS id", "CAST(c_nationkey AS BIGINT) AS campaign_group_id")

    def campaign_groups(self) -> DataFrame:
        return self.read("nation").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS id",
            "CAST(n_regionkey = 0 AS INT) AS archived",
            "CAST(date_add(DATE '2001-05-01', n_nationkey * 3) AS TIMESTAMP) AS last_modified_time",
            "CAST(n_regionkey = 1 AS INT) AS active",
            "IF(n_nationkey = 6, NULL, TIMESTAMP '2000-01-01') AS end_time",
            "IF(n_nationkey = 12, 'email_exp', 'page') AS campaign_type",
        )

    def tables(self, views: bool = False) -> Tables:
        """Everything a plan needs; sessions follow the views or the purchases."""
        return _StarTables(self, views)


class _StarTables(Tables):
    """Tables that are put together on first use, so a plan pays only for those it reads."""

    def __init__(self, star: StarSchema, views: bool) -> None:
        object.__setattr__(self, "_star", star)
        object.__setattr__(self, "_views", views)

    catalog = cached_property(lambda self: self._star.catalog())
    expiration = cached_property(lambda self: self._star.expiration())
    accounts = cached_property(lambda self: self._star.accounts())
    product_views = cached_property(lambda self: self._star.product_views())
    purchase_lines = cached_property(lambda self: self._star.purchase_lines())
    sessions = cached_property(
        lambda self: self._star.view_sessions() if self._views else self._star.purchase_sessions()
    )
    pos_lines = cached_property(lambda self: self._star.pos_lines())
    exchange_rates = cached_property(lambda self: self._star.exchange_rates())
    settings = cached_property(lambda self: self._star.settings())
    market_accounts = cached_property(lambda self: self._star.market_accounts())
    catalog_fields = CATALOG_FIELDS
