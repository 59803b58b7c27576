"""Equivalent SQL of the registered queries, for an independent engine.

Scores are worked in whole numbers here: a ratio in millionths, a score in
hundredths, both rounded as the plans round them.
"""

from __future__ import annotations

import zlib

TABLES = """
customers AS (
  SELECT c_custkey AS device, CAST(c_nationkey % 5 AS BIGINT) AS account_id, c_nationkey FROM customer),
lines AS (
  SELECT account_id, device, o_orderdate AS fact_time, o_orderpriority = '5-LOW' AS in_store,
         'TP-' || (l_partkey // 4) AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CASE l_suppkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency, l_orderkey % 100 >= 10 AS delivered_late
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customers ON o_custkey = device),
online AS (SELECT * FROM lines WHERE NOT in_store),
views AS (
  SELECT account_id, device, ts AS fact_time, CASE WHEN event_id % 97 = 0 THEN 'null' WHEN event_id % 89 = 0 THEN NULL
         WHEN event_id % 83 = 0 THEN '' ELSE 'TP-' || json_extract_string(props, '$.k') END AS product_id
  FROM events JOIN customers ON user_id = device WHERE event_type = 'view'),
places AS (
  SELECT device, n_name AS country_code, r_name AS region
  FROM customers JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
online_sessions AS (
  SELECT d.*, country_code, region FROM (
    SELECT account_id, device, min(fact_time) AS start_time, max(fact_time) AS end_time
    FROM online GROUP BY account_id, device, CAST(fact_time AS DATE)) d JOIN places USING (device)),
view_sessions AS (
  SELECT d.*, country_code, region FROM (
    SELECT account_id, device, min(fact_time) AS start_time, max(fact_time) AS end_time
    FROM views GROUP BY account_id, device, CAST(fact_time AS DATE)) d JOIN places USING (device)),
catalog AS (
  SELECT 'SKU-' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS id, 'TP-' || (p_partkey // 4) AS item_group_id,
         p_name AS title, 'img/' || replace(p_name, ' ', '-') AS image_link,
         CAST(p_retailprice AS DECIMAL(18,4)) AS price,
         p_type || ' > ' || split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1) AS product_type,
         p_brand AS brand, split_part(p_name, ' ', 1) AS color, p_size % 2 = 0 AS is_bundle,
         CASE WHEN p_size % 10 = 0 THEN 'Out of Stock' ELSE 'in stock' END AS availability,
         DATE '2001-08-01' - CAST(p_size % 7 AS INTEGER) AS update_time,
         'class ' || (p_size % 5) AS size_class, CAST(p_size AS DOUBLE) AS size_value,
         CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'grade ' || (p_size % 3) END AS grade
  FROM part),
fresh AS (SELECT * FROM catalog WHERE update_time >= DATE '2001-07-27'),
accounts AS (
  SELECT DISTINCT CAST(n_nationkey % 5 AS BIGINT) AS account_id,
         CASE WHEN n_nationkey % 5 % 2 = 0 THEN 'USD' ELSE 'EUR' END AS account_currency FROM nation),
rates AS (
  SELECT currency, account_currency, day,
         CASE WHEN currency = account_currency THEN 1.000 ELSE (900 + step * 100 + day(day)) * 0.001 END AS rate
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
       (VALUES ('USD', 'USD', 0), ('USD', 'EUR', 1), ('EUR', 'USD', 2), ('EUR', 'EUR', 3), ('GBP', 'USD', 4),
               ('GBP', 'EUR', 5)) c(currency, account_currency, step)
  WHERE NOT (month(day) = 2 AND day(day) = 29)),
pos AS (
  SELECT account_id, account_id AS dataset_id, CAST(device AS VARCHAR) AS customer_id, product_id, quantity, currency,
         price, max(fact_time) AS fact_time
  FROM lines WHERE in_store AND delivered_late GROUP BY ALL)
"""

GRAIN = "account_id, product_id, country_code, region"


def sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([TABLES.strip(), *ctes]) + "\n" + body


def micros(score: str) -> str:
    return f"CAST(CAST({score} AS DECIMAL(38,6)) * 1000000 AS HUGEINT)"


def millionths(numerator: str, denominator: str) -> str:
    """numerator / denominator in millionths, half up; both whole numbers."""
    return f"((2 * CAST({numerator} AS HUGEINT) * 1000000 + {denominator}) // (2 * CAST({denominator} AS HUGEINT)))"


# ---------------------------------------------------------------- metrics


def in_session(facts: str, sessions: str) -> str:
    return (
        f"{facts} f JOIN {sessions} s ON f.account_id = s.account_id AND f.device = s.device "
        "AND f.fact_time BETWEEN s.start_time AND s.end_time"
    )


def trend(recent: str, total: str) -> str:
    return f"CAST({millionths(recent, total)} AS DECIMAL(18,0)) * 0.000001"


def _since(days: int) -> str:
    return f"f.fact_time >= TIMESTAMP '2001-08-02' - INTERVAL {days} DAY"


METRICS = {
    "view": f"""SELECT s.account_id, product_id, country_code, region, count(*) AS subtotal
        FROM {in_session('views', 'view_sessions')}
        WHERE f.fact_time >= TIMESTAMP '2024-01-01' AND f.fact_time < TIMESTAMP '2024-01-31' GROUP BY ALL""",
    "purchase_online": f"""SELECT s.account_id, product_id, country_code, region, CAST(sum(quantity) AS BIGINT) AS subtotal
        FROM {in_session('online', 'online_sessions')} GROUP BY ALL""",
    "purchase_offline": """SELECT account_id, product_id, '' AS country_code, '' AS region,
        CAST(sum(quantity) AS BIGINT) AS subtotal FROM pos GROUP BY ALL""",
    "value_online": f"""SELECT s.account_id, product_id, country_code, region,
        sum(CAST(quantity AS DECIMAL(8,0)) * price * CAST(rate AS DECIMAL(10,3))) AS subtotal
        FROM {in_session('online', 'online_sessions')} JOIN accounts a ON a.account_id = s.account_id
        JOIN rates r ON r.currency = f.currency AND r.account_currency = a.account_currency
          AND r.day = CAST(f.fact_time AS DATE) GROUP BY ALL""",
    "value_offline": """SELECT f.account_id, product_id, '' AS country_code, '' AS region,
        sum(CAST(quantity AS DECIMAL(8,0)) * price * CAST(rate AS DECIMAL(10,3))) AS subtotal
        FROM pos f JOIN accounts a ON a.account_id = f.account_id
        JOIN rates r ON r.currency = f.currency AND r.account_currency = a.account_currency
          AND r.day = CAST(f.fact_time AS DATE) GROUP BY ALL""",
    "trending_online": f"""SELECT account_id, product_id, country_code, region, {trend('recent', 'total')} AS subtotal FROM (
        SELECT s.account_id, product_id, country_code, region,
               sum(CASE WHEN {_since(7)} THEN quantity END) AS recent, sum(quantity) AS total
        FROM {in_session('online', 'online_sessions')} WHERE {_since(30)} GROUP BY ALL) WHERE recent >= 5""",
    "trending_offline": f"""SELECT account_id, product_id, '' AS country_code, '' AS region,
        {trend('sum(quantity)', 'sum(quantity)')} AS subtotal FROM (
        SELECT account_id, device, product_id, quantity, currency, price, max(fact_time) AS fact_time
        FROM lines f WHERE in_store AND delivered_late AND {_since(7)} GROUP BY ALL) GROUP BY account_id, product_id""",
    "trending_offline_30d": f"""SELECT account_id, product_id, country_code, region, {trend('recent', 'total')} AS subtotal
        FROM (SELECT account_id, product_id, '' AS country_code, '' AS region,
               sum(CASE WHEN {_since(8)} THEN quantity END) AS recent, sum(quantity) AS total FROM (
          SELECT account_id, device, product_id, quantity, currency, price, max(fact_time) AS fact_time
          FROM lines f WHERE in_store AND delivered_late AND {_since(30)} GROUP BY ALL) f GROUP BY ALL) WHERE recent IS NOT NULL""",
}
for _name in ("purchase", "value", "trending"):
    METRICS[f"{_name}_both"] = (
        f"SELECT {GRAIN}, sum(subtotal) AS subtotal FROM ((SELECT {GRAIN}, subtotal FROM ({METRICS[_name + '_online']})) "
        f"UNION ALL (SELECT {GRAIN}, subtotal FROM ({METRICS[_name + '_offline']}))) GROUP BY ALL"
    )


def metric(name: str) -> str:
    kind = "BIGINT" if name.startswith(("view", "purchase")) else "DOUBLE"
    return sql(f"SELECT {GRAIN}, CAST(subtotal AS {kind}) AS subtotal FROM ({METRICS[name]})")


# ---------------------------------------------------------------- rankings

REPRESENTATIVES = "SELECT item_group_id, image_link, color, max(id) AS id FROM {source} WHERE {early} GROUP BY ALL"
TRIMMED = "list_transform(string_split(product_type, ','), lambda x: trim(x))"
BUCKETS = "unnest(list_append(list_transform(string_split(product_type, ','), lambda x: trim(x)), '')) AS split_product_type"


def scaled(metric_name: str, geo: tuple[str, ...], where: str = "TRUE") -> list[str]:
    columns = ", ".join(["product_id", *geo])
    return [
        f"rolled AS (SELECT {columns}, {micros('sum(subtotal)')} AS raw FROM ({METRICS[metric_name]}) WHERE {where} GROUP BY ALL)",
        f"scored AS (SELECT {columns}, ({millionths('raw', '(SELECT max(raw) FROM rolled)')} + 9) // 10 AS score FROM rolled)",
    ]


def ranking(
    metric_name: str, geo: tuple[str, ...] = (), early: str = "TRUE", late: str | None = None, buckets: bool = False,
    where: str = "TRUE",
) -> str:
    """Ranked SKUs; `late` is a condition on the trimmed product-type list of a look."""
    having = f" HAVING bool_or({late})" if late else ""
    group = list(geo) + (["split_product_type"] if buckets else [])
    columns = "".join(f"{c}, " for c in group)
    over = f"PARTITION BY {', '.join(group)} " if group else ""
    ctes = [
        *scaled(metric_name, geo, where),
        f"looks AS (SELECT item_group_id, image_link, color, max(id) AS id FROM fresh WHERE {early} GROUP BY ALL{having})",
        "skus AS (SELECT item_group_id, id FROM looks QUALIFY row_number() OVER (PARTITION BY item_group_id ORDER BY id DESC) <= 50)",
        f"exploded AS (SELECT {''.join(c + ', ' for c in geo)}k.id, score, product_type FROM scored JOIN skus k ON item_group_id = product_id "
        "JOIN catalog c ON c.id = k.id)",
    ]
    source = f"(SELECT *, {BUCKETS} FROM exploded)" if buckets else "exploded"
    ctes.append(
        f"ranked AS (SELECT {columns}id, CAST(row_number() OVER ({over}ORDER BY score DESC, id) AS INTEGER) AS rank, "
        f"CAST(score AS DOUBLE) / 100.0 AS score FROM {source})"
    )
    return sql(f"SELECT * FROM ranked WHERE rank <= 1000", *ctes)


# ---------------------------------------------------------------- pairs


def baskets(name: str) -> str:
    return {
        "online": "SELECT account_id, account_id AS dataset_id, CAST(device AS VARCHAR) AS customer_id, product_id, "
        "max(fact_time) AS fact_time FROM online GROUP BY ALL",
        "offline": "SELECT account_id, account_id AS dataset_id, CAST(device AS VARCHAR) AS customer_id, product_id, quantity, "
        "currency, price, max(fact_time) AS fact_time FROM lines WHERE in_store AND delivered_late GROUP BY ALL",
        "views": "SELECT account_id, account_id AS dataset_id, CAST(device AS VARCHAR) AS customer_id, product_id, "
        "min(fact_time) AS fact_time FROM views WHERE fact_time >= TIMESTAMP '2024-01-01' AND product_id LIKE 'TP-%' GROUP BY ALL",
        "views_all": "SELECT * FROM (SELECT account_id, account_id AS dataset_id, CAST(device AS VARCHAR) AS customer_id, "
        "product_id, min(fact_time) AS fact_time FROM views WHERE fact_time >= TIMESTAMP '2024-01-01' AND product_id LIKE 'TP-%' GROUP BY ALL) "
        "QUALIFY count(*) OVER (PARTITION BY account_id, customer_id) < 1000",
        "views_capped": "SELECT * FROM (SELECT account_id, account_id AS dataset_id, CAST(device AS VARCHAR) AS customer_id, "
        "product_id, min(fact_time) AS fact_time FROM views WHERE fact_time >= TIMESTAMP '2024-01-01' AND product_id LIKE 'TP-%' GROUP BY ALL) "
        "QUALIFY count(*) OVER (PARTITION BY account_id, customer_id) < 14",
    }[name]


def pair_counts(name: str, ordered: bool = False, minimum: int = 1) -> str:
    later = " AND p1.fact_time < p2.fact_time" if ordered else ""
    source = baskets(name)
    return (
        "SELECT p1.account_id, p1.product_id AS pid1, p2.product_id AS pid2, count(*) AS score "
        f"FROM ({source}) p1 JOIN ({source}) p2 ON p1.dataset_id = p2.dataset_id AND p1.customer_id = p2.customer_id "
        f"AND p1.product_id <> p2.product_id{later} GROUP BY ALL HAVING count(*) >= {minimum}"
    )


def both_pairs(ordered: bool, score: str) -> str:
    return (
        f"SELECT account_id, pid1, pid2, CAST({score} AS BIGINT) AS score FROM (({pair_counts('online', ordered)}) UNION ALL "
        f"({pair_counts('offline', ordered)})) GROUP BY ALL"
    )


VIEW_PAIRS = pair_counts("views", minimum=2)


def normalised(raw: str) -> str:
    """Hundredths of the min-max scaled score, from whole-number scores."""
    low, high = f"(SELECT min({raw}) FROM scores)", f"(SELECT max({raw}) FROM scores)"
    share = millionths(f"({raw} - {low})", f"greatest({high} - {low}, {{unit}})")
    return f"(({share} * 99999 * 2 + 1000000) // 2000000 + 1)"


def pair_ranks(pairs: str) -> list[str]:
    return [
        f"scores AS (SELECT account_id, pid1 AS lookup_key, pid2 AS product_id, CAST(score AS HUGEINT) AS score FROM ({pairs}))",
        "pairs AS (SELECT *, " + normalised("score").format(unit="CAST(1 AS HUGEINT)") + " AS hundredths FROM scores)",
    ]


def sku_lists(pair_ctes: list[str], static: str = "TRUE", dynamic: str | None = None, buckets: bool = False, unit: str = "1.0") -> str:
    """Ranked SKU lists from CTE `pairs` (lookup_key, product_id, score, hundredths)."""
    product_type = ", c.product_type" if buckets else ""
    condition = (
        f" AND EXISTS (SELECT 1 FROM fresh b WHERE b.item_group_id = p.lookup_key AND ({dynamic}))" if dynamic else ""
    )
    ctes = [
        *pair_ctes,
        f"lists AS (SELECT lookup_key, score, hundredths, c.color, c.image_link{product_type}, max(c.id) AS id FROM pairs p "
        f"JOIN fresh c ON c.item_group_id = p.product_id WHERE ({static}){condition} GROUP BY ALL)",
    ]
    bucket = "split_product_type, " if buckets else ""
    source = f"(SELECT *, {BUCKETS} FROM lists)" if buckets else "lists"
    ctes.append(
        f"ranked AS (SELECT lookup_key, {bucket}id, CAST(row_number() OVER (PARTITION BY lookup_key{', split_product_type' if buckets else ''} "
        f"ORDER BY score DESC, id DESC) AS INTEGER) AS rank, {{score}} AS score, CAST(hundredths AS DOUBLE) / 100.0 AS normalized_score FROM {source})"
    )
    return sql("SELECT * FROM ranked WHERE rank <= 50", *ctes)


def collab(pairs: str, **more) -> str:
    return sku_lists(pair_ranks(pairs), **more).replace("{score}", "CAST(score AS BIGINT)")


# list of trimmed-left product types, as the base-item tests see them
def _left(alias: str) -> str:
    return f"list_transform(string_split({alias}.product_type, ','), lambda x: ltrim(x))"


def any_pair(test: str) -> str:
    return (
        f"len(list_filter({_left('c')}, lambda r: len(list_filter({_left('b')}, lambda k: {test}(r, k))) > 0)) > 0"
    )


def similar(attributes: list[tuple[str, int | None]], dynamic: str | None = None) -> str:
    """Weights in millionths; None is inverse frequency."""
    stock = "SELECT DISTINCT item_group_id, color, brand, size_class, grade FROM catalog WHERE lower(availability) = 'in stock'"
    terms = []
    for name, weight in attributes:
        share = (
            str(weight) if weight is not None
            else f"(SELECT {millionths('1', 'n')} FROM counts_{name} k WHERE k.value = a.{name})"
        )
        terms.append((f"w_{name}", share, name))
    counts = [
        f"counts_{name} AS (SELECT {name} AS value, count(*) AS n FROM catalog WHERE lower(availability) = 'in stock' GROUP BY ALL)"
        for name, weight in attributes if weight is None
    ]
    weights = ", ".join(f"{share} AS {w}" for w, share, _ in terms)
    total = " + ".join(f"CASE WHEN a.{name} = b.{name} THEN {w} ELSE 0 END" for w, _, name in terms)
    ctes = [
        *counts,
        f"stock AS ({stock})",
        f"weighted AS (SELECT a.*, {weights} FROM stock a)",
        f"scores AS (SELECT DISTINCT a.item_group_id AS lookup_key, b.item_group_id AS product_id, CAST({total} AS HUGEINT) AS score "
        "FROM weighted a JOIN stock b ON a.item_group_id <> b.item_group_id)",
        "pairs AS (SELECT *, " + normalised("score").format(unit="CAST(1000000 AS HUGEINT)") + " AS hundredths FROM scores)",
    ]
    return sku_lists(ctes, dynamic=dynamic).replace("{score}", "CAST(score AS DOUBLE) / 1000000.0")


# ---------------------------------------------------------------- documents


SHARD_OF_3 = f"CAST({zlib.crc32(b'3') % (1 << 20)} AS BIGINT)"


def documents(ranks: str, key: str, feed: str, extra: str = "", sent: str = "2001-08-02 00:00:00") -> str:
    """`ranks` is a ranking or list query; its score column is renamed for the document."""
    return (
        f"SELECT {key}CAST(3 AS BIGINT) AS account, '{feed}' AS feed_type, {SHARD_OF_3} AS shard_key, '{sent}' AS sent_time, "
        f"CAST(1 AS INTEGER) AS strategy, id, rank, normalized_score{extra} FROM ({ranks})"
    )


def _global_as_document(ranks: str) -> str:
    return f"SELECT * EXCLUDE (score), score AS normalized_score FROM ({ranks})"


SLASH = "lower('product_type=' || split_product_type || '/country_code=' || country_code || '/region=' || region)"
JSON_COUNTRY = "lower(CAST(to_json({'_country_code': country_code, 'product_type': split_product_type}) AS VARCHAR))"
JSON_BUCKET = "lower(CAST(to_json({'product_type': split_product_type}) AS VARCHAR))"

STATIC = "(lower(c.title) LIKE '%ring%' OR lower(c.title) LIKE '%bolt%' OR lower(c.title) LIKE '%gear%') AND c.price > 920 AND c.is_bundle"

CATALOG_FILTERS = {
    "filter_startswith": "title LIKE 'small%' OR title LIKE 'red wid%'",
    "filter_startswith_product_type": "product_type LIKE 'ECONOMY%' OR product_type LIKE '%,ECONOMY%' OR "
    "product_type LIKE ' small%' OR product_type LIKE '%, small%'",
    "filter_not_startswith": "NOT (title LIKE 'small%' OR title LIKE 'red%')",
    "filter_startswith_wildcard": "title LIKE 's_all%g%'",
    "filter_contains": "lower(title) LIKE '%ring%' OR lower(title) LIKE '%gizmo%'",
    "filter_not_contains": "NOT lower(title) LIKE '%ring%'",
    "filter_in": "lower(color) IN ('red', 'blue')",
    "filter_not_in": "lower(brand) NOT IN ('brand#1', 'brand#2')",
    "filter_eq": "brand = 'Brand#3'",
    "filter_eq_list": "brand = 'Brand#3' OR brand = 'Brand#4'",
    "filter_ne_list": "brand <> 'Brand#3' OR brand <> 'Brand#4'",
    "filter_ne": "color <> 'red'",
    "filter_gt": "price > 950.1",
    "filter_ge": "price >= 950.1",
    "filter_lt": "price < 950.1",
    "filter_le": "price <= 950.1",
    "filter_not_in_null": "lower(grade) NOT IN ('grade 1')",
    "filter_not_contains_null": "NOT lower(grade) LIKE '%2%'",
    "filter_unknown_dropped": "brand = 'Brand#3'",
    "filter_boolean_value": "is_bundle",
    "filter_empty_list": "FALSE",
    "filter_and": "is_bundle AND lower(color) IN ('red') AND price > 950",
    "filter_or": "is_bundle OR lower(color) IN ('red')",
    "filter_and_empty": "TRUE",
    "filter_custom_string": "size_class = 'class 3'",
    "filter_custom_number": "size_value >= 25 AND size_value < 40",
}


def _rollup(geo: tuple[str, ...]) -> str:
    columns = ", ".join(["product_id", *geo])
    return sql(f"SELECT {columns}, CAST(score AS DOUBLE) / 100.0 AS score FROM scored", *scaled("purchase_online", geo))


# CRC-32 by its definition: the table follows from the polynomial, then one step per byte of the key's text.
SHARDS = """
WITH steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
hashed AS (
  SELECT c_custkey, xor(list_reduce(list_transform(string_split(CAST(c_custkey AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 1048576 AS shard_key
  FROM customer, steps)
SELECT c_custkey, shard_key, shard_key // 131072 * 131072 AS low, shard_key // 131072 * 131072 + 131072 AS high FROM hashed
"""


def _fan_out() -> str:
    """Documents of accounts 1 and 3 (older feed) and 2 and 4 (both feeds): views for all, pairs bought together."""
    parts = []
    for accounts, unified in (("1, 3", False), ("2, 4", False), ("2, 4", True)):
        whose = f"(SELECT CAST(unnest([{accounts}]) AS BIGINT) AS account)"
        for strategy, ranks, feed in (
            (1, _global_as_document(ranking("view")), "RECSET_NONCOLLAB_RECS"),
            (2, _global_as_document(ranking("purchase_online", early="is_bundle")), "RECSET_NONCOLLAB_RECS"),
            (3, f"SELECT * EXCLUDE (score) FROM ({collab(VIEW_PAIRS)})", "RECSET_COLLAB_RECS"),
        ):
            lookup = "lookup_key" if strategy == 3 else "CASE WHEN {u} THEN '' END"
            parts.append(
                f"SELECT account, CAST({strategy} AS INTEGER) AS strategy, '{'RECSET_RECS' if unified else feed}' AS feed_type, "
                f"{lookup.format(u=unified)} AS lookup_key, id, CAST(rank AS BIGINT) AS rank, normalized_score FROM ({ranks}), {whose}"
            )
    return " UNION ALL ".join(f"(SELECT * FROM ({p}))" for p in parts)


FAN_OUT = _fan_out()


def _shard_low(key: str) -> int:
    return zlib.crc32(key.encode()) % (1 << 20) // (1 << 17) * (1 << 17)


SHARD_LOW = "CASE account " + " ".join(f"WHEN {a} THEN {_shard_low(str(a))}" for a in range(5)) + " END"
WRITTEN = (
    f"SELECT *, 'recs_global' AS name, '20010802T0000' AS minute, CAST({SHARD_LOW} AS BIGINT) AS shard_low, "
    f"CAST({SHARD_LOW} + 131072 AS BIGINT) AS shard_high, account || '_' || strategy AS output, feed_type = 'RECSET_RECS' AS unified FROM ({FAN_OUT})"
)


def _product_feed(algorithm: str, days: int, pairs: str) -> str:
    return (
        f"SELECT 'recs_global_pid_pid' AS name, '20010802T0000' AS minute, 'None_None_1_{algorithm}_{days}' AS output, FALSE AS unified, "
        "account, n, hundredths FROM ("
        + sql(
            "SELECT account_id AS account, count(*) AS n, CAST(sum(hundredths) AS BIGINT) AS hundredths FROM (SELECT * FROM pairs "
            "QUALIFY row_number() OVER (PARTITION BY account_id, lookup_key ORDER BY score DESC, product_id DESC) <= 20) GROUP BY account_id",
            *pair_ranks(pairs),
        )
        + ")"
    )


FEEDS = " UNION ALL ".join(
    f"(SELECT * FROM ({p}))"
    for p in (
        _product_feed("view_also_view", 30, VIEW_PAIRS),
        _product_feed("purchase_also_purchase", 2405, pair_counts("online")),
        f"SELECT name, minute, output, unified, account, count(*) AS n, CAST(sum(round(normalized_score * 100)) AS BIGINT) AS hundredths FROM ({WRITTEN}) GROUP BY ALL",
    )
)

MANY_RANKINGS = sql(
    "SELECT n, NULL AS lookup_key, id, rank, CAST(score AS DOUBLE) / 100.0 AS normalized_score FROM ranked WHERE rank <= 1000",
    *scaled("view", ()),
    "s AS (SELECT CAST(unnest(range(150)) AS INTEGER) AS n)",
    "looks AS (SELECT n, item_group_id, image_link, color, max(id) AS id FROM fresh JOIN s ON price > 900 + 4 * n GROUP BY ALL "
    f"HAVING n % 3 <> 0 OR bool_or(array_to_string({TRIMMED}, ',') LIKE 'ECONOMY%' OR array_to_string({TRIMMED}, ',') LIKE '%,ECONOMY%'))",
    "skus AS (SELECT n, item_group_id, id FROM looks QUALIFY row_number() OVER (PARTITION BY n, item_group_id ORDER BY id DESC) <= 50)",
    "ranked AS (SELECT n, id, score, row_number() OVER (PARTITION BY n ORDER BY score DESC, id) AS rank FROM scored JOIN skus ON item_group_id = product_id)",
)
MANY_LISTS = sql(
    "SELECT n, lookup_key, id, rank, CAST(hundredths AS DOUBLE) / 100.0 AS normalized_score FROM ranked WHERE rank <= 50",
    *pair_ranks(VIEW_PAIRS),
    "s AS (SELECT CAST(unnest(range(150, 200)) AS INTEGER) AS n)",
    "lists AS (SELECT n, lookup_key, score, hundredths, c.color, c.image_link, max(c.id) AS id FROM pairs p JOIN fresh c ON c.item_group_id = p.product_id "
    "JOIN s ON c.price > 900 + 10 * (n - 150) WHERE n % 2 = 0 OR EXISTS (SELECT 1 FROM fresh b WHERE b.item_group_id = p.lookup_key AND c.color = b.color) GROUP BY ALL)",
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY n, lookup_key ORDER BY score DESC, id DESC) AS rank FROM lists)",
)
FAN_OUT_MANY = " UNION ALL ".join(
    f"(SELECT CAST(1 + n % 4 AS BIGINT) AS account, n AS strategy, '{feed}' AS feed_type, lookup_key, id, CAST(rank AS BIGINT) AS rank, normalized_score FROM ({rows}))"
    for feed, rows in (("RECSET_NONCOLLAB_RECS", MANY_RANKINGS), ("RECSET_COLLAB_RECS", MANY_LISTS))
)


def oracle_sql() -> dict[str, str]:
    found = {
        name: sql(f"SELECT id, item_group_id FROM catalog WHERE {test}") for name, test in CATALOG_FILTERS.items()
    }
    found |= {f"metric_{name}": metric(name) for name in METRICS}
    view_lists = collab(VIEW_PAIRS)
    view_buckets = collab(VIEW_PAIRS, buckets=True)
    found |= {
        "latest_catalog": sql("SELECT id, item_group_id, product_type FROM fresh"),
        "in_stock_catalog": sql("SELECT id, item_group_id FROM catalog WHERE lower(availability) = 'in stock'"),
        "offline_purchases": sql(
            "SELECT account_id, dataset_id, customer_id, product_id, quantity, currency, CAST(price AS DOUBLE) AS currency_unit_price, "
            "strftime(fact_time, '%Y-%m-%d') AS fact_time FROM pos"
        ),
        "valid_purchases_in_market": sql(
            "SELECT account_id, product_id, count(*) AS n FROM online WHERE account_id IN (1, 3) GROUP BY ALL"
        ),
        "scope_accounts": sql(
            "SELECT 'market' AS scope, account_id FROM accounts WHERE account_id IN (1, 3) UNION ALL "
            "SELECT 'retailer' AS scope, account_id FROM accounts"
        ),
        "session_join": sql(
            "SELECT f.account_id, f.device AS mid_ts, product_id, country_code, region, epoch_us(f.fact_time) AS fact_micros "
            f"FROM {in_session('views', 'view_sessions')} WHERE f.fact_time < TIMESTAMP '2024-01-31'"
        ),
        "geo_none": _rollup(()),
        "geo_country": _rollup(("country_code",)),
        "geo_region": _rollup(("country_code", "region")),
        "merged_product_types": sql(
            f"SELECT item_group_id, image_link, color, max(id) AS id, string_agg(array_to_string({TRIMMED}, ','), ',' ORDER BY id) "
            "AS product_type FROM catalog GROUP BY item_group_id, image_link, color"
        ),
        "representative_skus": sql(
            "SELECT item_group_id, id FROM (SELECT item_group_id, max(id) AS id FROM "
            f"(SELECT *, array_to_string({TRIMMED}, ',') AS part FROM catalog) GROUP BY item_group_id, image_link, color "
            "HAVING NOT bool_or(part LIKE 'small%' OR part LIKE '%,small%') "
            "AND bool_or(lower(part) LIKE '%ring%' OR lower(part) LIKE '%bolt%')) "
            "QUALIFY row_number() OVER (PARTITION BY item_group_id ORDER BY id DESC) <= 50"
        ),
        "product_type_buckets": sql(f"SELECT id, product_type, {BUCKETS} FROM catalog"),
        "rank_view": ranking("view"),
        "rank_most_popular": ranking("view"),
        "rank_view_filtered": ranking(
            "view", early="price > 905 AND is_bundle",
            late=" OR ".join(
                f"array_to_string({TRIMMED}, ',') LIKE '{p}'" for p in ("ECONOMY%", "%,ECONOMY%", "small%", "%,small%")
            ),
        ),
        "rank_view_buckets": ranking("view", buckets=True),
        "rank_purchase": ranking("purchase_online"),
        "rank_purchase_country": ranking("purchase_online", ("country_code",)),
        "rank_purchase_both_region": ranking("purchase_both", ("country_code", "region")),
        "rank_purchase_market": ranking("purchase_online", where="account_id IN (1, 3)"),
        "rank_purchase_value": ranking("value_both"),
        "rank_trending": ranking("trending_online"),
        "rank_or_filter_dropped": ranking("view"),
        "last_purchases": sql(
            "SELECT account_id, device AS mid_ts, product_id, strftime(max(fact_time), '%Y-%m-%d') AS day FROM online "
            "GROUP BY account_id, device, product_id"
        ),
        "earliest_views": sql(
            "SELECT account_id, CAST(customer_id AS BIGINT) AS mid_ts, product_id, epoch_us(fact_time) AS fact_micros "
            f"FROM ({baskets('views_all')})"
        ),
        "earliest_views_capped": sql(
            "SELECT account_id, CAST(customer_id AS BIGINT) AS mid_ts, product_id, epoch_us(fact_time) AS fact_micros "
            f"FROM ({baskets('views_capped')})"
        ),
        "pairs_together_online": sql(pair_counts("online")),
        "pairs_together_offline": sql(pair_counts("offline")),
        "pairs_together_both": sql(both_pairs(False, "sum(score)")),
        "pairs_sequence_online": sql(pair_counts("online", True)),
        "pairs_sequence_offline": sql(pair_counts("offline", True)),
        "pairs_sequence_both": sql(both_pairs(True, "count(*)")),
        "pairs_sequence_both_summed": sql(both_pairs(True, "sum(score)")),
        "pairs_views": sql(VIEW_PAIRS),
        "pairs_views_capped": sql(pair_counts("views_capped", minimum=2)),
        "pid_ranks_normalised": sql(
            "SELECT account_id, lookup_key, product_id, CAST(score AS BIGINT) AS score, "
            "CAST(hundredths AS DOUBLE) / 100.0 AS normalized_score FROM pairs", *pair_ranks(VIEW_PAIRS)
        ),
        "pair_feed": sql(
            "SELECT account_id, lookup_key, product_id, CAST(score AS BIGINT) AS score, "
            "CAST(hundredths AS DOUBLE) / 100.0 AS normalized_score, CAST(row_number() OVER (PARTITION BY account_id, lookup_key "
            "ORDER BY score DESC, product_id DESC) AS INTEGER) AS ordinal FROM pairs QUALIFY ordinal <= 10000",
            *pair_ranks(VIEW_PAIRS),
        ),
        "pair_feed_short": sql(
            "SELECT account_id, lookup_key, product_id, CAST(score AS BIGINT) AS score, "
            "CAST(hundredths AS DOUBLE) / 100.0 AS normalized_score, CAST(row_number() OVER (PARTITION BY account_id, lookup_key "
            "ORDER BY score DESC, product_id DESC) AS INTEGER) AS ordinal FROM pairs QUALIFY ordinal <= 5",
            *pair_ranks(VIEW_PAIRS),
        ),
        "pairs_together_threshold": sql(pair_counts("online", minimum=3)),
        "pairs_together_without_pos": sql(pair_counts("online")),
        "collab_starts_with_base_brand": collab(VIEW_PAIRS, dynamic="c.brand LIKE b.brand || '%'"),
        "similar_four_attributes": similar([("color", 500000), ("brand", 250000), ("size_class", 125000), ("grade", None)]),
        "scope_single_account": sql("SELECT account_id FROM accounts WHERE account_id = 3"),
        "output_accounts": sql("SELECT account_id, account_id % 2 = 0 AS unified FROM accounts WHERE account_id >= 1"),
        "fan_out_documents": FAN_OUT,
        "written_documents": WRITTEN,
        "published_feeds": FEEDS,
        "run_counts": "SELECT account, strategy, count(*) AS n FROM (" + FAN_OUT + ") WHERE feed_type <> 'RECSET_RECS' GROUP BY ALL",
        "fan_out_many": FAN_OUT_MANY,
        "context_items": sql(
            "SELECT DISTINCT item_group_id, color AS attr_color, size_class AS attr_size_class FROM catalog"
        ),
        "recommendable_items": sql(
            "SELECT item_group_id, color, image_link, size_class AS attr_size_class, max(id) AS id FROM catalog GROUP BY ALL"
        ),
        "collab_static": collab(pair_counts("online"), static=STATIC),
        "collab_views": view_lists,
        "collab_bucket": view_buckets,
        "collab_same_colour": collab(VIEW_PAIRS, dynamic="c.color = b.color"),
        "collab_other_class": collab(VIEW_PAIRS, dynamic="c.size_class <> b.size_class"),
        "collab_contains_base_title": collab(VIEW_PAIRS, dynamic="c.title LIKE '%' || b.title || '%'"),
        "collab_product_type_contains": collab(VIEW_PAIRS, dynamic=any_pair("contains")),
        "bought_together": collab(both_pairs(False, "sum(score)"), dynamic=f"NOT ({any_pair('starts_with')})"),
        "subsequently_purchased": collab(pair_counts("online", True)),
        "similar_weighted": similar([("color", 500000), ("brand", 250000)]),
        "similar_inverse_frequency": similar([("color", None), ("size_class", None)]),
        "similar_same_colour": similar([("color", None), ("size_class", None)], "c.color = b.color"),
        "doc_global": documents(
            _global_as_document(ranking("purchase_online", ("country_code", "region"), buckets=True)),
            f"sha1({SLASH}) AS pushdown_filter_hash, ", "RECSET_NONCOLLAB_RECS",
        ),
        "doc_unified": documents(
            _global_as_document(ranking("purchase_online", ("country_code",), buckets=True)),
            f"sha1({JSON_COUNTRY}) AS pushdown_filter_hash, '' AS lookup_key, {JSON_COUNTRY} AS pushdown_filter_json, ",
            "RECSET_RECS",
        ),
        "doc_pairs": documents(view_lists, "lookup_key, ", "RECSET_COLLAB_RECS", sent="2024-01-31 00:00:00"),
        "doc_pairs_unified": documents(
            view_buckets,
            f"sha1({JSON_BUCKET}) AS pushdown_filter_hash, lookup_key, {JSON_BUCKET} AS pushdown_filter_json, ",
            "RECSET_RECS", sent="2024-01-31 00:00:00",
        ),
        "doc_products": sql(
            "SELECT account_id AS account, lookup_key, 'RECSET_COLLAB_RECS_PID' AS feed_type, 'view_also_view' AS algorithm, "
            "CAST(ordinal - 1 AS INTEGER) AS at, "
            "product_id, CAST(hundredths AS DOUBLE) / 100.0 AS normalized_score, CAST(score AS BIGINT) AS score FROM ("
            "SELECT *, row_number() OVER (PARTITION BY account_id, lookup_key ORDER BY score DESC, product_id DESC) AS ordinal "
            "FROM pairs QUALIFY ordinal <= 10000)", *pair_ranks(VIEW_PAIRS)
        ),
        "result_count": f"SELECT count(*) AS n FROM ({ranking('view', buckets=True)})",
        "shard_keys": SHARDS,
        "active_strategies": """
            WITH live_groups AS (
              SELECT n_nationkey AS id FROM nation WHERE n_regionkey <> 0 AND (
                DATE '2001-05-01' + n_nationkey * 3 > DATE '2001-07-03'
                OR (n_regionkey = 1 AND n_nationkey = 6) OR n_nationkey = 12)),
            live_orders AS (
              SELECT o.* FROM orders o JOIN customer ON o_custkey = c_custkey WHERE c_nationkey IN (SELECT id FROM live_groups)),
            used AS (
              SELECT l_partkey FROM lineitem JOIN live_orders ON l_orderkey = o_orderkey
              WHERE (l_returnflag IN ('A', 'R') AND o_orderstatus <> 'P')
                 OR (o_orderpriority IN ('1-URGENT', '2-HIGH') AND l_linenumber * 2 > (CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END)
                     AND l_linenumber * 2 + 1 < 1000))
            SELECT p_partkey AS id, p_size = 50 AS is_component FROM part
            WHERE p_size = 50 OR DATE '2001-06-01' + p_size >= DATE '2001-07-03' OR p_partkey IN (SELECT l_partkey FROM used)""",
    }
    return found
