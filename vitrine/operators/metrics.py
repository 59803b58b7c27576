"""Per-product metrics: views, units, revenue and trend, online and at the point of sale.

Every metric is a table (account_id, product_id, country_code, region, subtotal).
Point-of-sale lines have no geography and carry ''.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.scores import ratio
from vitrine.functions.times import within
from vitrine.operators.sessions import join_sessions
from vitrine.sources.facts import facts_between, sessions_between, with_product

Window = tuple[datetime, datetime]
GRAIN = ("account_id", "product_id", "country_code", "region")
MONEY = "decimal(38,6)"


def _online(lines: DataFrame, sessions: DataFrame, accounts: DataFrame, window: Window, starts: Window) -> DataFrame:
    return join_sessions(
        facts_between(lines, accounts, window), sessions_between(sessions, accounts, starts), window
    )


def _nowhere(df: DataFrame) -> DataFrame:
    return df.withColumns({"country_code": F.lit(""), "region": F.lit("")})


def _table(df: DataFrame, subtotal: Column) -> DataFrame:
    return df.groupBy(*GRAIN).agg(subtotal.alias("subtotal"))


def views(product_views: DataFrame, sessions: DataFrame, accounts: DataFrame, window: Window, starts: Window) -> DataFrame:
    """Product views inside sessions."""
    facts = product_views.select("account_id", "mid_ts", "mid_rnd", "fact_time", "product_id")
    return _table(_online(facts, sessions, accounts, window, starts), F.count(F.lit(1)))


def units_online(lines: DataFrame, sessions: DataFrame, accounts: DataFrame, window: Window, starts: Window) -> DataFrame:
    facts = with_product(lines).select("account_id", "mid_ts", "mid_rnd", "fact_time", "product_id", "quantity")
    return _table(_online(facts, sessions, accounts, window, starts), F.sum("quantity"))


def units_pos(pos: DataFrame, window: Window) -> DataFrame:
    """Units at the point of sale; `pos` comes from sources.facts.point_of_sale."""
    return _table(_nowhere(with_product(pos).where(within(F.col("fact_time"), window))), F.sum("quantity"))


def _converted(daily: DataFrame, accounts: DataFrame, exchange_rates: DataFrame) -> DataFrame:
    """Turn daily revenue per line currency into account currency; days without a rate are lost.

    Revenue is summed per day and currency first, so the rate join sees one row
    per product, place, day and currency instead of one per purchase line, and a
    dominant currency is no hot key any more.
    """
    rates = exchange_rates.select(
        F.col("from_currency_code").alias("currency"),
        F.col("to_currency_code").alias("account_currency"),
        F.to_date("effective_date").alias("fact_day"),
        "rate",
    )
    currencies = accounts.select("account_id", F.col("currency").alias("account_currency"))
    converted = daily.join(currencies, "account_id").join(rates, ["currency", "account_currency", "fact_day"])
    return _table(converted, F.sum((F.col("amount") * F.col("rate")).cast(MONEY)))


def _daily_amounts(lines: DataFrame) -> DataFrame:
    """Revenue per place, day and currency. Rows are dealt out by the grain alone, so that its later sum needs no shuffle."""
    amount = F.col("quantity").cast("decimal(18,0)") * F.col("currency_unit_price").cast("decimal(18,4)")
    amounts = lines.select(*GRAIN, "currency", F.to_date("fact_time").alias("fact_day"), amount.cast("decimal(28,4)").alias("amount"))
    return (
        amounts.repartition(*GRAIN)
        .groupBy(*GRAIN, "currency", "fact_day")
        .agg(F.sum("amount").alias("amount"))
        .withColumn("amount", F.col("amount").cast("decimal(28,4)"))
    )


def revenue_online(
    lines: DataFrame,
    sessions: DataFrame,
    accounts: DataFrame,
    exchange_rates: DataFrame,
    window: Window,
    starts: Window,
) -> DataFrame:
    """Revenue in account currency; `accounts` needs account_id and currency."""
    facts = with_product(lines).select(
        "account_id", "mid_ts", "mid_rnd", "fact_time", "product_id", "quantity", "currency", "currency_unit_price"
    )
    joined = _online(facts, sessions, accounts, window, starts)
    return _converted(_daily_amounts(joined), accounts, exchange_rates)


def revenue_pos(pos: DataFrame, accounts: DataFrame, exchange_rates: DataFrame, window: Window) -> DataFrame:
    lines = _nowhere(pos.where(within(F.col("fact_time"), window)))
    return _converted(_daily_amounts(lines), accounts, exchange_rates)


def _sum_if(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("quantity")))


def _trend(df: DataFrame, short: Column, long: Column, minimum: int | None) -> DataFrame:
    """Units of the short window over units of the long one, both from a single pass."""
    sums = df.groupBy(*GRAIN).agg(_sum_if(short).alias("recent"), _sum_if(long).alias("total"))
    kept = sums.where(F.col("total").isNotNull())
    kept = kept.where(F.col("recent") >= minimum) if minimum else kept.where(F.col("recent").isNotNull())
    return kept.select(*GRAIN, ratio(F.col("recent"), F.col("total")).alias("subtotal"))


def trend_online(
    lines: DataFrame,
    sessions: DataFrame,
    accounts: DataFrame,
    short: Window,
    short_starts: Window,
    long: Window,
    long_starts: Window,
    minimum_units: int = 5,
) -> DataFrame:
    """Recent units over long-run units, for products with at least `minimum_units` recently."""
    facts = with_product(lines).select("account_id", "mid_ts", "mid_rnd", "fact_time", "product_id", "quantity")
    window = (min(short[0], long[0]), max(short[1], long[1]))
    starts = (min(short_starts[0], long_starts[0]), max(short_starts[1], long_starts[1]))
    joined = _online(facts, sessions, accounts, window, starts)
    fact_time, start = F.col("fact_time"), F.col("start_time")
    return _trend(
        joined,
        within(fact_time, short) & within(start, short_starts),
        within(fact_time, long) & within(start, long_starts),
        minimum_units,
    )


def trend_pos(pos: DataFrame, short: Window, long: Window) -> DataFrame:
    fact_time = F.col("fact_time")
    return _trend(_nowhere(pos), within(fact_time, short), within(fact_time, long), None)


def merged(online: DataFrame, pos: DataFrame) -> DataFrame:
    """Online and point-of-sale subtotals added up."""
    return _table(online.unionByName(pos), F.sum("subtotal"))


def rolled_up(metric: DataFrame, geo: tuple[str, ...], per: tuple[str, ...] = ()) -> DataFrame:
    """Score per product at the geo level asked for; `per` keeps accounts apart."""
    return metric.groupBy(*per, "product_id", *geo).agg(F.sum("subtotal").alias("score"))
