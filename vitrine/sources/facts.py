"""Scans of behavioural facts. Filters are plain predicates, so they reach the files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from vitrine.functions.times import stamp, within

Window = tuple[datetime, datetime]

# Product ids that trackers send when they have none.
INVALID_PRODUCT_IDS = ("", "null", "NULL")


def in_scope(df: DataFrame, accounts: DataFrame) -> DataFrame:
    """Rows of the accounts in scope. The account list is small but unchecked, so no broadcast is forced."""
    return df.join(accounts.select("account_id"), "account_id", "left_semi")


def _dated(df: DataFrame, column: str, begin: datetime, end: datetime | None) -> DataFrame:
    """Bounds on the date column, where a table has one: tables partitioned by date are then read only where needed.

    Rows without a date stay; their time decides.
    """
    if column not in df.columns:
        return df
    day = F.col(column)
    dated = df.where(day.isNull() | (day >= F.lit(begin.date())))
    return dated if end is None else dated.where(day.isNull() | (day <= F.lit(end.date())))


def facts_between(facts: DataFrame, accounts: DataFrame, window: Window) -> DataFrame:
    inside = _dated(facts, "fact_date", *window).where(within(F.col("fact_time"), window))
    return in_scope(inside, accounts)


def facts_since(facts: DataFrame, accounts: DataFrame, begin: datetime, until: datetime | None = None) -> DataFrame:
    """Facts from `begin` on; `until` makes a re-run on later data repeatable."""
    recent = _dated(facts, "fact_date", begin, until).where(F.col("fact_time") >= stamp(begin))
    if until is not None:
        recent = recent.where(F.col("fact_time") < stamp(until))
    return in_scope(recent, accounts)


def with_product(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("product_id").isNotNull())


def with_valid_product(facts: DataFrame) -> DataFrame:
    return facts.where(~F.col("product_id").isin(*INVALID_PRODUCT_IDS))


def sessions_between(sessions: DataFrame, accounts: DataFrame, window: Window) -> DataFrame:
    """Sessions that start in the window, with NULL geography as ''."""
    inside = _dated(sessions, "start_date", *window).where(within(F.col("start_time"), window))
    return in_scope(inside, accounts).select(
        "account_id",
        "mid_ts",
        "mid_rnd",
        "start_time",
        "end_time",
        F.coalesce("country_code", F.lit("")).alias("country_code"),
        F.coalesce("region", F.lit("")).alias("region"),
    )


def point_of_sale(
    pos_lines: DataFrame,
    account_datasets: DataFrame,
    expiration: DataFrame,
    begin: datetime,
    until: datetime | None = None,
) -> DataFrame:
    """Fresh point-of-sale lines of (account_id, dataset_id) pairs, one per distinct purchase.

    Repeats of customer, product, quantity and price keep their latest time. The
    look-back bound is tested before the grouping: a group's latest time lies in
    the window exactly when one of its rows does, and the scan gets the filter.
    """
    cutoffs = account_datasets.join(expiration.select("dataset_id", "cutoff_time"), "dataset_id")
    lines = with_valid_product(pos_lines).where(F.col("time") >= stamp(begin))
    if until is not None:
        lines = lines.where(F.col("time") < stamp(until))
    return (
        lines.join(cutoffs, "dataset_id")
        .where(F.col("update_time") >= F.col("cutoff_time"))
        .groupBy(
            "account_id", "dataset_id", "customer_id", "product_id", "quantity", "currency", "currency_unit_price"
        )
        .agg(F.max("time").alias("fact_time"))
    )


def account_datasets(settings: DataFrame, accounts: DataFrame) -> DataFrame:
    """(account_id, dataset_id) of the accounts in scope that have point-of-sale data."""
    return in_scope(settings.where(F.col("pos_dataset_id").isNotNull()), accounts).select(
        "account_id", F.col("pos_dataset_id").alias("dataset_id")
    )
