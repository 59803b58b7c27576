"""Facts joined to the session they happened in."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.times import stamp

SLOT_SECONDS = 3600


def _slot(when: Column) -> Column:
    return F.floor(F.unix_seconds(when) / F.lit(SLOT_SECONDS))


def join_sessions(facts: DataFrame, sessions: DataFrame, window: tuple[datetime, datetime]) -> DataFrame:
    """Inner join on account and device with start_time <= fact_time <= end_time.

    Sessions are laid out over the hours they touch and the hour joins the key.
    A device that produces a large share of all facts is thereby spread over as
    many keys as it was active hours, and a fact meets only the sessions of its
    own hour instead of every session of its device. Hours outside the fact
    window are not laid out, which bounds the copies of a session.
    """
    begin, end = stamp(window[0]), stamp(window[1])
    reachable = sessions.where(
        (F.col("start_time") < end) & (F.col("end_time") >= begin) & (F.col("end_time") >= F.col("start_time"))
    )
    first, last = _slot(F.greatest("start_time", begin)), _slot(F.least("end_time", end))
    laid_out = reachable.withColumn("slot", F.explode(F.sequence(first, last)))
    return (
        facts.withColumn("slot", _slot(F.col("fact_time")))
        .join(laid_out, ["account_id", "mid_ts", "mid_rnd", "slot"])
        .where(F.col("fact_time").between(F.col("start_time"), F.col("end_time")))
        .drop("slot")
    )
