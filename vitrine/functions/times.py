"""Look-back windows. Every plan takes `as_of`; nothing reads the clock."""

from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F


def lookback_window(as_of: datetime, days: int) -> tuple[datetime, datetime]:
    """[midnight(as_of) - days, midnight(as_of))."""
    end = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    return end - timedelta(days=days), end


def session_window(window: tuple[datetime, datetime], lead: timedelta = timedelta(days=1)) -> tuple[datetime, datetime]:
    """Bounds on session starts that cover a fact window: sessions begin at most `lead` earlier."""
    begin, end = window
    return begin - lead, end


def stamp(value: datetime) -> Column:
    """A timestamp literal read in the session time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp")


def within(column: Column, window: tuple[datetime, datetime]) -> Column:
    """Half-open test begin <= column < end."""
    begin, end = window
    return (column >= stamp(begin)) & (column < stamp(end))
