"""Score scaling. Ratios carry six decimals, as a fixed-point warehouse would give."""

from pyspark.sql import Column, functions as F

RATIO_TYPE = "decimal(18,6)"
_EXACT = "decimal(38,6)"


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, rounded half-up to six decimals; NULL on division by zero."""
    return F.try_divide(numerator.cast(_EXACT), denominator.cast(_EXACT)).cast(RATIO_TYPE)


def scale_to_max(score: Column, max_score: Column) -> Column:
    """Map (0, max] to (0, 1000], rounded up to two decimals."""
    return F.ceil(ratio(score, max_score) * F.lit(1000), F.lit(2)).cast("decimal(18,2)")


def normalise(score: Column, low: Column, high: Column) -> Column:
    """Min-max map to [0.01, 1000]; a spread under 1 counts as 1."""
    spread = F.greatest((high - low).cast(_EXACT), F.lit(1).cast(_EXACT))
    position = ratio(score - low, spread)
    stretched = position * F.lit("999.99").cast("decimal(5,2)") + F.lit("0.01").cast("decimal(3,2)")
    return F.round(stretched, 2).cast("decimal(18,2)")
