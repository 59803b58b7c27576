"""Shard keys, shard ranges and the lookup hashes stored on documents."""

from pyspark.sql import Column, functions as F

# Size of the shard space and number of equal ranges.
SHARD_SPACE = 1 << 20
SHARD_RANGES = 8

# Geo columns by geo target.
GEO_COLUMNS = {
    "none": (),
    "country": ("country_code",),
    "region": ("country_code", "region"),
}


def geo_columns(geo_target: str | None) -> tuple[str, ...]:
    return GEO_COLUMNS.get(geo_target or "none", ())


def shard_key(key: Column) -> Column:
    """CRC-32 of the key's text, folded into the shard space."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(SHARD_SPACE))


def shard_low(shard: Column) -> Column:
    """Lower bound of the range a shard key falls in."""
    width = SHARD_SPACE // SHARD_RANGES
    return (F.floor(shard / F.lit(width)) * F.lit(width)).cast("bigint")


def shard_high(shard: Column) -> Column:
    """Upper bound (exclusive) of the range a shard key falls in."""
    return shard_low(shard) + F.lit(SHARD_SPACE // SHARD_RANGES)


def minute_bucket(when: Column) -> Column:
    return F.date_trunc("minute", when)


def slash_filter_text(product_type: Column, geo: tuple[str, ...]) -> Column:
    """Filter key of the older feed: product_type=../country_code=../region=.."""
    parts = [F.lit("product_type="), product_type]
    for name in geo:
        parts += [F.lit(f"/{name}="), F.coalesce(F.col(name), F.lit(""))]
    return F.lower(F.concat(*parts))


def json_filter_text(product_type: Column, geo: tuple[str, ...]) -> Column:
    """Filter key of the unified feed: lower-case JSON with sorted keys."""
    entries = {"product_type": product_type}
    entries |= {f"_{name}": F.coalesce(F.col(name), F.lit("")) for name in geo}
    return F.lower(F.to_json(F.struct(*[entries[k].alias(k) for k in sorted(entries)])))
