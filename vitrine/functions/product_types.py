"""Product-type lists: a catalog stores them as one comma-separated string."""

from pyspark.sql import Column, functions as F

# A comma followed by an even number of quotes lies outside quoted text.
_COMMA_OUTSIDE_QUOTES = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def parse_list(text: Column) -> Column:
    """Split on commas outside quotes; elements lose leading blanks only.

    Trailing blanks stay: matching of base-item product types depends on them.
    """
    return F.transform(
        F.split(text, _COMMA_OUTSIDE_QUOTES, -1),
        lambda part: F.regexp_replace(F.ltrim(part), '^"(.*)"( *)$', "$1$2"),
    )


def trimmed_list_text(text: Column) -> Column:
    """The list with blanks around every element removed, as one string again."""
    return F.array_join(F.transform(F.split(text, ",", -1), lambda part: F.trim(part)), ",")


def buckets(text: Column) -> Column:
    """Every listed product type plus '' (the bucket that holds everything)."""
    return F.transform(F.array_append(parse_list(text), F.lit("")), lambda part: F.trim(part))


def any_startswith(left: Column, right: Column) -> Column:
    """True when some element of `left` starts with some element of `right`."""
    return F.exists(left, lambda a: F.exists(right, lambda b: F.startswith(a, b)))


def any_contains(left: Column, right: Column) -> Column:
    """True when some element of `left` contains some element of `right` (case-sensitive)."""
    return F.exists(left, lambda a: F.exists(right, lambda b: F.contains(a, b)))
