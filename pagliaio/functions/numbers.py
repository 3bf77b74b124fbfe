"""Column expressions that read numbers written the Italian way."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits_joined(c: Column) -> Column:
    """All digits up to the first comma, dots dropped: ranges run together by design."""
    kept = F.regexp_replace(c, "[^0-9,.]", "")
    return F.split_part(F.replace(kept, F.lit("."), F.lit("")), F.lit(","), F.lit(1)).try_cast("long")


def first_whole(c: Column) -> Column:
    """The first complete number only, thousands dots allowed, decimals cut."""
    found = F.regexp_extract(c, "([0-9]{1,3}(?:[.][0-9]{3})+|[0-9]+)", 1)
    return F.replace(found, F.lit("."), F.lit("")).try_cast("long")


def italian_decimal(c: Column) -> Column:
    """``1.400`` is 1400 and ``1,5`` is 1.5; NULL where the text is no number."""
    return F.replace(F.replace(F.trim(c), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def relative_to_min(a: Column, b: Column) -> Column:
    return (F.greatest(a, b) - F.least(a, b)) / F.nullif(F.least(a, b), F.lit(0))


def relative_to_max(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.nullif(F.greatest(a, b), F.lit(0))


def relative_to_first(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.nullif(a, F.lit(0))
