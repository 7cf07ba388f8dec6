"""Number and text expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: what a device reports when it has no reading
NO_READING = float(2**63 - 1)


# from here on a double has no fraction
WHOLE = float(2**53)


def round_at(x: Column, scale: float) -> Column:
    """Rounded to 1/scale, halves upward; the same IEEE steps in every engine. Doubles without a fraction stay."""
    return F.when(F.abs(x) >= F.lit(WHOLE), x).otherwise(
        F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale))


def round2(x: Column) -> Column:
    return round_at(x, 100.0)


def decimal2(x: Column) -> Column:
    return round2(x).cast("decimal(38,2)")


def is_number(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


def clamp(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit a number; null and NaN stay what they are."""
    bounded = x
    if high is not None:
        bounded = F.least(F.lit(float(high)), bounded)
    if low is not None:
        bounded = F.greatest(F.lit(float(low)), bounded)
    return F.when(is_number(x), bounded).otherwise(x)


def level_of(score: Column) -> Column:
    """Severity 1-4 of a score; no score, no level."""
    return (
        F.when(score.isNull(), F.lit(None).cast("int"))
        .when((score >= 0) & (score < 40), 1)
        .when((score >= 40) & (score < 60), 2)
        .when((score >= 60) & (score < 80), 3)
        .otherwise(4)
    )


def vendor_of(device_set: Column) -> Column:
    """Fourth token of a device set name, null when there are fewer."""
    return F.get(F.split(device_set, "_"), F.lit(3))


def record_id(*columns: Column) -> Column:
    """Hex digest of the key columns; nulls count as empty text."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)
