"""Rounding as the result files have it.

Spark's ``round`` works on the printed decimal; the published figures come from
two other rules, which differ on values such as 0.15 or 2.25.
"""

from pyspark.sql import Column, DataFrame, functions as F

# Splits a double into two halves whose products are exact.
_SPLITTER = 134217729.0


def round_exact(x: Column, digits: int) -> Column:
    """Round the exact binary value of ``x``, exact ties to even."""
    scale = float(10 ** digits)
    product = x * F.lit(scale)
    big = x * F.lit(_SPLITTER)
    high = big - (big - x)
    low = x - high
    # product + error is x * scale without any rounding
    error = (high * F.lit(scale) - product) + low * F.lit(scale)
    whole = F.floor(product).cast("double")
    above_half = (product - whole - F.lit(0.5)) + error
    up = (above_half > 0) | ((above_half == 0) & (whole % 2 != 0))
    return (whole + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / F.lit(scale)


def round_scaled(x: Column, digits: int) -> Column:
    """Scale, round to the nearest whole number (ties to even), scale back."""
    scale = float(10 ** digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def with_percent(rows: DataFrame, part: str, whole: Column, digits: int | None = 1, name: str = "pct") -> DataFrame:
    """Add 100 * part / whole; ``digits=None`` leaves it unrounded.

    ``whole`` (often a subquery) becomes a column first, so that it is planned once
    however often the rounding refers to it.
    """
    value = (F.col(part) * F.lit(100)).cast("double") / F.col("_whole").cast("double")
    rounded = value if digits is None else round_exact(value, digits)
    return rows.withColumn("_whole", whole).withColumn(name, rounded).drop("_whole")
