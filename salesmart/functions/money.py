"""Money arithmetic. Sums run on decimals so that they do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
_WIDE = DecimalType(22, 2)


def money(value: Column | str) -> Column:
    return _col(value).cast(MONEY)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded half up; NULL where ``whole`` is zero.

    The ratio keeps 16 fractional digits and is rounded once, so the result is exact.
    """
    ratio = part.cast(_WIDE) / F.nullif(whole.cast(_WIDE), F.lit(0).cast(_WIDE))
    return F.round(ratio, digits + 2) * 100


def mean(total: Column, count: Column) -> Column:
    """Average as a DOUBLE from an exact sum; NULL where ``count`` is zero."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def average_of(value: Column) -> Column:
    """Aggregate expression: average over non-null values from an exact sum."""
    return mean(F.sum(value), F.count(value))


def as_doubles(df: DataFrame) -> DataFrame:
    """Turn every decimal column into DOUBLE, the money type of the published tables."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
