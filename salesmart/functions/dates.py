"""Calendar expressions. Weeks start on Sunday; day keys are yyyymmdd integers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

# Text formats of dates in the source files.
ISO_DATE = "yyyy-MM-dd"
COMPACT_DATE = "yyyyMMdd"
ISO_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"

CALENDAR_COLUMNS = (
    "date_key", "full_date", "year", "quarter", "month", "month_name",
    "week", "day", "day_name", "is_weekend", "is_holiday",
)


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def week_start(day: Column) -> Column:
    """The Sunday on or before ``day``."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def sunday_week(day: Column) -> Column:
    """Week number 0-53; days before the year's first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("bigint")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def parse_day(df: DataFrame, name: str, fmt: str = ISO_DATE) -> Column:
    """``name`` as a DATE: parsed when it arrives as text, cast otherwise."""
    column = F.col(name)
    return F.to_date(column, fmt) if isinstance(df.schema[name].dataType, StringType) else column.cast("date")


def parse_moment(df: DataFrame, name: str, fmt: str = ISO_TIMESTAMP) -> Column:
    """``name`` as a timestamp: parsed when it arrives as text, taken as is otherwise."""
    column = F.col(name)
    return F.to_timestamp(column, fmt) if isinstance(df.schema[name].dataType, StringType) else column


def date_series(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    return spark.range(1).select(_every_day(F.lit(first).cast("date"), F.lit(last).cast("date")))


def date_series_of(df: DataFrame, day: Column) -> DataFrame:
    """One row per calendar day between the earliest and latest ``day`` of ``df``."""
    return df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(_every_day(F.col("lo"), F.col("hi")))


def _every_day(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date")


def calendar(days: DataFrame) -> DataFrame:
    """The calendar dimension over a frame with a ``full_date`` column."""
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        sunday_week(day).alias("week"),
        F.dayofmonth(day).cast("bigint").alias("day"),
        F.date_format(day, "EEEE").alias("day_name"),
        is_weekend(day).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )
