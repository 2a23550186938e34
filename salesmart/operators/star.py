"""Star schema: calendar, customer and product dimensions and the sales fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesmart.functions.dates import calendar, date_key, date_series, parse_day, parse_moment
from salesmart.functions.keys import surrogate_key
from salesmart.functions.money import money
from salesmart.operators.merge import merge_table
from salesmart.operators.transform import Day, on_days, on_moments
from salesmart.sources.tables import add_audit

# Span of the calendar dimension.
CALENDAR_FIRST, CALENDAR_LAST = "2020-01-01", "2030-12-31"
#: What tells one sale from another.
FACT_IDENTITY = ("transaction_date", "transaction_id")
#: Of rows of one sale in a load, the latest one counts; a later load's row replaces that of an earlier one.
FACT_NEWEST = ("transaction_timestamp",)


def dim_date(spark: SparkSession, first: str = CALENDAR_FIRST, last: str = CALENDAR_LAST) -> DataFrame:
    return calendar(date_series(spark, first, last))


def dim_date_fill(target: DataFrame, days: DataFrame) -> DataFrame:
    """Add the calendar days that ``target`` lacks; present days stay as they are."""
    return merge_table(target, days, on="date_key", insert=days.columns)


def dim_customer(raw: DataFrame, run_ts: datetime | Column | None = None) -> DataFrame:
    rows = raw.select(
        surrogate_key(F.col("customer_id")).alias("customer_key"),
        "customer_id", "customer_name", "email", "city", "country",
        parse_day(raw, "created_date").alias("created_date"),
    )
    return add_audit(rows, "effective_date", run_ts).withColumn("is_current", F.lit(True))


def dim_product(raw: DataFrame, run_ts: datetime | Column | None = None) -> DataFrame:
    rows = raw.select(
        surrogate_key(F.col("product_id")).alias("product_key"),
        "product_id", "product_name", "category", "subcategory", F.col("unit_price").cast("double").alias("unit_price"),
    )
    return add_audit(rows, "effective_date", run_ts).withColumn("is_current", F.lit(True))


def scd1_customer(target: DataFrame, source: DataFrame, settled: bool = False) -> DataFrame:
    """Overwrite the attributes of known customers, add unknown ones."""
    return merge_table(
        target, source, on="customer_id",
        update=["customer_name", "email", "city", "country", "effective_date"], insert=source.columns, settled=settled,
    )


def scd1_product(target: DataFrame, source: DataFrame, settled: bool = False) -> DataFrame:
    return merge_table(
        target, source, on="product_id",
        update=["product_name", "category", "subcategory", "unit_price", "effective_date"], insert=source.columns, settled=settled,
    )


def fact_sales(raw: DataFrame, first: Day | None = None, last: Day | None = None) -> DataFrame:
    """Fact rows: parsed moment, day key, hashed dimension keys, money and a partition day.

    Without a day range every row is kept under its own day, late ones included.
    """
    rows = raw.withColumn("transaction_timestamp", parse_moment(raw, "transaction_timestamp"))
    rows = on_moments(rows, "transaction_timestamp", first, last)
    rows = rows.withColumn("transaction_date", F.to_date("transaction_timestamp"))
    total, discount = money("total_amount"), money("discount_amount")
    return rows.select(
        "transaction_id",
        date_key(F.col("transaction_date")).alias("date_key"),
        surrogate_key(F.col("customer_id")).alias("customer_key"),
        surrogate_key(F.col("product_id")).alias("product_key"),
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        total.alias("total_amount"),
        discount.alias("discount_amount"),
        (total - discount).cast("decimal(18,2)").alias("net_amount"),
        "transaction_timestamp",
        "transaction_date",
    )


def fact_lookup(fact: DataFrame, customer_key: Column, product_key: Column, day: Day) -> DataFrame:
    """One customer's purchases of one product on one day: partition and sort keys do the work."""
    return on_days(fact, "transaction_date", day).where(
        (F.col("customer_key") == customer_key) & (F.col("product_key") == product_key)
    )


def orphan_check(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys used by facts but absent from the dimension, with their row counts.

    Facts are counted per key first, so the anti join moves one row per key.
    """
    used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return used.join(dimension.select(key), key, "left_anti")
