"""Composed loads. Each takes a day or a range of days and can be run again with the same result."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from salesmart.functions.dates import calendar, date_series_of, month_start
from salesmart.operators import quality, star
from salesmart.operators.incremental import merge_days
from salesmart.operators.transform import (
    PIVOT_CATEGORIES, daily_summary, on_days, order_day_summary, transform_positive, transform_sales,
)
from salesmart.plans.reports import daily_sales_report
from salesmart.session import drops_copies, freed_shuffles, settle
from salesmart.sources.files import dated_path, read_staging_csv, require_filled
from salesmart.sources.schemas import ORDER_LINES_RAW, required_columns
from salesmart.sources.tables import (
    distinct_values, export_table, is_one_of, overwrite_partitions, reload_days, replace_from_itself, table_exists, upsert_days, write_truncate,
)

Bound = date | str | None
MONTH = "partition_month"


@drops_copies
def merge_into(
    spark: SparkSession, path: str, source: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], settled: bool = False,
) -> DataFrame:
    """Apply ``merge(target, source)`` to the table at ``path``, or to an empty one on the first load.

    The source is settled first (``settled``: the caller has done so), so that it does not read the table it changes.
    """
    source = source if settled else settle(source, "source")
    if table_exists(spark, path):
        replace_from_itself(merge(spark.read.parquet(path), source), path)
    else:
        empty = source.where(F.lit(False))
        write_truncate(merge(empty, source), path)
    return spark.read.parquet(path)


def store(
    rows: DataFrame, path: str, day: str, first: Bound, last: Bound, cluster_by: list[str], partition_unit: str, settled: bool = False,
) -> DataFrame:
    """Reload ``first``..``last`` (or everything) and return that range of the stored table.

    ``partition_unit`` is ``day``, or ``month`` for tables with few rows per day: there the months
    that the range touches are written anew, with the stored rows of their other days.
    """
    spark = rows.sparkSession
    if first is not None and last is None:
        last = first
    if first is None and last is None:
        written, name = (rows, day) if partition_unit == "day" else (_by_month(rows, day), MONTH)
        write_truncate(written, path, [name], [day, *cluster_by])
    elif partition_unit == "day":
        reload_days(rows, path, day, first, last, cluster_by, settled)
    else:
        months = [bound if bound is None else f"{str(bound)[:7]}-01" for bound in (first, last)]
        if table_exists(spark, path):
            stored = spark.read.schema(_by_month(rows, day).schema).parquet(path)
            others = on_days(stored, MONTH, *months) if months[0] != months[1] else on_days(stored, MONTH, months[0])
            inside = F.lit(True)
            inside = inside if first is None else inside & (F.col(day) >= F.lit(first).cast("date"))
            inside = inside if last is None else inside & (F.col(day) <= F.lit(last).cast("date"))
            rows = others.where(~inside).select(*rows.columns).unionByName(rows)
        reload_days(_by_month(rows, day), path, MONTH, *months, [day, *cluster_by], settled)
    return on_days(spark.read.schema(rows.schema).parquet(path), day, first, last)


def _by_month(rows: DataFrame, day: str) -> DataFrame:
    return rows.withColumn(MONTH, month_start(F.col(day)))


def read_by_day(spark: SparkSession, path: str, schema: StructType, day: str, partition_unit: str) -> Callable[..., DataFrame]:
    """A reader of a table in day or month partitions: ``read(first, last)`` or ``read(some=days)``.

    Days are literals in the filter on the partition column, so only their partitions are listed and read.
    """
    by_month = partition_unit != "day"
    held = StructType([*schema, StructField(MONTH, DateType())]) if by_month else schema

    def read(first: Bound = None, last: Bound = None, *, some: list[date | None] | None = None) -> DataFrame:
        rows = spark.read.schema(held).parquet(path)
        if some is not None:
            if by_month:
                rows = rows.where(is_one_of(F.col(MONTH), list({d and d.replace(day=1) for d in some})))
            return rows.where(is_one_of(F.col(day), some)).select(*schema.names)
        if by_month:
            months = [bound if bound is None else f"{str(bound)[:7]}-01" for bound in (first, last)]
            rows = on_days(rows, MONTH, *months)
        return on_days(rows, day, first, last).select(*schema.names)

    return read


@drops_copies
def run_datamart(
    staging: DataFrame, root: str, first: Bound = None, last: Bound = None, *, run_ts: datetime | None = None,
    categories: tuple[str, ...] = PIVOT_CATEGORIES, strict: bool = True, partition_unit: str = "day",
) -> DataFrame:
    """Staging to clean lines to daily summary to quality gate; returns the summary table.

    The clean lines are written once and their quality is counted in that pass. The summary is published
    when the gate has passed: a failed run leaves the old one.
    """
    clean = quality.watch(transform_sales(staging, first, last, run_ts))
    store(clean.rows, f"{root}/sales_cleaned", "order_date", first, last, ["category", "customer_id"], partition_unit, settled=True)
    summary = settle(daily_summary(clean.rows, categories, run_ts, settled=True), "summary")
    if strict:
        quality.enforce_metrics(clean.metrics(summary))
    return merge_into(
        staging.sparkSession, f"{root}/daily_sales_summary", summary, partial(merge_days, on="report_date"), settled=True
    )


@drops_copies
def run_star_schema(
    customers: DataFrame, products: DataFrame, transactions: DataFrame, root: str, first: Bound = None,
    last: Bound = None, *, run_ts: datetime | None = None, days: DataFrame | None = None, partition_unit: str = "day",
    span: tuple[str, str] = ("1900-01-01", "2100-12-31"),
) -> DataFrame:
    """Dimensions, fact, fact gate and daily report; returns the report table.

    Transactions are put into the fact under their own day. Those of ``first``..``last`` (or of all
    days) must be there for the gate to pass; earlier ones among them are late and are added to what
    their day holds already, and later ones wait for their run. A transaction that is loaded again
    replaces itself, so runs can be repeated and files can overlap; within a file the latest row of a transaction
    counts. The reports of all touched days are made anew, from the partitions of these days alone. ``days``
    is the calendar to fill in; by default it spans the days of the transactions. A day outside ``span``
    fails the run before anything of the fact is stored.
    """
    spark = transactions.sparkSession
    last = first if last is None else last
    path, day, rows = f"{root}/fact_sales", "transaction_date", star.fact_sales(transactions, None, last)
    with freed_shuffles(spark):
        dim_customer = merge_into(
            spark, f"{root}/dim_customer", star.dim_customer(customers, run_ts), partial(star.scd1_customer, settled=True))
        dim_product = merge_into(spark, f"{root}/dim_product", star.dim_product(products, run_ts), partial(star.scd1_product, settled=True))
        quality.require_unique(dim_customer, "customer_key")
        quality.require_unique(dim_product, "product_key")

        touched = _upsert_sales(rows, path, day, partition_unit, span)
        stored = read_by_day(spark, path, rows.schema, day, partition_unit)
        quality.require_pass(quality.validate_fact_count(stored(first, last)), "validation", quality.VALIDATION_PASSED)

        if days is None:
            days = calendar(date_series_of(spark.createDataFrame([(d,) for d in touched], StructType([rows.schema[day]])), F.col(day)))
        dim_date = merge_into(spark, f"{root}/dim_date", days, star.dim_date_fill)
        report = daily_sales_report(stored(some=touched), dim_date, run_ts=run_ts, settled=True, told_apart=True)
        return merge_into(spark, f"{root}/daily_sales_report", report, partial(merge_days, on="full_date"))


@drops_copies
def _upsert_sales(rows: DataFrame, path: str, day: str, partition_unit: str, span: tuple[str, str]) -> list[date | None]:
    """Put a load's sales into the fact; return their days.

    The file is parsed once, into a copy sorted by day, of which every step of the upsert reads its days and picks its rows.
    """
    batch, keys = settle(rows.sortWithinPartitions(day), "batch", "zstd"), ["customer_key", "product_key"]
    touched = distinct_values(batch, day)  # the days of one load
    outside = sorted(str(d) for d in touched if d is not None and not span[0] <= str(d) <= span[1])
    if outside:
        raise quality.QualityError(f"sales outside {span[0]}..{span[1]}: {outside[:10]}")
    parts = ([day, *keys], month_start(F.col(day)), MONTH) if partition_unit != "day" else (keys,)
    upsert_days(batch, path, day, star.FACT_IDENTITY, *parts, newest=star.FACT_NEWEST, settled=True, picked=False)
    return touched


@drops_copies
def run_file_etl(
    spark: SparkSession, source: str, root: str, run_date: str, *, max_rows: int, run_ts: datetime | None = None,
    export_to: str = "reports/daily_summary_{ds}",
) -> DataFrame:
    """Load the day's order-line file, check, clean, summarise, reconcile, export; returns the summary.

    ``max_rows`` is the most lines a day's file may hold; a larger one fails the staging gate.
    A file may hold several order dates. The summary of each date it touches is recomputed from all
    loads, not only from this one.
    """
    sales_path, summary_path = f"{root}/sales", f"{root}/order_day_summary"
    raw = read_staging_csv(spark, dated_path(source, run_date), ORDER_LINES_RAW)
    staging = settle(require_filled(raw, required_columns(ORDER_LINES_RAW)), "staging")  # text is parsed once
    quality.require_pass(quality.validate_staging(staging, max_rows), "validation_result", quality.VALIDATION_PASSED)

    loaded = transform_positive(staging, run_date, run_ts)
    overwrite_partitions(loaded, sales_path, ["partition_date"], ["order_date"])
    sales = spark.read.schema(loaded.schema).parquet(sales_path)
    today = sales.where(F.col("partition_date") == run_date)
    touched = [d for d in distinct_values(today, "order_date") if d is not None]  # the days of one load
    summary = order_day_summary(sales.where(is_one_of(F.col("order_date"), touched)), run_ts, settled=True)
    result = merge_into(spark, summary_path, summary, partial(merge_days, on="order_date"))

    quality.require_pass(quality.reconcile_counts(staging, today), "result", quality.QUALITY_CHECK_PASSED)
    export_table(result, f"{root}/{dated_path(export_to, run_date)}")
    return result
