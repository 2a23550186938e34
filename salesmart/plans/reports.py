"""Reports over the star schema and over the clean order lines.

Each report reads the facts once. Where no distinct count needs the single rows, facts are reduced
to one row per dimension key before a dimension is joined. Dimensions are cut to the columns needed;
the order of the joins and their strategy are left to the planner, which broadcasts a small dimension
and splits a key with very many facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from salesmart.functions import rules
from salesmart.functions.dates import date_series_of
from salesmart.functions.money import as_doubles, average_of, mean, percent
from salesmart.functions.totals import totals_and_distincts
from salesmart.operators.transform import Day, on_days
from salesmart.sources.tables import add_audit, distinct_values, partition_values


def _with_calendar(fact: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    return fact.join(dim_date.select("date_key", *columns), "date_key")


def daily_sales_report(
    fact: DataFrame, dim_date: DataFrame, day: Day | None = None, run_ts=None, *, settled: bool = False, told_apart: bool = False,
) -> DataFrame:
    """Fourteen-column report per calendar day (one day, or all days).

    ``settled``: the fact is a stored table, which is read twice. ``told_apart``: no day holds a transaction id
    twice, as in a table that ``upsert_days`` keeps, so that ids are counted without being compared.
    """
    net = F.col("net_amount")
    days = on_days(dim_date, "full_date", day)
    totals = [
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_amount").alias("total_sales"),
        F.sum("discount_amount").alias("total_discounts"),
        F.sum(net).alias("net_sales"),
        average_of(net).alias("avg_transaction_value"),
        F.min(net).alias("min_transaction"),
        F.max(net).alias("max_transaction"),
    ]
    distinct = {"total_transactions": "transaction_id", "unique_customers": "customer_key", "unique_products": "product_key"}
    used = ["date_key", *distinct.values(), "quantity", "total_amount", "discount_amount", "net_amount"]
    columns = [*distinct, "total_quantity", "total_sales", "total_discounts", "net_sales", "avg_transaction_value", "min_transaction",
               "max_transaction"]
    if told_apart:
        totals.append(F.count(distinct.pop("total_transactions")).alias("total_transactions"))
    rows = on_days(fact, "transaction_date", day).select(*used)
    per_day = totals_and_distincts(rows, ["date_key"], totals, distinct, apart=True, settled=settled)
    named = ["full_date", "day_name", "is_weekend"]
    report = _with_calendar(per_day, days, *named).select(*named, *columns)
    return add_audit(as_doubles(report), "report_generated_at", run_ts)


def top_customers(fact: DataFrame, dim_customer: DataFrame, rows: int = 10) -> DataFrame:
    """Customers with the highest lifetime value."""
    per_customer = fact.groupBy("customer_key").agg(
        F.count_distinct("transaction_id").alias("total_orders"),
        F.sum("quantity").alias("total_items_purchased"),
        F.sum("net_amount").alias("lifetime_value"),
        average_of(F.col("net_amount")).alias("avg_order_value"),
        F.min("transaction_date").alias("first_purchase_date"),
        F.max("transaction_date").alias("last_purchase_date"),
    )
    who = ["customer_id", "customer_name", "city", "country"]
    named = per_customer.join(dim_customer.select("customer_key", *who), "customer_key")
    return as_doubles(
        named.select(*who, *[c for c in per_customer.columns if c != "customer_key"])
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .limit(rows)
    )


def top_spenders(fact: DataFrame, dim_customer: DataFrame, rows: int = 10, by: tuple[str, ...] = ("customer_name", "city", "country")) -> DataFrame:
    """Highest spending per customer name and place; counts fact rows, not distinct transactions."""
    net = F.col("net_amount")
    per_key = fact.groupBy("customer_key").agg(
        F.count("transaction_id").alias("n"), F.sum(net).alias("spent"), F.count(net).alias("filled"),
    )
    return as_doubles(
        per_key.join(dim_customer.select("customer_key", *by), "customer_key")
        .groupBy(*by)
        .agg(
            F.sum("n").alias("order_count"),
            F.sum("spent").alias("total_spent"),
            mean(F.sum("spent"), F.sum("filled")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_spent"), *by)
        .limit(rows)
    )


def category_sales(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Sales and discount rate per category and subcategory, best net sales first."""
    groups = ["category", "subcategory"]
    named = fact.join(dim_product.select("product_key", *groups), "product_key")
    totals = [
        F.sum("quantity").alias("units_sold"),
        F.sum("total_amount").alias("gross_sales"),
        F.sum("discount_amount").alias("total_discounts"),
        F.sum("net_amount").alias("net_sales"),
        percent(F.sum("discount_amount"), F.sum("total_amount")).alias("discount_rate_pct"),
    ]
    return as_doubles(totals_and_distincts(named, groups, totals, {"order_count": "transaction_id"})).orderBy(F.desc("net_sales"), *groups)


def category_lines(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Short form of :func:`category_sales` that counts fact rows."""
    groups = ["category", "subcategory"]
    per_product = fact.groupBy("product_key").agg(
        F.count("transaction_id").alias("n"), F.sum("quantity").alias("q"),
        F.sum("net_amount").alias("net"), F.sum("discount_amount").alias("disc"),
    )
    return as_doubles(
        per_product.join(dim_product.select("product_key", *groups), "product_key")
        .groupBy(*groups)
        .agg(
            F.sum("n").alias("order_count"), F.sum("q").alias("total_quantity"),
            F.sum("net").alias("net_sales"), F.sum("disc").alias("total_discounts"),
        )
    ).orderBy(F.desc("net_sales"), *groups)


def monthly_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly sales with the previous month's sales and the growth in percent.

    The window runs over one row per month.
    """
    totals = [
        F.sum("quantity").alias("total_units"),
        F.sum("net_amount").alias("net_sales"),
        average_of(F.col("net_amount")).alias("avg_transaction_value"),
    ]
    months = totals_and_distincts(
        _with_calendar(fact, dim_date, "year", "month", "month_name"), ["year", "month", "month_name"], totals,
        {"total_transactions": "transaction_id", "unique_customers": "customer_key"},
    )
    previous = F.lag("net_sales").over(Window.orderBy("year", "month"))
    trend = months.withColumn("prev_month_sales", previous)
    growth = percent(F.col("net_sales") - F.col("prev_month_sales"), F.col("prev_month_sales"))
    return as_doubles(trend.withColumn("mom_growth_pct", growth)).orderBy("year", "month")


def weekend_vs_weekday(fact: DataFrame, dim_date: DataFrame, year: int | Column | None = None) -> DataFrame:
    """Weekend against weekday sales, over everything or one year."""
    days = dim_date if year is None else dim_date.where(F.col("year") == year)
    kind = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    totals = [
        F.sum("net_amount").alias("net_sales"),
        average_of(F.col("net_amount")).alias("avg_transaction_value"),
        average_of(F.col("quantity")).alias("avg_items_per_order"),
    ]
    typed = _with_calendar(fact, days, "is_weekend").withColumn("day_type", kind)
    return as_doubles(totals_and_distincts(typed, ["day_type"], totals, {"total_transactions": "transaction_id"}))


def geo_sales(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Sales per country and city with the city's rank inside its country."""
    place = ["country", "city"]
    named = fact.join(dim_customer.select("customer_key", *place), "customer_key")
    totals = [F.sum("net_amount").alias("total_sales"), average_of(F.col("net_amount")).alias("avg_order_value")]
    distinct = {"unique_customers": "customer_key", "total_orders": "transaction_id"}
    rank = F.rank().over(Window.partitionBy("country").orderBy(F.desc("total_sales"))).cast("bigint")
    ranked = totals_and_distincts(named, place, totals, distinct).withColumn("city_rank_in_country", rank)
    return as_doubles(ranked).orderBy(F.desc("total_sales"), *place)


def discount_effectiveness(fact: DataFrame) -> DataFrame:
    """Orders, averages and revenue per discount bucket, in bucket order."""
    bucket = rules.discount_bucket(F.col("discount_amount"), F.col("total_amount"))
    totals = [
        average_of(F.col("quantity")).alias("avg_items_per_order"),
        average_of(F.col("total_amount")).alias("avg_gross_order_value"),
        average_of(F.col("net_amount")).alias("avg_net_order_value"),
        F.sum("discount_amount").alias("total_discount_given"),
        F.sum("net_amount").alias("total_revenue"),
    ]
    bucketed = fact.withColumn("discount_bucket", bucket)
    return as_doubles(
        totals_and_distincts(bucketed, ["discount_bucket"], totals, {"order_count": "transaction_id"})
    ).orderBy(rules.discount_bucket_rank(F.col("discount_bucket")))


def category_sales_clean(clean: DataFrame) -> DataFrame:
    """Order lines, net sales and mean discount per category of the clean table."""
    return as_doubles(
        clean.groupBy("category").agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("net_amount").alias("total_sales"),
            average_of(F.col("discount_percentage")).alias("avg_discount_pct"),
        )
    ).orderBy(F.desc("total_sales"), "category")


def read_newest_days(spark: SparkSession, path: str, partition: str, day: str, days: int) -> DataFrame:
    """The rows of the newest ``days`` days of a table that is partitioned by something coarser, such as the month.

    Partition names tell which are the newest: no other partition is looked into.
    """
    names, taken = sorted(partition_values(spark, path, partition), reverse=True), 1
    while True:
        newest = spark.read.parquet(path).where(F.col(partition).cast("string").isin(names[:taken]))
        found = sorted(d for d in distinct_values(newest, day) if d is not None)[-days:]
        if len(found) == days or taken >= len(names):
            return newest.where(F.col(day).isin(found)).drop(partition)
        taken *= 2


def latest_reports(report: DataFrame, day: str, rows: int = 7) -> DataFrame:
    """The newest ``rows`` days of a report."""
    return report.orderBy(F.desc(day)).limit(rows)


def quality_history(summary: DataFrame, rows: int = 30) -> DataFrame:
    columns = ["report_date", "data_quality_score", "valid_records_count", "invalid_records_count"]
    return latest_reports(summary.select(*columns), "report_date", rows)


def daily_net_series(fact: DataFrame, as_of: Column, years: int = 2, fill_gaps: bool = True) -> DataFrame:
    """Net sales per day over the last years; days without sales show as zero."""
    recent = fact.where(F.col("transaction_date") >= F.add_months(as_of, -12 * years))
    series = recent.groupBy(F.col("transaction_date").alias("date")).agg(F.sum("net_amount").alias("net_sales"))
    if fill_gaps:
        days = date_series_of(series, F.col("date")).withColumnRenamed("full_date", "date")
        series = days.join(series, "date", "left").select("date", F.coalesce("net_sales", F.lit(0)).alias("net_sales"))
    return as_doubles(series).orderBy("date")


def approx_customers(fact: DataFrame) -> DataFrame:
    """Approximate distinct customers per day: one small sketch per day instead of all keys."""
    return fact.groupBy("transaction_date").agg(F.approx_count_distinct("customer_key").alias("customers"))
