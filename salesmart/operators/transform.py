"""Staging to clean order lines, and their daily summaries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.functions import rules
from salesmart.functions.dates import COMPACT_DATE, is_weekend, parse_day
from salesmart.functions.money import as_doubles, average_of, mean, money, percent
from salesmart.functions.totals import totals_and_distincts
from salesmart.sources.tables import add_audit

# Category names of the default pivot and the summary columns they fill.
PIVOT_CATEGORIES = ("Electronics", "Fashion", "Home")

Day = date | str | Column


def on_days(df: DataFrame, column: str, first: Day | None, last: Day | None = None) -> DataFrame:
    """Keep one day, or the closed range ``first``..``last``; no bounds keep everything."""
    if first is None and last is None:
        return df
    if last is None:
        return df.where(F.col(column) == _as_day(first))
    if first is None:
        return df.where(F.col(column) <= _as_day(last))
    return df.where(F.col(column).between(_as_day(first), _as_day(last)))


def on_moments(df: DataFrame, column: str, first: Day | None, last: Day | None = None) -> DataFrame:
    """As :func:`on_days`, for a timestamp column: a plain range on it, which the scan can use."""
    if first is None and last is None:
        return df
    last = first if last is None else last
    rows = df if first is None else df.where(F.col(column) >= _as_day(first))
    return rows.where(F.col(column) < F.date_add(_as_day(last), 1))


def _as_day(value: Day) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def transform_sales(
    staging: DataFrame, first: Day | None = None, last: Day | None = None, run_ts: datetime | Column | None = None,
) -> DataFrame:
    """Clean and classify order lines: 15 columns, rows without a key are left out."""
    total, discount = F.col("total_amount"), F.col("discount_amount")
    lines = on_days(staging.withColumn("order_date", parse_day(staging, "order_date")), "order_date", first, last)
    lines = (
        lines.dropna(subset=["order_id", "customer_id", "product_id"])
        .withColumn("total_amount", money("total_amount"))
        .withColumn("discount_amount", money("discount_amount"))
    )
    return add_audit(
        lines.select(
            "order_id", "customer_id", "product_id", "product_name", "category", "quantity", "unit_price",
            "total_amount", "discount_amount",
            (total - discount).cast("decimal(18,2)").alias("net_amount"),
            F.when(total > 0, percent(discount, total)).otherwise(F.lit(0)).cast("decimal(18,2)").alias("discount_percentage"),
            rules.order_size(total).alias("order_size_category"),
            "order_date",
            rules.quality_flag(
                F.col("quantity"), F.col("unit_price"), total, discount, F.col("product_name"), F.col("category")
            ).alias("data_quality_flag"),
        ),
        "processed_at", run_ts,
    )


def category_column(category: str) -> str:
    return category.lower().replace(" ", "_") + "_sales"


def size_column(size: str) -> str:
    return size.lower().replace(" ", "_") + "_orders_count"


def daily_summary(
    clean: DataFrame, categories: tuple[str, ...] = PIVOT_CATEGORIES, run_ts: datetime | Column | None = None, settled: bool = False,
) -> DataFrame:
    """One row per order date: counts, money, category pivot, size spread and quality score.

    The rows are read twice and therefore settled first (``settled``: the caller has done so).
    """
    net = F.col("net_amount")
    sizes = [*[label for label, _ in rules.ORDER_SIZES], rules.LARGEST_ORDER]
    is_valid = F.col("data_quality_flag") == rules.VALID
    totals = [
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_amount").alias("gross_sales"),
        F.sum("discount_amount").alias("total_discounts"),
        F.sum(net).alias("net_sales"),
        average_of(net).alias("avg_order_value"),
        average_of(F.col("discount_percentage")).alias("avg_discount_percentage"),
        *[F.sum(F.when(F.col("category") == c, net).otherwise(0)).alias(category_column(c)) for c in categories],
        *[F.count_if(F.col("order_size_category") == s).alias(size_column(s)) for s in sizes],
        F.count_if(is_valid).alias("valid_records_count"),
        F.count_if(~is_valid).alias("invalid_records_count"),
        percent(F.count_if(is_valid), F.count(F.lit(1))).alias("data_quality_score"),
    ]
    distinct = {"total_orders": "order_id", "unique_customers": "customer_id", "unique_products": "product_id"}
    used = [*distinct.values(), "category", "quantity", "total_amount", "discount_amount", "net_amount", "discount_percentage",
            "order_size_category", "data_quality_flag"]
    rows = clean.select(F.col("order_date").alias("report_date"), *used)
    report = totals_and_distincts(rows, ["report_date"], totals, distinct, apart=True, settled=settled)
    return add_audit(as_doubles(report), "generated_at", run_ts)


def transform_positive(
    staging: DataFrame, run_date: Day, run_ts: datetime | Column | None = None,
) -> DataFrame:
    """Order lines with positive amount and quantity, typed date, load time and load day."""
    kept = staging.where((F.col("total_amount") > 0) & (F.col("quantity") > 0) & F.col("order_id").isNotNull())
    typed = kept.select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", money("total_amount").alias("total_amount"),
        parse_day(kept, "order_date", COMPACT_DATE).alias("order_date"),
    )
    load_day = run_date if isinstance(run_date, Column) else F.lit(str(run_date))
    return add_audit(typed, "ingestion_timestamp", run_ts).withColumn("partition_date", load_day)


def order_day_summary(sales: DataFrame, run_ts: datetime | Column | None = None, settled: bool = False) -> DataFrame:
    """Ten-column summary per order date of the file load (``settled``: the sales are a stored table, which is read twice)."""
    total = F.col("total_amount")
    totals = [
        F.sum("quantity").alias("total_quantity"),
        F.sum(total).alias("total_sales"),
        average_of(total).alias("avg_order_value"),
        F.min(total).alias("min_order_value"),
        F.max(total).alias("max_order_value"),
    ]
    distinct = {"total_orders": "order_id", "unique_customers": "customer_id", "unique_products": "product_id"}
    used = ["order_date", *distinct.values(), "quantity", "total_amount"]
    report = totals_and_distincts(sales.select(*used), ["order_date"], totals, distinct, apart=True, settled=settled)
    return add_audit(as_doubles(report), "updated_at", run_ts)


def sales_by_day(sales: DataFrame) -> DataFrame:
    """Row count, quantity and money per order date, newest day first."""
    amount = money("total_amount")
    return as_doubles(
        sales.groupBy("order_date").agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("quantity").alias("total_quantity"),
            F.sum(amount).alias("total_sales"),
            average_of(amount).alias("avg_order_value"),
        )
    ).orderBy(F.desc("order_date"))


def sales_totals(transactions: DataFrame) -> DataFrame:
    """Gross, discount, net and mean net amount of a whole file."""
    sums = transactions.agg(
        F.sum(money("total_amount")).alias("gross_sales"),
        F.sum(money("discount_amount")).alias("total_discounts"),
        F.count(F.lit(1)).alias("transactions"),
    )
    net = F.col("gross_sales") - F.col("total_discounts")
    return as_doubles(
        sums.select(
            "gross_sales", "total_discounts", net.alias("net_sales"), mean(net, F.col("transactions")).alias("avg_transaction"),
        )
    )


def sales_performance(sales: DataFrame, by: list[str]) -> DataFrame:
    """Sales, transactions and rounded mean per group, with a performance tier and a stock advice."""
    grouped = sales.groupBy(*by).agg(
        F.sum(money("total_amount")).alias("total_sales"), F.count(F.lit(1)).alias("transaction_count"),
    )
    total = F.col("total_sales")
    mean_sale = F.round(total.cast("decimal(22,2)") / F.nullif(F.col("transaction_count"), F.lit(0)), 2)
    return as_doubles(
        grouped.select(
            *by, "total_sales", "transaction_count", mean_sale.alias("avg_transaction"),
            rules.performance_tier(total).alias("performance"), rules.stock_advice(total).alias("recommendation"),
        )
    )


def stage_customers(raw: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    """Recently created customers with upper-cased names."""
    return raw.where(F.col("created_at") >= F.date_sub(_as_day(as_of), days)).select(
        "customer_id", F.upper("customer_name").alias("customer_name"), "email", "created_at",
    )


def window_filter(df: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """Rows in the half-open time window ``[start, end)``."""
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def with_tax(df: DataFrame, price: str = "price", rate: str = "0.18") -> DataFrame:
    """Add ``price_with_tax``; the rate is decimal text so that the product is exact."""
    return df.withColumn("price_with_tax", rules.price_with_tax(money(price), F.lit(rate).cast("decimal(6,4)")))


def day_type(day: Column) -> Column:
    return F.when(is_weekend(day), "Weekend").otherwise("Weekday")
