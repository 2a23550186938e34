"""The given TPC-H-like tables seen as the sales model's staging tables and star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesmart.functions.dates import calendar, date_series_of
from salesmart.functions.money import money
from salesmart.operators import star

# Days between which the incremental examples split the data; all rows are used on one side or the other.
EARLY_END, FIT_END = "1995-07-01", "1997-01-01"
LATE_START, DAY_BEFORE_LATE = "2001-01-01", "2000-12-31"
LOAD_DAY, DAY_BEFORE_LOAD = "2001-08-01", "2001-07-31"
EVENTS_CUT = "2024-01-15"
EVENTS_LAST_DAYS = "2024-01-28"
CATEGORIES = ("STANDARD", "ECONOMY", "MEDIUM", "PROMO", "SMALL", "LARGE")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows of a small table dealt out where its files give fewer tasks than there are cores.

    A file of one row group is one task, which would do all the work that follows without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = df._jdf.queryExecution().toRdd().getNumPartitions()  # df.rdd would make a Python RDD for it
    return df.repartition(cores) if tasks < cores else df


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their order's customer and day: the raw material of staging and fact."""
    return _as_text(_order_lines(spark, sf))


def _as_text(lines: DataFrame) -> DataFrame:
    return lines.withColumns({c: F.col(c).cast("string") for c in ("order_id", "customer_id")})


def _order_lines(spark: SparkSession, sf: str) -> DataFrame:
    total = money("l_extendedprice")
    orders = table(spark, sf, "orders")
    return spread(table(spark, sf, "lineitem")).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("p_partkey"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.try_divide(total.cast("double"), F.col("l_quantity")).alias("unit_price"),
        total.alias("total_amount"),
        F.round(total * F.col("l_discount").cast("decimal(4,2)"), 2).cast("decimal(18,2)").alias("discount_amount"),
        F.col("o_orderdate").alias("moment"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )


def order_items(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order and product, with a key of its own: lines of the same product are added up.

    Keys are numbers until then, so that lines which were joined by order lie together for this already.
    """
    keys = ["order_id", "customer_id", "p_partkey", "moment", "priority", "status"]
    items = _order_lines(spark, sf).groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"), F.sum("total_amount").cast("decimal(18,2)").alias("total_amount"),
        F.sum("discount_amount").cast("decimal(18,2)").alias("discount_amount"),
    )
    price = F.try_divide(F.col("total_amount").cast("double"), F.col("quantity"))
    return _as_text(items).withColumn("item_id", F.concat_ws("-", "order_id", "p_partkey")).withColumn("unit_price", price)


def staging_items(spark: SparkSession, sf: str) -> DataFrame:
    """As :func:`staging_sales`, with a row per order and product."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return order_items(spark, sf).join(parts, "p_partkey").select(
        F.col("item_id").alias("order_id"), "customer_id", F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        "quantity", "unit_price", "total_amount", "discount_amount", F.to_date("moment").alias("order_date"),
    )


def staging_sales(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return order_lines(spark, sf).join(parts, "p_partkey").select(
        "order_id", "customer_id", F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        "quantity", "unit_price", "total_amount", "discount_amount", F.to_date("moment").alias("order_date"),
    )


def transactions_raw(spark: SparkSession, sf: str) -> DataFrame:
    return order_lines(spark, sf).select(
        F.col("order_id").alias("transaction_id"), "customer_id", F.col("p_partkey").cast("string").alias("product_id"),
        "quantity", "unit_price", "total_amount", "discount_amount", F.col("moment").alias("transaction_timestamp"),
    )


def customers_raw(spark: SparkSession, sf: str) -> DataFrame:
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        table(spark, sf, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            F.lit("1994-12-31").alias("created_date"),
        )
    )


def products_raw(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"), F.col("p_retailprice").alias("unit_price"),
    )


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return star.fact_sales(transactions_raw(spark, sf))


def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_customer(customers_raw(spark, sf), day_start(LOAD_DAY))


def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_product(products_raw(spark, sf), day_start(LOAD_DAY))


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar from the first to the last order day."""
    return calendar(date_series_of(table(spark, sf, "orders"), F.to_date("o_orderdate")))


def last_order_day(spark: SparkSession, sf: str) -> Column:
    return table(spark, sf, "orders").agg(F.to_date(F.max("o_orderdate"))).scalar()


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("day", F.to_date("ts"))


def event_sales(events_df: DataFrame) -> DataFrame:
    """Events read as transactions of one unit each."""
    return events_df.select(
        F.col("event_id").cast("string").alias("transaction_id"), F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("product_id"), F.lit(1).alias("quantity"), F.col("value").alias("unit_price"),
        F.col("value").alias("total_amount"), F.lit(0).alias("discount_amount"), F.col("ts").alias("transaction_timestamp"),
    )


def event_changes(events_df: DataFrame) -> DataFrame:
    """Events read as a change feed on users."""
    op = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    return events_df.select("user_id", "event_type", "value", "ts", "event_id", op.alias("op"))


def day_start(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")
