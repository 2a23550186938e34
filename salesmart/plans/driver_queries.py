"""Every operator as a query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from salesmart.functions import rules
from salesmart.functions.dates import date_series_of, month_start
from salesmart.functions.keys import surrogate_key
from salesmart.functions.money import as_doubles, money
from salesmart.operators import daycounts, history, incremental, merge, quality, star, transform
from salesmart.plans import analytics, driver_tables as t, models, pipelines, reports
from salesmart.session import drops_copies, freed_shuffles, scratch_path, settle
from salesmart.sources import arrivals, clustered, files, tables
from salesmart.sources.schemas import CUSTOMERS_RAW, ORDER_LINES_RAW, PRODUCTS_RAW, SALES_RAW, TRANSACTIONS_RAW
from salesmart.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return transform.transform_sales(t.staging_sales(spark, sf)).drop("processed_at")


def _per_event_day(df: DataFrame) -> DataFrame:
    """Row count and exact value sum per day of an events-like table."""
    return as_doubles(df.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total")))


# --- sources -------------------------------------------------------------------------------------


@query
def read_staging_csv(spark, sf):
    path = scratch_path(spark, "staging")
    tables.export_table(t.staging_sales(spark, sf), path, "csv")
    schema = StructType([f for f in SALES_RAW if f.name != "loaded_at"])
    return files.read_staging_csv(spark, path, schema)


@query
def read_staging_csv_infer(spark, sf):
    path = scratch_path(spark, "products")
    tables.export_table(t.products_raw(spark, sf), path, "csv")
    return files.read_staging_csv(spark, path, infer=True).withColumn("product_id", F.col("product_id").cast("string"))


@query
def read_staging_json(spark, sf):
    path = scratch_path(spark, "customers")
    tables.export_table(t.customers_raw(spark, sf), path, "json")
    return files.read_staging_json(spark, path, CUSTOMERS_RAW)


@query
def read_staging_glob(spark, sf):
    path = scratch_path(spark, "products")
    t.products_raw(spark, sf).write.partitionBy("category").option("header", True).csv(path)
    schema = StructType([f for f in PRODUCTS_RAW if f.name != "category"])
    return files.read_staging_csv(spark, f"{path}/category=*/*.csv", schema)


@query
def load_files_by_name(spark, sf):
    schema = "o_orderkey bigint, c_custkey bigint, p_partkey bigint"
    loaded = files.load_files_by_name(
        spark, f"{sf}/{{orders,customer,part}}.parquet", schema, scratch_path(spark, "by_name"), "parquet"
    )
    keys = [F.sum(c).alias(f"sum_{c}") for c in ("o_orderkey", "c_custkey", "p_partkey")]
    return loaded.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"), *keys)


@query
def enforce_required(spark, sf):
    orders = t.table(spark, sf, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    )
    good, rejected = files.enforce_required(orders, ["o_orderkey", "priority"])
    return good.withColumn("accepted", F.lit(True)).unionByName(rejected.withColumn("accepted", F.lit(False)))


@query
def split_dead_letters(spark, sf):
    path = scratch_path(spark, "orders")
    amount = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(money("o_totalprice").cast("string"))
    t.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), amount.alias("amount")).write.option(
        "header", True
    ).csv(path)
    schema = StructType([StructField("order_id", LongType()), StructField("amount", DoubleType())])
    good, dead = files.split_dead_letters(spark, path, schema, "batch-1", t.day_start(t.LOAD_DAY))
    return good.withColumn("error_message", F.lit(None).cast("string")).unionByName(
        dead.select("error_message"), allowMissingColumns=True
    )


@query
def sample_rows(spark, sf):
    return files.sample_rows(
        t.staging_sales(spark, sf).withColumn("total_amount", F.col("total_amount").cast("double")),
        ["order_id", "product_id", "product_name", "total_amount", "order_date"], 10,
        [F.desc("total_amount"), "order_id", "product_id"],
    )


@query
def date_series(spark, sf):
    return date_series_of(t.table(spark, sf, "orders"), F.to_date("o_orderdate"))


@query
def parquet_handover(spark, sf):
    lines = settle(t.order_lines(spark, sf), "handover")
    return as_doubles(
        lines.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("total"))
    )


@query
def ingest_available_files(spark, sf):
    schema = t.table(spark, sf, "events").schema
    return _per_event_day(
        ingest.ingest_available_files(
            spark, f"{sf}/events*.parquet", schema, scratch_path(spark, "ingested"), scratch_path(spark, "progress"), "parquet"
        ).withColumn("day", F.to_date("ts"))
    )


# --- sinks and table upkeep ----------------------------------------------------------------------


@query
def ensure_table(spark, sf):
    schema = StructType([StructField("user_id", LongType()), StructField("event_type", StringType()),
                         StructField("value", DoubleType()), StructField("day", StringType())])
    path = scratch_path(spark, "ensured")
    name = "t_" + path.rsplit("-", 1)[1]
    for _ in range(2):  # the second call finds the table and leaves it alone
        tables.ensure_table(
            spark, name, schema, partition_by=["day"], cluster_by=["user_id"], comment="events per day",
            labels={"layer": "staging"}, location=path,
        )
    rows = t.events(spark, sf).select("user_id", "event_type", "value", F.col("day").cast("string").alias("day"))
    tables.arrange(rows, ["day"], ["user_id"]).write.insertInto(name)
    return _per_event_day(spark.table(name))


@query
def write_append(spark, sf):
    path = scratch_path(spark, "parties")
    for name, prefix in (("customer", "c"), ("supplier", "s")):
        rows = t.table(spark, sf, name).select(F.col(f"{prefix}_name").alias("name"), F.col(f"{prefix}_acctbal").alias("balance"))
        tables.write_append(rows, path)
    return spark.read.parquet(path)


@query
def write_truncate(spark, sf):
    path = scratch_path(spark, "parties")
    tables.write_truncate(t.table(spark, sf, "supplier").select(F.col("s_name").alias("name")), path)
    tables.write_truncate(t.table(spark, sf, "customer").select(F.col("c_name").alias("name")), path)
    return spark.read.parquet(path)


@query
def replace_from_itself(spark, sf):
    path = scratch_path(spark, "customers")
    tables.write_truncate(t.table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), path)
    table = spark.read.parquet(path)
    tables.replace_from_itself(table.withColumn("c_mktsegment", F.lower("c_mktsegment")), path)
    return spark.read.parquet(path)


@query
def write_if_empty(spark, sf):
    path = scratch_path(spark, "customers")
    customers = t.table(spark, sf, "customer").select("c_custkey", "c_name")
    tables.write_truncate(customers.where(F.lit(False)), path)
    tables.write_if_empty(customers, path)
    try:
        tables.write_if_empty(customers, path)
    except ValueError:
        return spark.read.parquet(path)
    raise AssertionError("a table with rows was written to")


@query
def overwrite_partitions(spark, sf):
    """Load all days, then reload the last ones with purchases only."""
    path = scratch_path(spark, "events_by_day")
    rows = t.events(spark, sf).select("day", "event_id", "event_type", "value")
    tables.overwrite_partitions(rows, path, ["day"], ["event_id"])
    reload = rows.where((F.col("day") >= F.lit(t.EVENTS_LAST_DAYS).cast("date")) & (F.col("event_type") == "purchase"))
    tables.overwrite_partitions(reload, path, ["day"], ["event_id"])
    return _per_event_day(spark.read.parquet(path))


@query
def export_table(spark, sf):
    path = scratch_path(spark, "summary")
    summary = transform.sales_by_day(t.staging_sales(spark, sf))
    tables.export_table(summary, path, "csv")
    return files.read_staging_csv(spark, path, summary.schema)


@query
def append_evolving(spark, sf):
    path = scratch_path(spark, "evolving")
    rows = t.events(spark, sf).select("event_id", "event_type", "value", "props")
    is_click = F.col("event_type") == "click"
    schema = tables.append_evolving(rows.where(is_click).drop("props"), path)
    schema = tables.append_evolving(rows.where(~is_click).drop("value"), path, schema)
    return tables.read_evolving(spark, path, schema)


@query
def expire_partitions(spark, sf):
    path = scratch_path(spark, "expiring")
    tables.overwrite_partitions(t.events(spark, sf).select("day", "value"), path, ["day"])
    newest = spark.read.parquet(path).agg(F.max("day")).first()[0]
    tables.expire_partitions(spark, path, "day", newest, 10)
    return _per_event_day(spark.read.parquet(path))


@query
def retained_rows(spark, sf):
    events = t.events(spark, sf)
    return _per_event_day(tables.retained(events, "day", incremental.freshest(events, "day"), 10))


@query
def read_partitioned(spark, sf):
    path = scratch_path(spark, "events_by_day")
    tables.overwrite_partitions(t.events(spark, sf).select("day", "value"), path, ["day"])
    return _per_event_day(tables.read_partitioned(spark, path, "day", "2024-01-10", "2024-01-20"))


@query
def add_audit(spark, sf):
    stamped = tables.add_audit(t.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "loaded_at", t.day_start(t.LOAD_DAY))
    return stamped.groupBy("o_orderstatus", F.to_date("loaded_at").alias("loaded_on")).agg(F.count(F.lit(1)).alias("n"))


@query
def union_sources(spark, sf):
    customers = t.table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.table(spark, sf, "supplier").select(F.col("s_name").alias("name"))
    return tables.union_sources(customers, suppliers)


@query
def refresh_daily_rollup(spark, sf):
    """A roll-up of clicks only, with the last days refreshed from all events, which are stored by day."""
    path = scratch_path(spark, "events_by_day")
    tables.overwrite_partitions(t.events(spark, sf).select("event_type", money("value").alias("value"), "day"), path, ["day"])
    rows = spark.read.parquet(path)
    stale = incremental.daily_rollup(rows.where("event_type = 'click'"), "day", "value")
    changed = rows.where(F.col("day") >= F.lit(t.EVENTS_CUT).cast("date"))
    return as_doubles(incremental.refresh_daily_rollup(stale, rows, changed, "day", "value"))


def _clustered(spark, sf, dimension: DataFrame, key: str):
    """The fact in buckets of a dimension's key, its last days appended, and the dimension in as many buckets."""
    path = scratch_path(spark, "clustered")
    name = "c_" + path.rsplit("-", 1)[1]
    fact = t.fact(spark, sf)
    late = F.col("transaction_date") >= F.lit(t.LATE_START).cast("date")
    facts = clustered.write_clustered(fact.where(~late), f"{name}_sales", key, f"{path}/sales")
    clustered.append_clustered(fact.where(late), clustered.open_clustered(spark, f"{name}_sales"))
    return facts, clustered.write_clustered(dimension, f"{name}_{key}", key, f"{path}/{key}", facts.buckets, unique=True)


@query
def clustered_customer_value(spark, sf):
    """Lifetime value of every customer from stored buckets."""
    facts, customers = _clustered(spark, sf, t.dim_customer(spark, sf), "customer_key")
    totals = [F.count(F.lit(1)).alias("transactions"), F.sum("net_amount").alias("net_sales"),
              F.min("transaction_date").alias("first_day"), F.max("transaction_date").alias("last_day")]
    value = clustered.totals_by_key(facts, customers, ["customer_id", "customer_name", "city", "country"], *totals)
    return as_doubles(value.drop("customer_key"))


@query
def clustered_product_sales(spark, sf):
    """Every sale joined to its product in stored buckets, and summed by kind of product."""
    facts, products = _clustered(spark, sf, t.dim_product(spark, sf).drop("unit_price"), "product_key")
    lines = clustered.join_clustered(facts, products)
    return as_doubles(lines.groupBy("category", "subcategory").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("quantity").alias("quantity"), F.sum("net_amount").alias("net_sales")))


# --- merge and history ---------------------------------------------------------------------------


def _ordered_before(spark, sf, day):
    orders = t.table(spark, sf, "orders").where(F.col("o_orderdate") < t.day_start(day))
    return orders.select(F.col("o_custkey").cast("string").alias("customer_id")).distinct()


def _ordered_since(spark, sf, day):
    orders = t.table(spark, sf, "orders").where(F.col("o_orderdate") >= t.day_start(day))
    return orders.select(F.col("o_custkey").cast("string").alias("customer_id")).distinct()


def _old_customers(spark, sf):
    """The customer dimension as first loaded: early customers, region as city, no e-mail."""
    early = t.customers_raw(spark, sf).join(_ordered_before(spark, sf, t.EARLY_END), "customer_id", "left_semi")
    early = early.withColumn("city", F.col("country")).withColumn("email", F.lit(None).cast("string"))
    return star.dim_customer(early, t.day_start(t.EARLY_END))


def _shown(dimension: DataFrame) -> DataFrame:
    """A dimension with its load moment as a day."""
    return dimension.withColumn("effective_date", F.to_date("effective_date"))


@query
def dim_date_fill(spark, sf):
    days = t.dim_date(spark, sf)
    loaded = days.where(F.col("full_date") < F.lit(t.EARLY_END).cast("date")).withColumn("is_holiday", F.lit(True))
    return star.dim_date_fill(loaded, days)


@query
def scd1_customer(spark, sf):
    """Customers of one nation are missing from the source; columns that are not updated differ in the target."""
    target = _old_customers(spark, sf).withColumn("is_current", F.lit(False)).withColumn("created_date", F.lit("1990-01-01").cast("date"))
    return _shown(star.scd1_customer(target, t.dim_customer(spark, sf).where("city <> 'FRANCE'")))


@query
def scd1_product(spark, sf):
    """Products of one type are missing from the source; columns that are not updated differ in the target."""
    sold = t.table(spark, sf, "lineitem").where(F.col("l_shipdate") < t.day_start(t.EARLY_END))
    sold = sold.select(F.col("l_partkey").cast("string").alias("product_id")).distinct()
    early = t.products_raw(spark, sf).join(sold, "product_id", "left_semi").withColumn("unit_price", F.lit(0.0))
    target = star.dim_product(early, t.day_start(t.EARLY_END)).withColumn("is_current", F.lit(False))
    return _shown(star.scd1_product(target, t.dim_product(spark, sf).where("category <> 'PROMO'")))


@query
def merge_daily_summary(spark, sf):
    """A ten-column summary with a piece too many in each line, the last half year of which is recomputed."""
    lines = t.order_lines(spark, sf).select(
        "order_id", "customer_id", F.col("p_partkey").alias("product_id"), "quantity", "total_amount",
        F.to_date("moment").alias("order_date"),
    )
    loaded = transform.order_day_summary(lines.withColumn("quantity", F.col("quantity") + 1)).drop("updated_at")
    fresh = transform.order_day_summary(transform.on_days(lines, "order_date", t.LATE_START, t.LOAD_DAY)).drop("updated_at")
    return incremental.merge_days(loaded, fresh, "order_date")


@query
def merge_newer_wins(spark, sf):
    """Users' last events. The target lacks those who signed up last, and is older only for those who purchased last."""
    events = t.table(spark, sf, "events").select("user_id", "event_type", "value", "ts", "event_id")
    source = history.latest_per_key(events, ["user_id"], ["ts", "event_id"])
    shift = F.when(F.col("event_type") == "purchase", F.expr("interval -1 day")).otherwise(F.expr("interval 1 day"))
    target = source.where("event_type <> 'signup'").withColumn("ts", F.col("ts") + shift).withColumn("value", F.lit(0.0))
    return merge.merge_newer_wins(target, source, "user_id", "ts", ["event_type", "value", "ts", "event_id"])


@query
def merge_soft_delete(spark, sf):
    recent = t.dim_customer(spark, sf).join(_ordered_since(spark, sf, t.LATE_START), "customer_id", "left_semi")
    columns = ["customer_name", "email", "city", "country", "effective_date"]
    return _shown(merge.merge_soft_delete(_old_customers(spark, sf), recent, "customer_id", columns))


@query
def detect_deletes(spark, sf):
    events = t.table(spark, sf, "events")
    users = events.groupBy("user_id").agg(F.min("ts").alias("since")).select(
        "user_id", "since", F.lit(True).alias("is_active"), F.lit(None).cast("timestamp_ntz").alias("deleted_at")
    )
    seen = events.where(F.col("ts") >= t.day_start(t.EVENTS_LAST_DAYS)).where("event_type = 'purchase'").select("user_id")
    return merge.detect_deletes(users, seen, "user_id", incremental.freshest(events, "ts"))


@query
def scd2_build(spark, sf):
    return history.scd2_build(t.table(spark, sf, "events"), "user_id", ["ts", "event_id"], ["event_type"])


def _segment_history(spark, sf):
    """Open SCD2 versions of early customers; those in debt carried another segment."""
    day = F.lit("1995-01-01").cast("date")
    early = _customer_segments(spark, sf).join(_ordered_before(spark, sf, t.EARLY_END), "customer_id", "left_semi")
    return early.select(
        surrogate_key(F.col("customer_id"), day).alias("customer_key"), "customer_id", "customer_name",
        F.when(F.col("balance") < 0, "IN DEBT").otherwise(F.col("segment")).alias("segment"),
        day.alias("effective_start_date"), F.lit(history.OPEN_END).cast("date").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )


def _customer_segments(spark, sf):
    return t.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
    )


@query
def scd2_apply(spark, sf):
    source = _customer_segments(spark, sf).drop("balance")
    day = F.lit(t.LOAD_DAY).cast("date")
    return history.scd2_apply(_segment_history(spark, sf), source, "customer_id", ["customer_name", "segment"], day)


@query
def semi_changed_customers(spark, sf):
    source = _customer_segments(spark, sf).drop("balance")
    return history.changed_rows(source, _segment_history(spark, sf), "customer_id", ["customer_name", "segment"])


@query
def cdc_apply(spark, sf):
    """Users as of the cut day, then all later events applied as changes."""
    changes = t.event_changes(t.table(spark, sf, "events"))
    before = F.col("ts") < t.day_start(t.EVENTS_CUT)
    target = history.latest_per_key(changes.where(before), ["user_id"], ["ts", "event_id"]).drop("op")
    return history.cdc_apply(target, changes.where(~before), "user_id", ["ts", "event_id"])


@query
def point_in_time_join(spark, sf):
    """Each purchase with the event type its user was last seen with at that moment."""
    events = t.table(spark, sf, "events")
    versions = history.scd2_build(events.where("event_type <> 'purchase'"), "user_id", ["ts", "event_id"], ["event_type"])
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    return history.point_in_time_join(purchases, versions.withColumnRenamed("event_type", "state"), "user_id", "ts", ["state"])


# --- star schema ---------------------------------------------------------------------------------


@query
def dim_date(spark, sf):
    return t.dim_date(spark, sf)


@query
def dim_customer(spark, sf):
    return _shown(t.dim_customer(spark, sf))


@query
def dim_product(spark, sf):
    return _shown(t.dim_product(spark, sf))


@query
def fact_sales(spark, sf):
    """All facts, with their keys and what these stand for in the dimensions."""
    fact = t.fact(spark, sf).withColumns({"c": F.col("customer_key"), "p": F.col("product_key")})
    return as_doubles(_with_ids(spark, sf, fact)).withColumnsRenamed({"c": "customer_key", "p": "product_key"})


def _with_ids(spark, sf, fact: DataFrame) -> DataFrame:
    customers = t.dim_customer(spark, sf).select("customer_key", "customer_id")
    products = t.dim_product(spark, sf).select("product_key", "product_id")
    return fact.join(customers, "customer_key").join(products, "product_key").drop("customer_key", "product_key")


@query
def fact_lookup(spark, sf):
    """All sales of the biggest sale's customer, product and day."""
    fact = t.fact(spark, sf)
    biggest = fact.agg(F.max_by(F.struct("customer_key", "product_key", "transaction_date"), F.struct("net_amount", "transaction_id")).alias("b"))

    def of(name):
        return biggest.select(f"b.{name}").scalar()

    found = star.fact_lookup(fact, of("customer_key"), of("product_key"), of("transaction_date"))
    return as_doubles(_with_ids(spark, sf, found))


@query
def orphan_check(spark, sf):
    """Facts whose customer is missing from the dimension as first loaded."""
    orphans = star.orphan_check(t.fact(spark, sf), _old_customers(spark, sf), "customer_key")
    return orphans.join(t.dim_customer(spark, sf).select("customer_key", "customer_id"), "customer_key").drop("customer_key")


# --- projections and summaries -------------------------------------------------------------------


@query
def transform_sales(spark, sf):
    return as_doubles(_clean(spark, sf))


@query
def daily_summary(spark, sf):
    return transform.daily_summary(_clean(spark, sf), t.CATEGORIES).drop("generated_at")


@query
def order_size(spark, sf):
    size = rules.order_size(money("l_extendedprice")).alias("order_size_category")
    return t.table(spark, sf, "lineitem").groupBy(size).agg(F.count(F.lit(1)).alias("n"))


@query
def quality_flag(spark, sf):
    """Flags over deliberately stricter inputs: price less 1000, discount twelvefold, one name missing."""
    staging = t.staging_sales(spark, sf)
    flag = rules.quality_flag(
        F.col("quantity"), F.col("total_amount") - 1000, F.col("total_amount"), F.col("discount_amount") * 12,
        F.nullif(F.col("product_name"), F.lit("red widget")), F.col("category"),
    )
    return staging.groupBy(flag.alias("data_quality_flag")).agg(F.count(F.lit(1)).alias("n"))


@query
def transform_positive(spark, sf):
    """Lines less ten pieces and 5000, so that some are not positive; those of one order status have no id."""
    lines = t.order_lines(spark, sf).select(
        F.when(F.col("status") != "P", F.col("order_id")).alias("order_id"), "customer_id",
        F.col("p_partkey").cast("string").alias("product_id"), (F.col("quantity") - 10).alias("quantity"), "unit_price",
        (F.col("total_amount") - 5000).alias("total_amount"), F.date_format("moment", "yyyyMMdd").alias("order_date"),
    )
    return as_doubles(transform.transform_positive(lines, t.LOAD_DAY).drop("ingestion_timestamp"))


@query
def sales_by_day(spark, sf):
    return transform.sales_by_day(t.order_lines(spark, sf).withColumn("order_date", F.to_date("moment")))


@query
def sales_totals(spark, sf):
    return transform.sales_totals(t.order_lines(spark, sf))


@query
def avg_transaction(spark, sf):
    return transform.sales_performance(t.staging_sales(spark, sf), ["category"])


@query
def performance_tier(spark, sf):
    """Products of an order per performance tier and stock advice of their sales."""
    per_item = transform.sales_performance(t.order_lines(spark, sf), ["order_id", "p_partkey"])
    return per_item.groupBy("performance", "recommendation").agg(F.count(F.lit(1)).alias("items"))


@query
def stg_customers(spark, sf):
    """Customers by first order day, the newest week before the cut day's half year end."""
    first = t.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("created_at"))
    raw = first.join(t.table(spark, sf, "customer"), "c_custkey").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"), "created_at",
    )
    newest = first.agg(F.to_date(F.max("created_at"))).scalar()
    return transform.stage_customers(raw, newest, 365).withColumn("created_at", F.to_date("created_at"))


@query
def price_with_tax(spark, sf):
    return as_doubles(transform.with_tax(t.table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("price"))))


@query
def window_filter(spark, sf):
    events = t.table(spark, sf, "events")
    newest = incremental.freshest(events, "ts")
    rows = transform.window_filter(events, "ts", newest - F.expr("interval 1 day"), newest)
    return rows.select("event_id", "user_id", "event_type")


@query
def weekday_routing(spark, sf):
    return t.table(spark, sf, "orders").groupBy(transform.day_type(F.to_date("o_orderdate")).alias("day_type")).agg(
        F.count(F.lit(1)).alias("orders")
    )


# --- reports and analyses ------------------------------------------------------------------------


@query
def daily_sales_report(spark, sf):
    return reports.daily_sales_report(t.fact(spark, sf), t.dim_date(spark, sf)).drop("report_generated_at")


@query
def top_customers(spark, sf):
    return reports.top_customers(t.fact(spark, sf), t.dim_customer(spark, sf))


@query
def top_spenders(spark, sf):
    return reports.top_spenders(t.fact(spark, sf), t.dim_customer(spark, sf))


@query
def category_sales(spark, sf):
    return reports.category_sales(t.fact(spark, sf), t.dim_product(spark, sf))


@query
def category_lines(spark, sf):
    return reports.category_lines(t.fact(spark, sf), t.dim_product(spark, sf))


@query
def monthly_trend(spark, sf):
    return reports.monthly_trend(t.fact(spark, sf), t.dim_date(spark, sf))


@query
def weekend_vs_weekday(spark, sf):
    return reports.weekend_vs_weekday(t.fact(spark, sf), t.dim_date(spark, sf))


@query
def weekend_vs_weekday_year(spark, sf):
    return reports.weekend_vs_weekday(t.fact(spark, sf), t.dim_date(spark, sf), 2000)


@query
def geo_sales(spark, sf):
    return reports.geo_sales(t.fact(spark, sf), t.dim_customer(spark, sf))


@query
def discount_effectiveness(spark, sf):
    return reports.discount_effectiveness(t.fact(spark, sf))


@query
def category_sales_clean(spark, sf):
    return reports.category_sales_clean(_clean(spark, sf))


def _stored_by_month(spark, rows: DataFrame, day: str) -> str:
    path = scratch_path(spark, "by_month")
    tables.write_truncate(rows.withColumn(pipelines.MONTH, month_start(F.col(day))), path, [pipelines.MONTH], [day])
    return path


@query
def quality_history(spark, sf):
    """The newest days' quality, from the newest months of the stored clean lines."""
    path = _stored_by_month(spark, _clean(spark, sf), "order_date")
    clean = reports.read_newest_days(spark, path, pipelines.MONTH, "order_date", 30)
    return reports.quality_history(transform.daily_summary(clean, t.CATEGORIES))


@query
def latest_reports(spark, sf):
    path = _stored_by_month(spark, t.fact(spark, sf), "transaction_date")
    fact = reports.read_newest_days(spark, path, pipelines.MONTH, "transaction_date", 7)
    report = reports.daily_sales_report(fact, t.dim_date(spark, sf)).drop("report_generated_at")
    return reports.latest_reports(report, "full_date")


@query
def daily_net_series(spark, sf):
    return reports.daily_net_series(t.fact(spark, sf), t.last_order_day(spark, sf))


@query
def approx_customers(spark, sf):
    """Is the approximate count of each day within a fifth (four standard errors) or two customers of the exact one?"""
    fact = t.fact(spark, sf)
    exact = fact.groupBy("transaction_date").agg(F.count_distinct("customer_key").alias("exact"))
    off = F.abs(F.col("customers") - F.col("exact"))
    both = reports.approx_customers(fact).join(exact, "transaction_date")
    return both.select("transaction_date", (off <= F.greatest(F.lit(2.0), F.col("exact") / 5)).alias("close"))


def _stored_day_counts(spark, sf) -> str:
    """A store of the days' customers and products, at first without one order status, then with its days made anew."""
    path = scratch_path(spark, "day_counts")
    lines = t.order_lines(spark, sf).select(
        F.to_date("moment").alias("day"), F.col("customer_id").cast("long").alias("customer"), F.col("p_partkey").alias("product"),
        (F.col("total_amount") - F.col("discount_amount")).alias("net"), "status")
    lines = settle(lines, "counted-lines")
    counted, totals = ["customer", "product"], [F.count(F.lit(1)).alias("n"), F.sum("net").alias("net")]
    pending = F.col("status") == "P"
    daycounts.store_days(lines.where(~pending), path, "day", counted, counted, *totals)
    daycounts.refresh_days(lines, path, "day", lines.where(pending), counted, counted, *totals)
    return path


@query
def monthly_distinct(spark, sf):
    """Customers and products of each month from day rows: exact, and whether the sketches come within four standard errors."""
    counted, totals = ["customer", "product"], [F.sum("n").alias("transactions"), F.sum("net").alias("net_sales")]
    months = daycounts.merged_counts(spark, _stored_day_counts(spark, sf), F.date_trunc("month", "day").cast("date"), counted, counted, *totals)
    for c in counted:
        error = F.abs(F.col(f"approx_{c}") - F.col(f"exact_{c}"))
        months = months.withColumn(f"close_{c}", error <= 4 * daycounts.STANDARD_ERROR * F.col(f"exact_{c}")).drop(f"approx_{c}")
    return as_doubles(months)


@query
def rolling_distinct(spark, sf):
    """Customers and products of the seven days up to each day."""
    return daycounts.rolling_counts(spark, _stored_day_counts(spark, sf), "day", 7, ["customer", "product"])


@query
def rfm_segments(spark, sf):
    customers = t.dim_customer(spark, sf).withColumn("number", F.col("customer_id").cast("bigint"))
    return analytics.rfm_segments(t.fact(spark, sf), customers, t.last_order_day(spark, sf), tie="number")


@query
def cohort_retention(spark, sf):
    return analytics.cohort_retention(t.fact(spark, sf))


@query
def sales_velocity(spark, sf):
    return analytics.sales_velocity(t.fact(spark, sf), t.dim_product(spark, sf), t.last_order_day(spark, sf))


@query
def product_affinity(spark, sf):
    return analytics.product_affinity(t.fact(spark, sf), t.dim_product(spark, sf), min_support=2)


@query
def category_affinity(spark, sf):
    """Categories bought together; the part type stands for the product."""
    lines = t.staging_sales(spark, sf).select(F.col("order_id").alias("transaction_id"), "category")
    names = t.table(spark, sf, "part").select(F.col("p_type").alias("category")).distinct()
    return analytics.product_affinity(lines, names, "category", "category", "category", min_support=10)


def _customers_and_orders(spark, sf):
    customers = t.customers_raw(spark, sf).select("customer_id", "customer_name", "city")
    orders = t.table(spark, sf, "orders")
    return customers, orders.select(F.col("o_custkey").cast("string").alias("customer_id"), money("o_totalprice").alias("amount"))


@query
def customer_totals(spark, sf):
    return as_doubles(analytics.customer_totals(*_customers_and_orders(spark, sf), vip_above=1_500_000))


@query
def customer_summary(spark, sf):
    customers, orders = _customers_and_orders(spark, sf)
    return analytics.customer_summary(analytics.customer_totals(customers, orders), orders)


def _dated_sales(spark, sf) -> DataFrame:
    return t.order_lines(spark, sf).select(
        F.to_date("moment").alias("date"), "customer_id", F.col("total_amount").cast("double").alias("amount"))


@query
def fit_sales(spark, sf):
    """The coefficients of a regression of sales on the date with an effect per customer, and the spread of these effects."""
    model = models.fit_sales_regression(_dated_sales(spark, sf))
    effects = model.effects.agg(F.count(F.lit(1)).alias("customers"), F.round(F.min("effect"), 3).alias("lowest"), F.round(F.max("effect"), 3).alias("highest"))
    return effects.select("*", *[F.round(F.lit(c), 5).alias(name) for name, c in model.coefficients.items()])


@query
def predict_sales(spark, sf):
    """A model of the first two years' sales, stored and read back, and what it predicts for all: mean and error by year.

    Customers who bought nothing in these years are unknown to it.
    """
    sales, path = _dated_sales(spark, sf), scratch_path(spark, "regression")
    models.save_regression(models.fit_sales_regression(sales.where(F.col("date") < F.lit(t.FIT_END).cast("date"))), path)
    predicted = models.predict_sales(models.load_regression(spark, path), sales)
    error = F.col("amount") - F.col("predicted_amount")
    return predicted.groupBy(F.year("date").cast("bigint").alias("year")).agg(
        F.count("predicted_amount").alias("predicted"), F.round(F.avg("predicted_amount"), 3).alias("mean_predicted"),
        F.round(F.sqrt(F.avg(error * error)), 3).alias("error"))


# --- quality -------------------------------------------------------------------------------------


@query
def quality_metrics(spark, sf):
    return quality.quality_metrics(_clean(spark, sf))


def _dirty(spark, sf) -> DataFrame:
    """Clean order lines spoilt so that every check but that of the row count finds something."""
    total, discount = F.col("total_amount") - 2000, F.col("discount_amount") * 12 - 100
    spoilt = _clean(spark, sf).withColumns({
        "customer_id": F.when(F.col("category") != "ECONOMY", F.col("customer_id")),
        "order_date": F.when(F.col("quantity") != 7, F.col("order_date")),
        "quantity": F.col("quantity") - 2, "unit_price": F.col("unit_price") - 950,
        "total_amount": total, "discount_amount": discount, "net_amount": total - discount,
    })
    flag = rules.quality_flag(*[F.col(c) for c in ("quantity", "unit_price", "total_amount", "discount_amount", "product_name", "category")])
    return spoilt.withColumn("data_quality_flag", flag)


@query
def quality_verdicts(spark, sf):
    return as_doubles(quality.quality_verdicts(quality.quality_metrics(_dirty(spark, sf))))


@query
def quality_gate(spark, sf):
    return quality.quality_gate(quality.quality_metrics(_dirty(spark, sf)))


def _cases(**checks: DataFrame) -> DataFrame:
    """The rows of several checks, named."""
    return reduce(DataFrame.unionByName, [check.withColumn("case", F.lit(name)) for name, check in checks.items()])


@query
def validate_staging(spark, sf):
    """The staging gate over all lines, and over lines that fail it in each of its ways."""
    lines = settle(t.staging_sales(spark, sf).select("total_amount", "quantity"), "gated")
    most = 10**12
    return _cases(
        good=quality.validate_staging(lines, most), large=quality.validate_staging(lines, 10),
        empty=quality.validate_staging(lines.where(F.lit(False)), most),
        amount=quality.validate_staging(lines.withColumn("total_amount", F.col("total_amount") - 2000), most),
        quantity=quality.validate_staging(lines.withColumn("quantity", F.col("quantity") - 2), most))


@query
def validate_fact_count(spark, sf):
    fact = t.fact(spark, sf)
    before = fact.where(F.col("transaction_date") < F.lit("1990-01-01").cast("date"))
    return _cases(good=quality.validate_fact_count(fact), empty=quality.validate_fact_count(before))


@query
def reconcile_counts(spark, sf):
    """Staging against production: all loaded, nothing staged, nothing loaded, and more loaded than staged."""
    lines, loaded = t.table(spark, sf, "lineitem"), settle(t.fact(spark, sf).select("transaction_id"), "loaded")
    nothing = F.lit(False)
    return _cases(
        good=quality.reconcile_counts(lines, loaded), unstaged=quality.reconcile_counts(lines.where(nothing), loaded),
        unloaded=quality.reconcile_counts(lines, loaded.where(nothing)),
        more=quality.reconcile_counts(lines.where("l_quantity <> 7"), loaded))


@query
def fact_alerts(spark, sf):
    return quality.fact_alerts(t.fact(spark, sf))


@query
def volume_check(spark, sf):
    return quality.volume_check(t.fact(spark, sf), t.last_order_day(spark, sf))


@query
def freshness_check(spark, sf):
    """Freshness of the orders against the newest shipment."""
    newest = t.table(spark, sf, "lineitem").agg(F.max("l_shipdate")).scalar()
    return quality.freshness_check(t.table(spark, sf, "orders"), "o_orderdate", newest)


@query
def check_true(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    return _cases(
        good=quality.check_true(lines, F.count(F.lit(1)) > 0), bad=quality.check_true(lines, F.min("l_quantity") > 10),
        unknown=quality.check_true(lines, F.max(F.nullif("l_quantity", "l_quantity")) > 10))


@query
def check_min_rows(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    return _cases(good=quality.check_min_rows(lines, 1000), bad=quality.check_min_rows(lines, 10**12))


@query
def check_value(spark, sf):
    return quality.check_value(t.table(spark, sf, "lineitem"), F.sum(money("l_extendedprice")), minimum=1000.0)


@query
def column_health(spark, sf):
    return quality.column_health(t.table(spark, sf, "lineitem"), "l_partkey", "l_orderkey")


# --- incremental, streams, pipelines -------------------------------------------------------------


@query
def high_water_mark(spark, sf):
    return incremental.high_water_mark(t.table(spark, sf, "orders"), "o_orderdate")


@query
def incremental_by_timestamp(spark, sf):
    """Users as of the last days, their values lost: only those with a newer event get one back."""
    events = t.table(spark, sf, "events").select("user_id", "event_type", "value", "ts", "event_id")
    before = events.where(F.col("ts") < t.day_start(t.EVENTS_LAST_DAYS)).withColumn("value", F.lit(-1.0))
    target = history.latest_per_key(before, ["user_id"], ["ts", "event_id"])
    source = history.latest_per_key(events, ["user_id"], ["ts", "event_id"])
    return incremental.incremental_by_timestamp(target, source, "user_id", "ts")


@query
def incremental_by_version(spark, sf):
    """Events up to the cut day, with higher event numbers appended from the full table."""
    events = t.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return incremental.incremental_by_version(events.where(F.col("ts") < t.day_start(t.EVENTS_CUT)), events, "event_id")


@query
def backfill(spark, sf):
    path = scratch_path(spark, "event_facts")
    raw = t.event_sales(t.events(spark, sf))
    raw = raw.withColumn("transaction_date", F.to_date("transaction_timestamp"))
    incremental.backfill(raw, star.fact_sales, "transaction_date", "2024-01-05", "2024-01-25", path, "transaction_date")
    stored = spark.read.parquet(path)
    return as_doubles(stored.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("n"), F.sum("net_amount").alias("net_sales")))


def _arrivals(spark, sf, *parts: DataFrame):
    """The events as a stream of files, which come part by part: yields the stream after each arrival."""
    folder = scratch_path(spark, "arriving")
    for i, part in enumerate(parts):
        part.write.parquet(f"{folder}/{i:03d}")
        yield ingest.file_stream(spark, f"{folder}/*", t.table(spark, sf, "events").schema, "parquet")


@query
def stream_cdc_apply(spark, sf):
    """The change feed in three arrivals: the newer half, the older half, and the newest days once more."""
    events = t.table(spark, sf, "events")
    newer, newest = F.col("ts") >= t.day_start(t.EVENTS_CUT), F.col("ts") >= t.day_start(t.EVENTS_LAST_DAYS)
    state, progress = scratch_path(spark, "user_state"), scratch_path(spark, "progress")
    for stream in _arrivals(spark, sf, events.where(newer), events.where(~newer), events.where(newest)):
        live = ingest.stream_cdc_apply(t.event_changes(stream), state, progress, "user_id", ["ts", "event_id"])
    return live


@query
def stream_fact_sales(spark, sf):
    """Sales in three arrivals.

    Errors come twice in one file, with different values. Early purchases come late, with the second file, and so do all clicks again,
    with a higher value. Sign-ups have no id. The second file comes twice.
    """
    events = t.table(spark, sf, "events").withColumn("event_id", F.when(F.col("event_type") != "signup", F.col("event_id")))
    late = (F.col("event_type") == "purchase") & (F.col("ts") < t.day_start(t.EVENTS_CUT))
    first = events.where(~late)
    first = first.unionByName(first.where("event_type = 'error'").withColumn("value", F.col("value") + 5))
    second = events.where(late).unionByName(events.where("event_type = 'click'").withColumn("value", F.col("value") + 1))
    second = second.unionByName(events.where("event_type = 'signup'"))
    facts, progress = scratch_path(spark, "facts"), scratch_path(spark, "progress")
    for stream in _arrivals(spark, sf, first, second, second):
        stored = ingest.stream_fact_sales(t.event_sales(stream), facts, progress)
    return as_doubles(stored.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("n"), F.sum("net_amount").alias("net_sales")))


@query
def stream_fact_sales_bounded(spark, sf):
    """Sales in three arrivals with a memory of two days: up to the cut day, all later ones, and then clicks of all days.

    Clicks of the last day are repeats; those of the days before are too late, whether they are repeats or not, and
    early purchases, which come with them, are too late as well.
    """
    events = t.table(spark, sf, "events")
    early, purchase = F.col("ts") < t.day_start(t.EVENTS_CUT), F.col("event_type") == "purchase"
    newest = events.agg(F.date_trunc("day", F.max("ts"))).scalar()
    again = events.where((F.col("event_type") == "click") & ((F.col("ts") >= newest) | early)).unionByName(events.where(early & purchase))
    facts, progress = scratch_path(spark, "facts"), scratch_path(spark, "progress")
    late = repeated = 0
    for stream in _arrivals(spark, sf, events.where(early & ~purchase), events.where(~early), again):
        run = ingest.stream_fact_sales_bounded(t.event_sales(stream), facts, progress, "2 days")
        late, repeated = late + run.late, repeated + run.repeated
    stored = run.sales.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("n"), F.sum("net_amount").alias("net_sales"))
    return as_doubles(stored.withColumn("late", F.lit(late).cast("long")).withColumn("repeated", F.lit(repeated).cast("long")))


@query
def load_complete_sets(spark, sf):
    """Two folders of events a day, clicks and others; the others of the last days are missing in a first run."""
    folder = scratch_path(spark, "arriving")
    events = t.events(spark, sf).select("event_id", "value", "day", F.when(F.col("event_type") == "click", "click").otherwise("other").alias("kind"))
    late = (F.col("kind") == "other") & (F.col("day") >= F.lit(t.EVENTS_LAST_DAYS).cast("date"))
    days = sorted(str(d) for d in tables.distinct_values(events, "day"))
    expected = {d: [f"{folder}/day={d}/kind={k}" for k in ("click", "other")] for d in days}
    schema = StructType([f for f in events.schema if f.name in ("event_id", "value")])
    target, log = scratch_path(spark, "sets"), scratch_path(spark, "sets_log")
    shown = []
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").partitionBy("day", "kind").parquet(folder)
        run = arrivals.load_complete_sets(spark, expected, schema, target, log, lambda paths: spark.read.schema(schema).parquet(*paths))
        shown.append(settle(run.rows.groupBy("file_set").agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total")), "shown"))
    first = shown[0].select("file_set", F.col("n").alias("n_first"))
    return as_doubles(shown[1].join(first, "file_set", "left"))


@query
def run_datamart(spark, sf):
    """Everything before the last day in one run, then the last day, which is run twice; the gate is on."""
    root, staging = scratch_path(spark, "datamart"), t.staging_items(spark, sf)
    run = {"categories": t.CATEGORIES, "partition_unit": "month"}
    pipelines.run_datamart(staging, root, None, t.DAY_BEFORE_LOAD, **run)
    for _ in range(2):
        summary = pipelines.run_datamart(staging, root, t.LOAD_DAY, **run)
    return summary.drop("generated_at")


@query
def run_star_schema(spark, sf):
    """Two files of text in turn, the second one run twice.

    Urgent orders come late, with the second file; orders of one status come with both; low ones
    have no id. The second file holds high orders twice, with different amounts.
    """
    root, report = scratch_path(spark, "star"), None
    with freed_shuffles(spark):
        _write_sales_files(spark, sf, root)
    for name, first, last in (("first", None, t.DAY_BEFORE_LATE), ("second", t.LATE_START, t.LOAD_DAY), ("second", t.LATE_START, t.LOAD_DAY)):
        path = f"{root}/files/{name}"
        report = pipelines.run_star_schema(
            t.customers_raw(spark, sf), t.products_raw(spark, sf), files.read_staging_csv(spark, path, TRANSACTIONS_RAW), root,
            first, last, partition_unit="month",
        )
    return report.drop("report_generated_at")


@drops_copies
def _write_sales_files(spark: SparkSession, sf: str, root: str) -> None:
    """The files of :func:`run_star_schema`, as text that is compressed."""
    sales = t.order_items(spark, sf).select(
        F.when(F.col("priority") != "5-LOW", F.col("item_id")).alias("transaction_id"), "customer_id",
        F.col("p_partkey").cast("string").alias("product_id"), "quantity", "unit_price", "total_amount", "discount_amount",
        F.date_format("moment", "yyyy-MM-dd HH:mm:ss").alias("transaction_timestamp"), "moment", "priority", "status",
    )
    sales = settle(sales, "star-sales")
    early, urgent = F.col("moment") < t.day_start(t.LATE_START), F.col("priority") == "1-URGENT"
    parts = {"first": early & ~urgent, "second": ~early | urgent | (F.col("status") == "P")}
    for name in parts:
        rows = sales.where(parts[name])
        if name == "second":
            more = {"quantity": F.col("quantity") + 1, "total_amount": (F.col("total_amount") + 10).cast("decimal(18,2)")}
            rows = rows.where("priority = '2-HIGH'").withColumns(more).unionByName(rows)
        rows.select(*TRANSACTIONS_RAW.names).write.option("header", True).option("compression", "gzip").csv(f"{root}/files/{name}")


@query
def run_file_etl(spark, sf):
    """Two days' files, the second one loaded twice: urgent orders come with the second, on dates that the first has touched too."""
    root = scratch_path(spark, "file_etl")
    lines = t.order_lines(spark, sf).select(
        "order_id", "customer_id", F.col("p_partkey").cast("string").alias("product_id"), "quantity", "unit_price",
        "total_amount", F.date_format("moment", "yyyyMMdd").alias("order_date"), "priority",
    )
    urgent, summary = F.col("priority") == "1-URGENT", None
    for day, rows in ((t.DAY_BEFORE_LOAD, lines.where(~urgent)), (t.LOAD_DAY, lines.where(urgent)), (t.LOAD_DAY, None)):
        if rows is not None:
            rows.select(*ORDER_LINES_RAW.names).write.option("header", True).csv(f"{root}/raw/sales_{day.replace('-', '')}.csv")
        summary = pipelines.run_file_etl(spark, f"{root}/raw/sales_{{ds_nodash}}.csv", root, day, max_rows=10**12)
    return summary.drop("updated_at")
