from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from samples import DAY, ORDERS, RUN, SALES, as_list, as_set, staging, staging_rows

from salesmart.functions.dates import calendar, date_series, sunday_week
from salesmart.functions.keys import surrogate_key
from salesmart.functions.money import percent
from salesmart.operators import star, transform


def test_sample_orders_give_the_known_summary(spark):
    clean = transform.transform_sales(staging(spark), DAY, run_ts=RUN)
    assert len(clean.columns) == 15
    summary = transform.daily_summary(clean, run_ts=RUN)
    assert len(summary.columns) == 21
    row = summary.first().asDict()
    expected = dict(
        report_date=DAY, total_orders=15, unique_customers=8, unique_products=15, total_quantity=23, gross_sales=40090.0,
        total_discounts=2890.0, net_sales=37200.0, avg_order_value=2480.0, electronics_sales=29900.0, fashion_sales=4000.0,
        home_sales=3300.0, small_orders_count=5, medium_orders_count=8, large_orders_count=2, extra_large_orders_count=0,
        valid_records_count=15, invalid_records_count=0, data_quality_score=100.0, generated_at=RUN,
    )
    assert {k: row[k] for k in expected} == expected
    assert row["avg_discount_percentage"] == pytest.approx(7.532)
    shares = [float(r[0]) for r in clean.orderBy("order_id").select("discount_percentage").collect()]
    assert shares == [5.56, 0, 5.88, 5.56, 9.09, 16.67, 0, 5.88, 6.25, 11.11, 0, 14.29, 13.79, 11.76, 7.14]


def test_unknown_total_keeps_the_three_valued_rules(spark):
    row = list(staging_rows()[0])
    row[7] = None
    got = transform.transform_sales(staging(spark, rows=[tuple(row)])).first()
    assert (got.discount_percentage, got.order_size_category, got.data_quality_flag) == (0, "Extra Large", "VALID")


@pytest.mark.parametrize("total,size", [(999.99, "Small"), (1000, "Medium"), (4999.99, "Medium"), (5000, "Large"), (9999.99, "Large"), (10000, "Extra Large")])
def test_size_bounds(spark, total, size):
    row = list(staging_rows()[0])
    row[7] = float(total)
    assert transform.transform_sales(staging(spark, rows=[tuple(row)])).first().order_size_category == size


def test_rows_without_keys_or_of_other_days_are_left_out(spark):
    rows = staging_rows() + staging_rows(DAY + timedelta(days=1))
    rows[0] = (None, *rows[0][1:])
    assert transform.transform_sales(staging(spark, rows=rows), DAY).count() == len(ORDERS) - 1
    assert transform.transform_sales(staging(spark, rows=rows), DAY, DAY + timedelta(days=1)).count() == 2 * len(ORDERS) - 1


def test_sales_by_day(spark):
    rows = [(p, q, t, date(2024, 1, d)) for p, q, t, d in SALES]
    got = transform.sales_by_day(spark.createDataFrame(rows, "product_name string, quantity bigint, total_amount double, order_date date"))
    assert [r.total_sales for r in got.collect()] == [3500.0, 1250.0, 4500.0, 2500.0, 7000.0]


def test_calendar_covers_the_years_and_matches_python(spark):
    days = star.dim_date(spark).collect()
    assert len(days) == 4018
    for d in days[:800]:
        full = d.full_date
        assert d.date_key == int(full.strftime("%Y%m%d"))
        assert d.week == int(full.strftime("%U"))
        assert (d.month_name, d.day_name) == (full.strftime("%B"), full.strftime("%A"))
        assert d.is_weekend == (full.weekday() >= 5)


def test_percent_rounds_half_up_once_and_guards_zero(spark):
    cases = [(1, 8, 12.5), (-1, 8, -12.5), (1, 3, 33.33), (2, 3, 66.67), (200005, 100000000, 0.2), (12345, 1000000, 1.23), (12355, 1000000, 1.24), (1, 0, None)]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a bigint, b bigint")
    got = [None if r[0] is None else float(r[0]) for r in df.select(percent(F.col("a"), F.col("b"))).collect()]
    assert got == [c for _, _, c in cases]


def test_keys_are_stable_distinct_and_null_safe(spark):
    df = spark.range(20_000).select(surrogate_key(F.col("id")).alias("k"))
    assert df.distinct().count() == 20_000
    one = spark.sql("select cast(null as string) a, 'x' b").select(surrogate_key(F.col("a")), surrogate_key(F.col("b"), F.col("a")))
    assert tuple(one.first()) == (None, None)


def test_date_filters_reach_the_scan(spark, path):
    clean = transform.transform_sales(staging(spark), run_ts=RUN)
    clean.write.partitionBy("order_date").parquet(path)
    day = transform.on_days(spark.read.parquet(path), "order_date", DAY).select("order_id", "net_amount")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan
    assert "ReadSchema: struct<order_id:string,net_amount:decimal(18,2)>" in plan


def test_load_of_positive_lines(spark):
    rows = [("1", "c", "p", 1, 2.0, 2.0, "20240115"), ("2", "c", "p", 0, 2.0, 2.0, "20240115"), ("3", "c", "p", 1, 2.0, -2.0, "20240115")]
    lines = spark.createDataFrame(rows, "order_id string, customer_id string, product_id string, quantity bigint, unit_price double, total_amount double, order_date string")
    got = transform.transform_positive(lines, "2024-01-16", RUN)
    assert as_list(got, "order_id", "order_date", "ingestion_timestamp", "partition_date") == [("1", DAY, RUN, "2024-01-16")]


def test_stage_customers_and_tax(spark):
    raw = spark.createDataFrame([("1", "Ayşe", "a@x", "2024-01-14 10:00:00"), ("2", "Ali", "b@x", "2024-01-01 10:00:00")], "customer_id string, customer_name string, email string, created_at string")
    got = transform.stage_customers(raw.withColumn("created_at", F.to_timestamp("created_at")), DAY)
    assert as_list(got, "customer_id", "customer_name") == [("1", "AYŞE")]
    prices = spark.createDataFrame([(100.0,), (200.0,)], "price double")
    assert [float(r.price_with_tax) for r in transform.with_tax(prices).collect()] == [118.0, 236.0]


def test_date_series_and_week_start(spark):
    days = date_series(spark, "2023-12-30", "2024-01-02")
    assert calendar(days).count() == 4
    assert as_set(days.select(sunday_week(F.col("full_date")))) == {(52,), (53,), (0,)}
