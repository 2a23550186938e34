import os
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from samples import DAY, RUN, as_list, as_set, staging, staging_rows

from salesmart.functions import totals
from salesmart.operators import quality, star
from salesmart.operators.incremental import backfill
from salesmart.operators.quality import QualityError
from salesmart.operators.transform import daily_summary, transform_sales
from salesmart.plans import driver_queries, pipelines
from salesmart.session import scratch_path, settle, shared_folder
from salesmart.sources import synthetic, tables
from salesmart.sources.schemas import TRANSACTIONS_RAW
from salesmart.sources.tables import export_table

NEXT = DAY + timedelta(days=1)


def test_datamart_days_and_reruns(spark, path):
    both = staging(spark, rows=staging_rows() + staging_rows(NEXT))
    first = as_set(pipelines.run_datamart(both, path, DAY, run_ts=RUN))
    assert len(first) == 1
    assert as_set(pipelines.run_datamart(both, path, DAY, run_ts=RUN)) == first
    by_day = as_set(pipelines.run_datamart(both, path, NEXT, run_ts=RUN))
    assert len(by_day) == 2 and spark.read.parquet(f"{path}/sales_cleaned").count() == 30
    assert as_set(pipelines.run_datamart(both, f"{path}_all", run_ts=RUN)) == by_day
    assert as_set(pipelines.run_datamart(both, f"{path}_range", DAY, NEXT, run_ts=RUN)) == by_day
    assert as_set(pipelines.run_datamart(both, f"{path}_months", run_ts=RUN, partition_unit="month")) == by_day
    for day in (NEXT, DAY):  # a day run leaves the other days of its month alone
        assert as_set(pipelines.run_datamart(both, f"{path}_months", day, run_ts=RUN, partition_unit="month")) == by_day
    assert spark.read.parquet(f"{path}_months/sales_cleaned").count() == 30


def test_an_open_bound_empties_days_without_rows(spark, path):
    rows = [(1, DAY), (2, NEXT)]
    frame = lambda some: spark.createDataFrame(some, "id int, day date")
    for unit in ("day", "month"):
        stored = lambda: as_set(spark.read.parquet(f"{path}_{unit}"), "id")
        pipelines.store(frame(rows), f"{path}_{unit}", "day", None, None, [], unit)
        pipelines.store(frame([(3, NEXT)]), f"{path}_{unit}", "day", None, NEXT, [], unit)
        assert stored() == {(3,)}
        pipelines.store(frame([(4, DAY)]), f"{path}_{unit}", "day", DAY, None, [], unit)
        assert stored() == {(3,), (4,)}


def test_datamart_gate_stops_the_run(spark, path):
    rows = staging_rows()
    rows[0] = (rows[1][0], *rows[0][1:])
    with pytest.raises(QualityError, match="duplicate orders"):
        pipelines.run_datamart(staging(spark, rows=rows), path, DAY)
    with pytest.raises(QualityError, match="No data found"):
        pipelines.run_datamart(staging(spark), path, NEXT)


def test_a_failed_gate_leaves_the_summary_as_it_was(spark, path):
    rows = staging_rows()
    summary = as_set(pipelines.run_datamart(staging(spark, rows=rows), path, DAY, run_ts=RUN))
    with pytest.raises(QualityError, match="duplicate orders"):
        pipelines.run_datamart(staging(spark, rows=rows + rows[:1]), path, DAY, run_ts=RUN)
    assert as_set(spark.read.parquet(f"{path}/daily_sales_summary")) == summary
    relaxed = as_set(pipelines.run_datamart(staging(spark, rows=rows + rows[:1]), path, DAY, run_ts=RUN, strict=False))
    assert relaxed != summary
    # An order of one day that comes again on another, in one load of both.
    with pytest.raises(QualityError, match="duplicate orders"):
        twice = [*rows, *[(rows[0][0], *r[1:]) for r in staging_rows(NEXT)[:1]]]
        pipelines.run_datamart(staging(spark, rows=twice), f"{path}_both", run_ts=RUN)


def test_quality_is_counted_while_rows_are_written(spark):
    for rows in (staging_rows(), staging_rows() + staging_rows()[:2], staging_rows() + staging_rows(NEXT), []):
        clean = transform_sales(staging(spark, rows=rows), run_ts=RUN) if rows else transform_sales(staging(spark), run_ts=RUN).where("false")
        seen = quality.watch(clean)
        for summary in (None, daily_summary(seen.rows, settled=True)):
            assert as_list(seen.metrics(summary)) == as_list(quality.quality_metrics(clean))
            assert seen.metrics(summary).columns == quality.quality_metrics(clean).columns


def star_inputs(spark):
    customers = synthetic.synth_customers(spark, 30, "2026-02-28")
    products = synthetic.synth_products(spark, 23)
    sales = synthetic.synth_sales(spark, 600, 30, 23, "2026-02-28 18:00:00")
    return customers, products, sales


def test_star_schema_by_day_equals_backfill(spark, path):
    inputs = star_inputs(spark)
    for day in ("2026-02-27", "2026-02-28", "2026-02-28"):
        report = pipelines.run_star_schema(*inputs, f"{path}_daily", day, run_ts=RUN)
    whole = pipelines.run_star_schema(*inputs, f"{path}_whole", "2026-02-27", "2026-02-28", run_ts=RUN)
    assert report.count() == 2 and as_set(report) == as_set(whole)
    for name in ("dim_customer", "dim_product", "dim_date"):
        assert as_set(spark.read.parquet(f"{path}_daily/{name}")) == as_set(spark.read.parquet(f"{path}_whole/{name}"))
    fact = spark.read.parquet(f"{path}_whole/fact_sales")
    assert fact.count() == 600
    assert star.orphan_check(fact, spark.read.parquet(f"{path}_whole/dim_customer"), "customer_key").isEmpty()
    with pytest.raises(QualityError, match="Fact"):
        pipelines.run_star_schema(*inputs, f"{path}_daily", "2026-03-05")


@pytest.mark.parametrize("unit", ["day", "month"])
def test_late_repeated_and_nameless_rows_are_all_kept_once(spark, path, unit):
    customers, products, _ = star_inputs(spark)

    def sale(name, day, amount=10.0):
        return (name, "C1", "P1", 1, amount, amount, 0.0, f"2026-02-{day} 10:00:00")

    def run(day, *rows):
        pipelines.run_star_schema(customers, products, spark.createDataFrame(rows, TRANSACTIONS_RAW), path, f"2026-02-{day}", run_ts=RUN, partition_unit=unit)
        return Counter((r.transaction_id, r.transaction_date.day, float(r.total_amount)) for r in spark.read.parquet(f"{path}/fact_sales").collect())

    first = [sale("t1", 27), sale("t4", 27), sale(None, 27), sale(None, 27, 5.0), sale("early", 28)]
    assert run(27, *first) == Counter([("t1", 27, 10.0), ("t4", 27, 10.0), (None, 27, 10.0), (None, 27, 5.0)])
    second = [sale("t2", 28), sale("t3", 27), sale("t4", 27, 7.0), sale(None, 27), sale(None, 27, 6.0), sale("t2", 28)]
    want = Counter([("t1", 27, 10.0), ("t3", 27, 10.0), ("t4", 27, 7.0), (None, 27, 10.0), (None, 27, 5.0), (None, 27, 6.0), ("t2", 28, 10.0)])
    assert run(28, *second) == want
    assert run(28, *second) == want
    assert run(27, sale("t1", 27)) == want
    report = {r.full_date.day: r.total_sales for r in spark.read.parquet(f"{path}/daily_sales_report").collect()}
    assert report == {27: 48.0, 28: 10.0}


@pytest.mark.parametrize("unit", ["day", "month"])
def test_reports_read_the_touched_partitions_only(spark, path, unit, monkeypatch):
    customers, products, _ = star_inputs(spark)
    plans = []
    report = pipelines.daily_sales_report

    def spied(fact, *args, **options):
        plans.append(fact._jdf.queryExecution().executedPlan().toString())
        return report(fact, *args, **options)

    monkeypatch.setattr(pipelines, "daily_sales_report", spied)
    sale = lambda name, day: (name, "C1", "P1", 1, 10.0, 10.0, 0.0, f"{day} 10:00:00")
    run = lambda first, *rows: pipelines.run_star_schema(
        customers, products, spark.createDataFrame(rows, TRANSACTIONS_RAW), path, first, run_ts=RUN, partition_unit=unit)
    run("2026-02-28", sale("a", "2026-01-05"), sale("b", "2026-01-06"), sale("c", "2026-02-28"))
    assert run("2026-03-01", sale("d", "2026-03-01"), sale("e", "2026-01-05")).count() == 4
    filters = plans[-1].split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    days = ["2026-01-05", "2026-03-01"] if unit == "day" else ["2026-01-01", "2026-03-01"]
    assert all(d in filters for d in days) and "2026-02" not in filters and "2026-01-06" not in plans[-1]


def test_a_day_out_of_span_fails_the_load(spark, path):
    customers, products, _ = star_inputs(spark)
    rows = [("a", "C1", "P1", 1, 10.0, 10.0, 0.0, "2026-02-28 10:00:00"), ("b", "C1", "P1", 1, 10.0, 10.0, 0.0, "9999-02-28 10:00:00")]
    with pytest.raises(QualityError, match="9999-02-28"):
        pipelines.run_star_schema(customers, products, spark.createDataFrame(rows, TRANSACTIONS_RAW), path, "2026-02-28", "9999-12-31")


def test_backfill_equals_single_days(spark, path):
    sales = star_inputs(spark)[2].withColumn("day", F.to_date("transaction_timestamp"))
    backfill(sales, star.fact_sales, "day", "2026-02-27", "2026-02-28", f"{path}_a", "transaction_date")
    for day in ("2026-02-28", "2026-02-27", "2026-02-27"):
        backfill(sales, star.fact_sales, "day", day, day, f"{path}_b", "transaction_date", ["customer_key"])
    assert as_list(spark.read.parquet(f"{path}_a")) == as_list(spark.read.parquet(f"{path}_b"))


def lines(*rows):
    return [(o, "c", "p", q, 1.0, t, d) for o, q, t, d in rows]


def write_lines(spark, path, day, rows):
    schema = "order_id string, customer_id string, product_id string, quantity bigint, unit_price double, total_amount double, order_date string"
    export_table(spark.createDataFrame(rows, schema), f"{path}/raw/sales_{day}.csv")


def test_file_load_recomputes_every_touched_date(spark, path):
    write_lines(spark, path, "20240115", lines(("1", 1, 10.0, "20240114"), ("2", 2, 20.0, "20240115"), ("3", 0, 5.0, "20240115")))
    write_lines(spark, path, "20240116", lines(("4", 1, 30.0, "20240114"), ("5", 1, 1.0, "20240116")))
    run = lambda day: pipelines.run_file_etl(spark, f"{path}/raw/sales_{{ds_nodash}}.csv", path, day, max_rows=100, run_ts=RUN)
    run("2024-01-15")
    for _ in range(2):
        got = as_set(run("2024-01-16"), "order_date", "total_orders", "total_sales", "max_order_value")
        assert got == {(date(2024, 1, 14), 2, 40.0, 30.0), (date(2024, 1, 15), 1, 20.0, 20.0), (date(2024, 1, 16), 1, 1.0, 1.0)}
    exported = spark.read.option("header", True).csv(f"{path}/reports/daily_summary_2024-01-16")
    assert exported.count() == 3 and len(exported.columns) == 10
    write_lines(spark, path, "20240117", lines(("6", 1, -1.0, "20240117")))
    with pytest.raises(QualityError, match="Negatif"):
        run("2024-01-17")


def test_loads_leave_no_copies_behind(spark, path):
    folder = shared_folder(spark).removeprefix("file:")
    inputs, both = star_inputs(spark), staging(spark, rows=staging_rows() + staging_rows(NEXT))
    kept = set(os.listdir(folder))
    report = pipelines.run_star_schema(*inputs, f"{path}_star", "2026-02-28", run_ts=RUN)
    summary = pipelines.run_datamart(both, f"{path}_mart", DAY, run_ts=RUN)
    with pytest.raises(QualityError):
        pipelines.run_datamart(both.unionByName(both), f"{path}_mart", DAY, run_ts=RUN)
    assert set(os.listdir(folder)) == kept
    assert report.count() >= 1 and summary.count() == 1
    copy = settle(both)  # outside of a load it stays
    assert copy.count() == 30 and len(os.listdir(folder)) == len(kept) + 1


def test_a_file_is_parsed_once_and_lines_are_copied_once(spark, path, monkeypatch):
    copies = []
    for module in (pipelines, tables, totals, quality):
        monkeypatch.setattr(module, "settle", lambda df, label="x": copies.append(label) or settle(df, label))
    os.makedirs(f"{path}/in")
    with open(f"{path}/in/s_20240115.csv", "w") as f:
        f.write("order_id,customer_id,product_id,quantity,unit_price,total_amount,order_date\no1,c1,p1,1,5.0,5.0,20240114\no1,c1,p2,1,5.0,5.0,20240115\n")
    got = pipelines.run_file_etl(spark, f"{path}/in/s_{{ds_nodash}}.csv", f"{path}/etl", "2024-01-15", max_rows=9)
    assert got.count() == 2 and copies == ["staging", "source"]
    copies.clear()
    pipelines.run_datamart(staging(spark), f"{path}/mart", DAY, run_ts=RUN, strict=False, partition_unit="month")
    first = as_set(spark.read.parquet(f"{path}/mart/sales_cleaned").drop("processed_at"))
    pipelines.run_datamart(staging(spark), f"{path}/mart", DAY, run_ts=RUN, strict=False, partition_unit="month")
    assert as_set(spark.read.parquet(f"{path}/mart/sales_cleaned").drop("processed_at")) == first and copies == ["clean", "summary"] * 2


def test_star_schema_frees_what_it_has_used(spark, path, monkeypatch):
    folder = shared_folder(spark).removeprefix("file:")
    inputs, kept, seen = star_inputs(spark), set(os.listdir(folder)), []
    report = pipelines.daily_sales_report

    def spied(*args, **options):
        seen.append((set(os.listdir(folder)) - kept, spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")))
        return report(*args, **options)

    monkeypatch.setattr(pipelines, "daily_sales_report", spied)
    for root, most in ((path, 10**6), (f"{path}_steps", 1)):
        monkeypatch.setattr(tables, "UPSERT_ROWS", most)
        for day in ("2026-02-27", "2026-02-28", "2026-02-28"):
            got = pipelines.run_star_schema(*inputs, root, day, run_ts=RUN)
    assert as_set(got) == as_set(spark.read.parquet(f"{path}/daily_sales_report")) and got.count() == 2
    facts = [as_list(spark.read.parquet(f"{root}/fact_sales").select("transaction_id", "net_amount")) for root in (path, f"{path}_steps")]
    assert facts[0] == facts[1] and len(facts[0]) == 600
    assert seen == [(set(), "true")] * 6  # the batch is gone before the report


def test_files_of_sales_are_compressed_and_leave_no_copy(spark, path):
    day = "timestamp_ntz'1995-03-01 00:00:00'"
    spark.sql(f"""SELECT id AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, 1.0D AS o_totalprice, {day} AS o_orderdate,
                  IF(id < 3, '1-URGENT', '2-HIGH') AS o_orderpriority FROM range(10)""").write.parquet(f"{path}/orders.parquet")
    spark.sql("""SELECT id AS l_orderkey, id AS l_partkey, id AS l_suppkey, 1 AS l_linenumber, 2.0D AS l_quantity, 10.0D AS l_extendedprice,
                 0.1D AS l_discount FROM range(10)""").write.parquet(f"{path}/lineitem.parquet")
    root, folder = scratch_path(spark, "star"), shared_folder(spark).removeprefix("file:")
    kept = set(os.listdir(folder))
    driver_queries._write_sales_files(spark, path, root)
    assert set(os.listdir(folder)) - kept == {os.path.basename(root)}
    for name, rows in (("first", 7), ("second", 3)):
        written = [f for f in os.listdir(f"{root}/files/{name}".removeprefix("file:")) if f.startswith("part-")]
        assert written and all(f.endswith(".csv.gz") for f in written)
        assert pipelines.read_staging_csv(spark, f"{root}/files/{name}", TRANSACTIONS_RAW).count() == rows
