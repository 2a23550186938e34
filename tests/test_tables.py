import glob
import os
import re
import time
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType
from samples import RUN, as_list, as_set

from salesmart.operators import incremental
from salesmart.plans import reports
from salesmart.session import freed_shuffles, scratch_path, settle, shared_folder
from salesmart.sources import files, schemas, tables


def days(spark, *rows):
    return spark.createDataFrame(list(rows), "day string, v int").withColumn("day", F.to_date("day"))


def stored(spark, path):
    return {(str(r.day), r.v) for r in spark.read.parquet(path).collect()}


def write_text(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode("utf-8"))
    return str(folder / name)


def test_csv_with_byte_order_mark_and_schema(spark, tmp_path):
    file = write_text(tmp_path / "in", "products_20240115.csv", "﻿product_id,product_name,category,subcategory,unit_price\nP1,Fırın,Home,Sub,12.5\n")
    template = file.replace("20240115", "{ds_nodash}")
    df = files.read_staging_csv(spark, files.dated_path(template, "2024-01-15"), schemas.PRODUCTS_RAW)
    assert as_list(df) == [("P1", "Fırın", "Home", "Sub", 12.5)]
    assert dict(files.read_staging_csv(spark, file, infer=True).dtypes)["unit_price"] == "double"
    with pytest.raises(ValueError):
        files.read_staging_csv(spark, file)
    assert files.dated_path("a/{ds}.csv", date(2024, 1, 2)) == "a/2024-01-02.csv"


def test_files_by_name_and_glob(spark, tmp_path):
    for name, ids in (("north", "1\n2"), ("south", "3")):
        write_text(tmp_path / "in", f"{name}.csv", f"id\n{ids}\n")
    loaded = files.load_files_by_name(spark, str(tmp_path / "in" / "*.csv"), "id int", str(tmp_path / "out"))
    assert as_set(loaded, "table_name", "id") == {("north", 1), ("north", 2), ("south", 3)}
    schema = StructType.fromJson(loaded.select("id").schema.jsonValue())
    assert files.read_staging_csv(spark, str(tmp_path / "in" / "*.csv"), schemas.schema_from_json(schema.json())).count() == 3


def test_required_columns(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", None)], "id string, v int")
    good, rejected = files.enforce_required(df, ["id", "v"])
    assert as_list(good) == [("a", 1)] and rejected.count() == 2
    with pytest.raises(Exception, match="required column is NULL: v"):
        files.require_filled(df.where("id = 'c'"), ["id", "v"]).count()
    assert schemas.required_columns(schemas.ORDER_LINES_RAW) == schemas.ORDER_LINES_RAW.names


def test_dead_letters_under_every_projection(spark, tmp_path):
    file = write_text(tmp_path / "in", "x.csv", "order_id,customer_id,product_id,quantity,unit_price,total_amount,order_date\n1,c,p,2,1.5,3.0,20240115\n2,c,p,two,1.5,3.0,20240115\n3,c,p,1\n")
    good, dead = files.split_dead_letters(spark, file, schemas.ORDER_LINES_RAW, "b1", RUN)
    assert good.count() == 1 and dead.count() == 2
    assert as_list(good, "order_id") == [("1",)]
    assert as_set(dead.select("batch_id", "timestamp")) == {("b1", RUN)}
    assert all(r.error_message.startswith("line does not match schema: ") for r in dead.collect())


def test_write_dispositions(spark, path):
    rows = days(spark, ("2024-01-01", 1))
    tables.write_if_empty(rows.where("false"), path)
    tables.write_if_empty(rows, path)
    with pytest.raises(ValueError):
        tables.write_if_empty(rows, path)
    tables.write_append(days(spark, ("2024-01-02", 2)), path)
    assert stored(spark, path) == {("2024-01-01", 1), ("2024-01-02", 2)}
    tables.replace_from_itself(spark.read.parquet(path).withColumn("v", F.col("v") * 10), path)
    assert stored(spark, path) == {("2024-01-01", 10), ("2024-01-02", 20)}
    tables.write_truncate(rows, path)
    assert stored(spark, path) == {("2024-01-01", 1)}


def test_a_swap_that_was_cut_off_is_settled(spark, path):
    old, new = days(spark, ("2024-01-01", 1)), days(spark, ("2024-01-01", 2))
    tables.write_truncate(old, path + tables.OLD)
    new.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path + tables.NEW)
    assert tables.table_exists(spark, path) and stored(spark, path) == {("2024-01-01", 1)}
    tables.rename_folder(spark, path, path + tables.OLD)
    tables.write_truncate(new, path + tables.NEW)
    assert tables.table_exists(spark, path) and stored(spark, path) == {("2024-01-01", 2)}
    tables.replace_from_itself(spark.read.parquet(path).withColumn("v", F.col("v") + 1), path)
    assert stored(spark, path) == {("2024-01-01", 3)}
    assert not tables.folder_exists(spark, path + tables.OLD) and not tables.folder_exists(spark, path + tables.NEW)


def test_partition_reloads_are_idempotent_and_complete(spark, path):
    tables.overwrite_partitions(days(spark, ("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)), path, ["day"])
    for _ in range(2):
        tables.overwrite_partitions(days(spark, ("2024-01-02", 5), ("2024-01-02", 6)), path, ["day"], ["v"])
        assert stored(spark, path) == {("2024-01-01", 1), ("2024-01-02", 5), ("2024-01-02", 6), ("2024-01-03", 3)}
    tables.reload_days(days(spark, ("2024-01-03", 9)), path, "day", "2024-01-02", "2024-01-03")
    assert stored(spark, path) == {("2024-01-01", 1), ("2024-01-03", 9)}


def test_a_table_can_reload_partitions_computed_from_itself(spark, path):
    tables.overwrite_partitions(days(spark, ("2024-01-01", 1), ("2024-01-02", 2)), path, ["day"])
    again = spark.read.parquet(path).where("day = '2024-01-02'").withColumn("v", F.col("v") + 1)
    tables.overwrite_partitions(again.select("day", "v"), path, ["day"])
    assert stored(spark, path) == {("2024-01-01", 1), ("2024-01-02", 3)}


def test_expiry_and_ranges(spark, path):
    tables.overwrite_partitions(days(spark, *[(f"2024-01-{d:02d}", d) for d in range(1, 11)]), path, ["day"])
    kept = tables.retained(spark.read.parquet(path), "day", F.lit("2024-01-10").cast("date"), 3)
    assert {v for _, v in {(r.day, r.v) for r in kept.collect()}} == {7, 8, 9, 10}
    assert len(tables.expire_partitions(spark, path, "day", date(2024, 1, 10), 3)) == 6
    assert {v for _, v in stored(spark, path)} == {7, 8, 9, 10}
    ranged = tables.read_partitioned(spark, path, "day", "2024-01-08", "2024-01-09")
    assert {r.v for r in ranged.collect()} == {8, 9}
    assert "PartitionFilters: [isnotnull(day" in ranged._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        tables.read_partitioned(spark, path, "day", None, "2024-01-09")


def test_growing_schema(spark, path):
    schema = tables.append_evolving(spark.sql("select 1 as a, 'x' as b"), path)
    schema = tables.append_evolving(spark.sql("select 2 as a, 1.5D as c"), path, schema)
    want = {(1, "x", None), (2, None, 1.5)}
    assert as_set(tables.read_evolving(spark, path, schema), "a", "b", "c") == want
    assert as_set(tables.read_evolving(spark, path), "a", "b", "c") == want
    with pytest.raises(ValueError, match="'a'"):
        tables.append_evolving(spark.sql("select 'text' as a"), path)


def test_catalog_table_is_made_once(spark, path):
    for _ in range(2):
        made = tables.ensure_table(
            spark, "made_once", schemas.SAMPLE_SALES, partition_by=["order_date"], cluster_by=["customer_id"],
            comment="It's sample data", labels={"team": "data"}, location=path,
        )
    assert made.columns[-1] == "order_date" and made.count() == 0
    described = {r.col_name: r.data_type for r in spark.sql("describe extended made_once").collect()}
    assert described["Comment"] == "It's sample data" and "clustered_by=customer_id" in described["Table Properties"]
    spark.sql("drop table made_once")


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "ş")], "a int, b string")
    for fmt in ("csv", "json", "parquet"):
        tables.export_table(df, str(tmp_path / fmt), fmt)
    assert as_list(spark.read.option("header", True).csv(str(tmp_path / "csv"))) == [("1", "ş")]
    assert as_list(files.read_staging_json(spark, str(tmp_path / "json"), df.schema)) == [(1, "ş")]
    with pytest.raises(ValueError, match="avro"):
        tables.export_table(df, str(tmp_path / "avro"), "avro")


def test_union_audit_and_sample(spark):
    both = tables.union_sources(spark.sql("select 1 as a, 2 as b"), spark.sql("select 3 as a"))
    assert as_set(both) == {(1, 2), (3, None)}
    assert as_set(tables.add_audit(both, "at", RUN).select("at")) == {(RUN,)}
    assert as_list(files.sample_rows(both, ["a"], 1, [F.desc("a")])) == [(3,)]


def test_incremental_marks(spark):
    schema = "id int, v string, n int"
    target, empty = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], schema), spark.createDataFrame([], schema)
    source = spark.createDataFrame([(1, "z", 5), (2, "c", 21), (3, "d", 30)], schema)
    assert as_set(incremental.incremental_by_timestamp(target, source, "id", "n")) == {(1, "a", 10), (2, "c", 21), (3, "d", 30)}
    assert as_set(incremental.incremental_by_version(target, source, "n")) == {(1, "a", 10), (2, "b", 20), (2, "c", 21), (3, "d", 30)}
    assert incremental.incremental_by_version(empty, source, "n").count() == 3
    assert incremental.high_water_mark(target, "n").first()[0] == 20


def test_rollup_refresh_equals_rebuild(spark):
    sales = days(spark, ("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 3))
    stale = incremental.daily_rollup(sales.where("v > 1"), "day", "v")
    fresh = incremental.refresh_daily_rollup(stale, sales, sales.where("v = 1"), "day", "v")
    assert as_set(fresh) == as_set(incremental.daily_rollup(sales, "day", "v"))


def test_rollup_refresh_reads_the_changed_days_only(spark, path):
    sales = days(spark, ("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-03", 4))
    tables.overwrite_partitions(sales, path, ["day"])
    stored = spark.read.schema(sales.schema).parquet(path)
    stale = settle(incremental.daily_rollup(sales.where("v > 1"), "day", "v"))
    fresh = incremental.refresh_daily_rollup(stale, stored, sales.where("v = 1"), "day", "v")
    assert as_set(fresh) == as_set(incremental.daily_rollup(sales, "day", "v"))
    seen = fresh._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(day#\d+\), \(day#\d+ = 2024-01-01\)\]", seen)
    assert incremental.refresh_daily_rollup(stale, stored, sales.where("false"), "day", "v") is stale


def test_the_newest_row_wins_in_any_order(spark):
    rows = [("a", 1, 5), ("a", 2, 3), ("a", 2, 4), ("b", None, 9), ("b", 0, 1), (None, 1, 1), (None, 1, 1), (None, 1, 2)]
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame(some, "id string, at int, v int").repartition(3)
        want = [("a", 2, 4), ("b", 0, 1), (None, 1, 1), (None, 1, 2)]
        assert as_list(tables.once(df, ["id"], ["at"])) == sorted(want, key=repr) and tables.once(df, ["id"], ["at"]).columns == df.columns
        assert as_list(tables.once(df.select("id"), ["id"])) == [("a",), ("b",), (None,)]


def test_scratch_is_shared_and_fresh(spark):
    folder = shared_folder(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x") and scratch_path(spark, "x").startswith(folder)
    df = settle(spark.range(5).withColumn("v", F.lit("a")))
    assert df.count() == 5 and "Scan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_malformed_cells_fail_the_load_unless_tolerated(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,amount\n1,2.5\n2,abc\n")
    schema = StructType([StructField("id", LongType()), StructField("amount", DoubleType())])
    strict = files.read_staging_csv(spark, str(tmp_path), schema)
    for read in (strict, strict.select("id")):  # also where the bad column is not asked for
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            read.collect()
    assert as_set(files.read_staging_csv(spark, str(tmp_path), schema, tolerant=True)) == {(1, 2.5), (2, None)}
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "bad.json").write_text('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.read_staging_json(spark, str(tmp_path / "j"), schema).collect()
    assert files.read_staging_json(spark, str(tmp_path / "j"), schema, tolerant=True).count() == 2


def test_upserts_touch_only_their_days(spark, path):
    schema, identity = "id string, day date, v int", ["day", "id"]
    days = [date(2024, 1, d) for d in (1, 2, 3)]

    def upsert(*rows):
        tables.upsert_days(spark.createDataFrame(rows, schema), path, "day", identity)
        return as_list(spark.read.schema(schema).parquet(path), "id", "day", "v")

    first = [("a", days[0], 1), (None, days[0], 2), ("b", days[1], 3)]
    assert upsert(*first, first[0], first[1]) == sorted(first, key=repr)
    kept = glob.glob(f"{path}/day=2024-01-02/*.parquet")
    want = [("a", days[0], 9), (None, days[0], 2), (None, days[0], 4), ("b", days[1], 3), ("c", days[2], 5)]
    late = [("a", days[0], 9), (None, days[0], 2), (None, days[0], 4), ("c", days[2], 5)]
    assert upsert(*late) == upsert(*late) == sorted(want, key=repr)
    assert glob.glob(f"{path}/day=2024-01-02/*.parquet") == kept
    tables.upsert_days(spark.createDataFrame([], schema), path, "day", identity)
    assert as_list(spark.read.schema(schema).parquet(path), "id", "day", "v") == sorted(want, key=repr)


def test_upserts_keep_the_rows_without_a_day(spark, path):
    def upsert(*rows):
        df = spark.createDataFrame(list(rows), "id string, day date, v int")
        tables.upsert_days(df, path, "day", ["day", "id"])
        return {(r.id, r.v) for r in spark.read.schema(df.schema).parquet(path).collect()}

    upsert(("a", None, 1), ("b", None, 2), ("c", date(2024, 1, 1), 3))
    assert upsert(("d", None, 4), ("a", None, 1)) == {("a", 1), ("b", 2), ("c", 3), ("d", 4)}


def test_newest_days_come_from_the_newest_partitions(spark, path):
    rows = days(spark, *[(f"2024-{m:02d}-{d:02d}", m * 100 + d) for m in (1, 2, 3, 5) for d in (1, 2, 9)], ("2024-05-09", 7))
    tables.write_truncate(rows.withColumn("month", F.date_trunc("month", "day").cast("date")), path, ["month"])
    for n, months in ((1, 1), (3, 1), (4, 2), (7, 4), (12, 4), (50, 4)):
        got = reports.read_newest_days(spark, path, "month", "day", n)
        want = sorted({r[0] for r in rows.select("day").collect()})[-n:]
        assert as_set(got) == as_set(rows.where(F.col("day").isin(want)).select(*got.columns))
        seen = got._jdf.queryExecution().executedPlan().toString()
        assert sum(f"2024-{m:02d}-01" in seen.split("PartitionFilters: [")[1].split("], PushedFilters")[0] for m in (1, 2, 3, 5)) == months


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_picking_rows_reads_them_once(spark, path):
    rows = [("a", 1.5, 1), ("a", 1.5, 2), (None, 0.0, 3), (None, -0.0, 3), (None, None, 3), ("b", None, 4)]
    df = settle(spark.createDataFrame(rows, "id string, x double, v int"))
    assert as_list(tables.once(df, ["id"])) == sorted([("a", 1.5, 2), (None, 0.0, 3), (None, None, 3), ("b", None, 4)], key=repr)
    new = settle(spark.createDataFrame([("a", 9.0, 9), (None, None, 3), (None, 0.0, 4)], df.schema))
    assert as_list(tables.absent(df, new, ["id"])) == sorted([(None, 0.0, 3), (None, -0.0, 3), ("b", None, 4)], key=repr)
    assert scans(tables.once(df, ["id"])) == 1 and scans(tables.absent(df, new, ["id"])) == 2


def test_upserts_of_settled_rows_make_no_copies(spark, path, monkeypatch):
    copies = []
    monkeypatch.setattr(tables, "settle", lambda df, label="x": copies.append(label) or settle(df, label))
    df = spark.createDataFrame([("a", date(2024, 1, 1), 1), (None, date(2024, 1, 1), 2), ("b", date(2024, 1, 2), 3)], "id string, day date, v int")
    for _ in range(2):
        tables.upsert_days(settle(df), path, "day", ["day", "id"], settled=True)
        assert as_set(spark.read.schema(df.schema).parquet(path).select(*df.columns)) == as_set(df) and not copies
    tables.upsert_days(df.where("v = 3").withColumn("v", F.lit(4)), path, "day", ["day", "id"])
    assert as_set(spark.read.schema(df.schema).parquet(path).select("id", "v")) == {("a", 1), (None, 2), ("b", 4)} and copies == ["upsert"]


@pytest.mark.parametrize("unit", ["day", "month"])
def test_large_upserts_go_in_steps_with_the_same_result(spark, path, unit, monkeypatch):
    schema, ids = "id string, day date, v int", ["day", "id"]
    parts = (["v"], F.trunc("day", "MM"), "month") if unit == "month" else (["v"],)
    day = lambda m, d: date(2024, m, d)
    first = [("a", day(1, 1), 1), ("b", day(1, 2), 2), (None, day(2, 1), 3), ("c", day(3, 9), 4), ("d", None, 5), (None, day(1, 2), 7)]
    second = [("a", day(1, 1), 6), ("a", day(1, 1), 8), (None, day(2, 1), 3), (None, day(2, 1), 9), ("c", day(3, 9), 0), ("d", None, 5),
              ("e", None, 5), ("a", day(5, 1), 1)]
    kept = [("a", day(1, 1), 8), ("b", day(1, 2), 2), (None, day(1, 2), 7), (None, day(2, 1), 3), (None, day(2, 1), 9), ("c", day(3, 9), 0),
            ("d", None, 5), ("e", None, 5), ("a", day(5, 1), 1)]
    writes, copies, write = [], [], tables.overwrite_partitions
    monkeypatch.setattr(tables, "overwrite_partitions", lambda df, *rest: (writes.append(df), write(df, *rest)))
    monkeypatch.setattr(tables, "settle", lambda df, label="x": copies.append(label) or settle(df, label))
    for rows_per_step, steps in ((10**6, 1), (1, 5)):
        monkeypatch.setattr(tables, "UPSERT_ROWS", rows_per_step)
        for flags in ({}, {"settled": True, "picked": False}):
            target = f"{path}{rows_per_step}{len(flags)}"
            for rows in (first, second, second):
                writes.clear()
                df = spark.createDataFrame(rows, schema)
                touched = tables.upsert_days(settle(df) if flags else df, target, "day", ids, *parts, **flags)
                assert len(writes) == (1 if steps == 1 else len(touched))
            assert as_list(spark.read.schema(schema).parquet(target).select("id", "day", "v")) == sorted(kept, key=repr)
    # An identity without the day may be held by another partition: all are looked at together.
    for v in (1, 2):
        writes.clear()
        tables.upsert_days(spark.createDataFrame([("x", day(v, 1), v), ("y", day(3, 1), v)], schema), f"{path}_wide", "day", ["id"], *parts)
        assert len(writes) == 1


def test_steps_hold_about_as_many_rows(monkeypatch):
    monkeypatch.setattr(tables, "UPSERT_ROWS", 10)
    monkeypatch.setattr(tables, "UPSERT_STEPS", 4)
    assert tables._steps({3: 4, 1: 4, 2: 1, None: 2}) == [[None, 1, 2], [3]]
    assert tables._steps({i: 10 for i in range(8)}) == [[0, 1], [2, 3], [4, 5], [6, 7]]
    assert tables._steps({1: 1, 2: 500, 3: 1}) == [[1], [2], [3]]
    assert tables._steps({"": 99, None: 99, "a": 99}) == [[None, ""], ["a"]]


def test_shuffles_end_with_their_query(spark, path):
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {n for d in disks.localDirs() for _, _, names in os.walk(d.getPath()) for n in names if n.startswith("shuffle_")}
    shuffled = lambda: spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    before = held()
    settle(shuffled())
    left = held()
    assert left - before  # until the driver next collects its garbage
    with freed_shuffles(spark):
        settle(shuffled())
        frame = shuffled()
        assert as_set(frame) == as_set(frame) and frame.count() == 7  # what is run again is computed anew
    until = time.time() + 20
    while held() - left and time.time() < until:
        time.sleep(0.2)
    assert not held() - left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
