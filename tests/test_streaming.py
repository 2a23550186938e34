import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from samples import as_set

from salesmart.operators import star
from salesmart.operators.history import latest_per_key
from salesmart.sources import tables
from salesmart.sources.schemas import TRANSACTIONS_RAW
from salesmart.streaming import ingest

FEED = "user_id bigint, v string, seq bigint, op string"


def drop_files(spark, folder, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").option("header", True).csv(f"{folder}/{i:03d}")


def sale(i, moment):
    return (f"T{i}", f"C{i % 3}", "P", 1, 10.0, 10.0, 0.0, moment.strftime("%Y-%m-%d %H:%M:%S"))


def test_each_file_is_loaded_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = spark.createDataFrame([], "id int, v string").schema
    drop_files(spark, source, [[(1, "a")], [(2, "b")]], schema)
    run = lambda: ingest.ingest_available_files(spark, f"{source}/*", schema, target, progress, files_per_batch=1)
    assert as_set(run()) == {(1, "a"), (2, "b")}
    assert run().count() == 2
    drop_files(spark, f"{source}/more", [[(3, "c")]], schema)
    spark.createDataFrame([(3, "c")], schema).coalesce(1).write.option("header", True).csv(f"{source}/009")
    assert as_set(run()) == {(1, "a"), (2, "b"), (3, "c")}


@pytest.mark.parametrize("order", ["as sent", "reversed", "one batch"])
def test_change_feed_ends_in_the_same_state(spark, tmp_path, order):
    rng = random.Random(7)
    rows = [(rng.randrange(8), f"v{i}", i, rng.choice(["INSERT", "UPDATE", "DELETE"])) for i in range(60)]
    batches = [rows] if order == "one batch" else [rows[:20], rows[20:40], rows[40:]]
    if order == "reversed":
        batches.reverse()
    source = str(tmp_path / "in")
    schema = spark.createDataFrame([], FEED).schema
    drop_files(spark, source, batches, schema)
    stream = ingest.file_stream(spark, f"{source}/*", schema, files_per_batch=1)
    got = ingest.stream_cdc_apply(stream, str(tmp_path / "state"), str(tmp_path / "progress"), "user_id", ["seq"])
    want = latest_per_key(spark.createDataFrame(rows, FEED), ["user_id"], ["seq"]).where("op <> 'DELETE'")
    assert as_set(got) == as_set(want)
    assert as_set(got) == as_set(ingest.stream_cdc_apply(stream, str(tmp_path / "state"), str(tmp_path / "progress"), "user_id", ["seq"]))


def folder_bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_a_small_batch_writes_a_small_part_of_the_state(spark, tmp_path):
    schema = spark.createDataFrame([], FEED).schema
    source, state, progress = tmp_path / "in", tmp_path / "state", str(tmp_path / "progress")
    spark.range(20000).selectExpr("id", "uuid()", "id", "'INSERT'").toDF(*schema.names).write.option("header", True).csv(f"{source}/000")
    run = lambda: ingest.stream_cdc_apply(ingest.file_stream(spark, f"{source}/*", schema), str(state), progress, "user_id", ["seq"])
    assert run().count() == 20000
    before = folder_bytes(state)
    kept = {f: f.stat().st_mtime_ns for f in state.rglob("*.parquet")}
    changes = [(5, "new", 30000, "UPDATE"), (17, None, 30001, "DELETE"), (20001, "more", 30002, "INSERT")]
    spark.createDataFrame(changes, schema).coalesce(1).write.option("header", True).csv(f"{source}/001")
    got = run()
    assert got.count() == 20000 and as_set(got.where("user_id in (5, 17, 20001)").select("user_id", "v")) == {(5, "new"), (20001, "more")}
    written = [f for f in state.rglob("*.parquet") if f not in kept]
    assert 0 < sum(f.stat().st_size for f in written) < before / 10
    assert all(f.stat().st_mtime_ns == kept[f] for f in state.rglob("*.parquet") if f in kept)
    buckets = [f.parent.name for f in state.rglob("*.parquet")]
    assert len({*buckets}) == len(ingest.newest_buckets(spark, str(state))) == 64  # a bucket lies in one version


def test_a_batch_cut_off_is_folded_again(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], FEED).schema
    source, state, progress = (str(tmp_path / n) for n in ("in", "state", "progress"))
    feed = [[(i, "a", i, "INSERT") for i in range(200)], [(i, "b", 1000 + i, "UPDATE") for i in range(100)]]
    drop_files(spark, source, feed[:1], schema)
    run = lambda: ingest.stream_cdc_apply(ingest.file_stream(spark, f"{source}/*", schema), state, progress, "user_id", ["seq"])
    run()
    spark.createDataFrame(feed[1], schema).coalesce(1).write.option("header", True).csv(f"{source}/001")
    dropped = []

    def fail(session, path):
        dropped.append(path)
        if len(dropped) > 5:
            raise RuntimeError("cut off")
        drop(session, path)

    drop = ingest.drop_folder
    monkeypatch.setattr(ingest, "drop_folder", fail)
    with pytest.raises(Exception, match="cut off"):
        run()
    monkeypatch.setattr(ingest, "drop_folder", drop)
    assert as_set(run(), "user_id", "v") == {(i, "b" if i < 100 else "a") for i in range(200)}


def test_late_and_repeated_sales_are_kept_once(spark, tmp_path):
    start = datetime(2024, 1, 10, 12)
    on_time = [sale(i, start + timedelta(hours=i)) for i in range(5)]
    on_time += [(None, *sale(7, start)[1:]), (None, *sale(8, start + timedelta(hours=1))[1:])]
    late = [sale(100, start - timedelta(days=30)), on_time[0], on_time[4], on_time[5], sale(6, start), (None, *sale(9, start + timedelta(hours=2))[1:])]
    source = str(tmp_path / "in")
    drop_files(spark, source, [on_time, late, late], TRANSACTIONS_RAW)
    stream = ingest.file_stream(spark, f"{source}/*", TRANSACTIONS_RAW, files_per_batch=1)
    got = ingest.stream_fact_sales(stream, str(tmp_path / "fact"), str(tmp_path / "progress"))
    names = sorted(str(r.transaction_id) for r in got.collect())
    assert names == sorted(["None"] * 3 + [f"T{i}" for i in (0, 1, 2, 3, 4, 6, 100)])


def test_bounded_form_drops_repeats_within_the_delay(spark, tmp_path):
    start = datetime(2024, 1, 10, 12)
    on_time = [sale(i, start + timedelta(hours=i)) for i in range(5)]
    source = str(tmp_path / "in")
    drop_files(spark, source, [on_time, [on_time[4], sale(9, start + timedelta(hours=6))]], TRANSACTIONS_RAW)
    stream = ingest.file_stream(spark, f"{source}/*", TRANSACTIONS_RAW, files_per_batch=1)
    got, late, repeated = ingest.stream_fact_sales_bounded(stream, str(tmp_path / "fact"), str(tmp_path / "progress"))
    assert got.count() == 6 and got.select("transaction_id").distinct().count() == 6 and (late, repeated) == (0, 1)
    assert got.agg(F.max("transaction_date")).first()[0] == start.date()


def test_bounded_form_counts_what_comes_too_late(spark, tmp_path):
    start = datetime(2024, 1, 10, 12)
    source, target, progress = (str(tmp_path / n) for n in ("in", "fact", "progress"))
    batches = [[sale(1, start), sale(2, start + timedelta(days=5))], [sale(3, start), sale(1, start), sale(4, start + timedelta(days=5)), sale(2, start + timedelta(days=5))]]
    late = repeated = 0
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, TRANSACTIONS_RAW).coalesce(1).write.option("header", True).csv(f"{source}/{i}")
        got = ingest.stream_fact_sales_bounded(ingest.file_stream(spark, f"{source}/*", TRANSACTIONS_RAW), target, progress)
        late, repeated = late + got.late, repeated + got.repeated
    assert {r.transaction_id for r in got.sales.collect()} == {"T1", "T2", "T4"} and (late, repeated) == (2, 1)


def test_conflicting_rows_end_alike_in_batch_and_stream(spark, tmp_path):
    def told(i, moment, amount):
        return (f"T{i}", "C", "P", 1, amount, amount, 0.0, moment.strftime("%Y-%m-%d %H:%M:%S"))

    start = datetime(2024, 1, 10, 12)
    files = [
        [told(1, start, 10.0), told(1, start, 20.0), told(2, start + timedelta(hours=1), 5.0), told(2, start, 50.0), told(3, start, 1.0)],
        [told(3, start, 0.5), told(1, start, 15.0)],
    ]
    want = {("T1", 15.0), ("T2", 5.0), ("T3", 0.5)}
    for turn, order in enumerate((1, -1)):
        source, target, progress = (str(tmp_path / f"{n}{turn}") for n in ("in", "fact", "progress"))
        batch = str(tmp_path / f"batch{turn}")
        for i, rows in enumerate([*files, files[1]]):
            spark.createDataFrame(rows[::order], TRANSACTIONS_RAW).coalesce(1).write.option("header", True).csv(f"{source}/{i}")
            got = ingest.stream_fact_sales(ingest.file_stream(spark, f"{source}/*", TRANSACTIONS_RAW), target, progress)
            tables.upsert_days(
                star.fact_sales(spark.createDataFrame(rows[::order], TRANSACTIONS_RAW)), batch, "transaction_date", star.FACT_IDENTITY,
                newest=star.FACT_NEWEST)
        for stored in (got, spark.read.parquet(batch)):
            assert {(r.transaction_id, float(r.total_amount)) for r in stored.collect()} == want


def test_undated_sales_are_loaded_once(spark, tmp_path):
    undated = [(f"T{i}", "C", "P", 1, 10.0, 10.0, 0.0, None) for i in range(3)]
    source = str(tmp_path / "in")
    drop_files(spark, source, [undated, undated[:2], [sale(9, datetime(2024, 1, 1))]], TRANSACTIONS_RAW)
    stream = ingest.file_stream(spark, f"{source}/*", TRANSACTIONS_RAW, files_per_batch=1)
    got = ingest.stream_fact_sales(stream, str(tmp_path / "fact"), str(tmp_path / "progress"))
    assert sorted(r.transaction_id for r in got.collect()) == ["T0", "T1", "T2", "T9"]
