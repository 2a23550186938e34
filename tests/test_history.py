import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from samples import as_list, as_set

from salesmart.operators import history, timeline

START = datetime(2024, 1, 1)
CHANGES = "user_id bigint, ts timestamp_ntz, event_id bigint, state string"


def change_log(seed, rows=1500, users=4):
    """A third or more of the rows belong to user 0; moments repeat; states may be NULL."""
    rng = random.Random(seed)
    pick = lambda: 0 if rng.random() < 0.4 else rng.randrange(users)
    return [(pick(), START + timedelta(minutes=rng.randrange(6000)), i, rng.choice(["a", "b", None])) for i in range(rows)]


def versions_by_hand(log):
    out = []
    for user in {r[0] for r in log}:
        runs = []
        for row in sorted((r for r in log if r[0] == user), key=lambda r: (r[1], r[2])):
            if not runs or runs[-1][3] != row[3]:
                runs.append(row)
        for this, after in zip(runs, [*runs[1:], None]):
            out.append((user, this[3], this[1], after and after[1], after is None))
    return sorted(out, key=repr)


#: Rows that a bucket may hold: cut to pieces of a few rows, in a few buckets, hardly, and not at all.
BUCKETS = (3, 40, 500, 10**6)


def built(spark, log, bucket):
    return history.scd2_build(spark.createDataFrame(log, CHANGES), "user_id", ["ts", "event_id"], ["state"], bucket)


@pytest.mark.parametrize("bucket", BUCKETS)
def test_version_history_is_the_same_however_keys_are_cut(spark, bucket):
    log = change_log(1)
    assert as_list(built(spark, log, bucket)) == versions_by_hand(log)


@pytest.mark.parametrize("bucket", BUCKETS)
def test_changes_without_a_moment_or_a_key(spark, bucket):
    """A hot key without a value, and moments missing: those changes come first."""
    rng = random.Random(8)
    log = [(None if r[0] == 0 else r[0], None if rng.random() < 0.2 else r[1], *r[2:]) for r in change_log(6)]
    log += [(77, None, 1, "a"), (77, START + timedelta(hours=5), 2, "a"), (77, START + timedelta(hours=7), 3, "b")]
    oldest = datetime(1, 1, 1)
    want = [tuple(None if x == oldest else x for x in v) for v in versions_by_hand([(u, t or oldest, *r) for u, t, *r in log])]
    assert as_list(built(spark, log, bucket)) == sorted(want, key=repr)
    assert sum(v[0] == 77 for v in want) == 2


@pytest.mark.parametrize("moments", ["one hour", "one moment", "none"])
def test_a_key_is_cut_however_its_rows_lie_in_time(spark, moments):
    at = {"one hour": lambda i: START + timedelta(seconds=i % 3600), "one moment": lambda i: START, "none": lambda i: None}[moments]
    log = [(0, at(i), i, "ab"[i // 7 % 2]) for i in range(2000)] + [(1, START, 5000, "a"), (None, None, 5001, "b")]
    line = timeline.cut_keys(spark.createDataFrame(log, CHANGES), "user_id", ["ts", "event_id"], 100)
    sizes = [r["count"] for r in line.hot.groupBy(timeline.PART).count().collect()]
    assert len(sizes) > 14 and sum(sizes) == 2000 and max(sizes) < 300 and line.cold.count() == 2
    oldest = datetime(1, 1, 1)
    want = [tuple(None if x == oldest else x for x in v) for v in versions_by_hand([(u, t or oldest, *r) for u, t, *r in log])]
    assert as_list(built(spark, log, 100)) == sorted(want, key=repr)


def shape(df):
    df.collect()
    seen = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return seen.count("Exchange hashpartitioning"), seen.count("Scan parquet"), seen.count("Sort [")


def test_plans_move_rows_once(spark):
    log = spark.createDataFrame(change_log(3), CHANGES)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        versions = history.scd2_build(log, "user_id", ["ts", "event_id"], ["state"])
        assert shape(versions) == (1, 1, 1)  # one shuffle and one sort of the log, read once
        joined = history.point_in_time_join(log.drop("state"), versions, "user_id", "ts", ["state"])
        assert shape(joined) == (1, 1, 1)
        exchanges, scans, _ = shape(history.scd2_build(log, "user_id", ["ts", "event_id"], ["state"], 50))
        assert exchanges <= 5 and scans <= 3  # cold rows, hot rows twice (the second time reused), edges
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("bucket", BUCKETS)
def test_point_in_time_join_is_the_same_however_keys_are_cut(spark, bucket):
    log = change_log(2, 900)
    versions = versions_by_hand(log)
    rng = random.Random(3)
    facts = [(i, rng.choice([0, 0, 1, 2, 3, 99]), START + timedelta(minutes=rng.randrange(-500, 6500))) for i in range(700)]
    facts += [(1000 + i, v[0], v[2]) for i, v in enumerate(versions[:50])]  # exactly at a start
    want = sorted(
        (
            (i, user, at, state)
            for i, user, at in facts
            for vuser, state, lo, hi, _ in versions
            if user == vuser and lo <= at and (hi is None or at < hi)
        ),
        key=repr,
    )
    got = history.point_in_time_join(
        spark.createDataFrame(facts, "fact_id bigint, user_id bigint, ts timestamp_ntz"),
        spark.createDataFrame(versions, "user_id bigint, state string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"),
        "user_id", "ts", ["state"], rows_per_bucket=bucket,
    )
    assert as_list(got) == want


def test_rows_of_a_key_are_spread_over_buckets(spark):
    log = change_log(4)
    line = timeline.cut_keys(spark.createDataFrame(log, CHANGES), "user_id", ["ts", "event_id"], 20)
    sizes = {tuple(r[0]): r["count"] for r in line.hot.groupBy(timeline.PART).count().collect()}
    assert len(sizes) > 60 and max(sizes.values()) < 70 and sum(sizes.values()) + line.cold.count() == len(log)
    # Buckets of a key do not overlap, and sort as their rows do.
    spans = line.hot.groupBy(timeline.PART).agg(F.min(F.struct("ts", "event_id")).alias("lo"), F.max(F.struct("ts", "event_id")).alias("hi")).collect()
    for key in {r[0].key for r in spans}:
        own = sorted((r for r in spans if r[0].key == key), key=lambda r: r[0].number)
        assert all(tuple(a.hi) < tuple(b.lo) for a, b in zip(own, own[1:]))


def test_latest_row_per_key(spark):
    log = change_log(5)
    got = history.latest_per_key(spark.createDataFrame(log, CHANGES), ["user_id"], ["ts", "event_id"])
    want = {max((r for r in log if r[0] == u), key=lambda r: (r[1], r[2])) for u in {r[0] for r in log}}
    assert as_set(got) == want


def test_change_feed(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    feed = [(1, "x", 1, "UPDATE"), (2, None, 2, "DELETE"), (4, "n", 3, "INSERT"), (4, "m", 4, "UPDATE"), (5, "q", 5, "INSERT"), (5, None, 6, "DELETE"), (9, None, 7, "DELETE")]
    changes = spark.createDataFrame(feed, "id int, v string, seq int, op string")
    assert as_set(history.cdc_apply(target, changes, "id", ["seq"])) == {(1, "x"), (3, "c"), (4, "m")}


VERSIONS = "customer_key bigint, customer_id string, name string, email string, effective_start_date date, effective_end_date date, is_current boolean"


def test_second_type_dimension(spark):
    source = "customer_id string, name string, email string"
    day1, day2, day3, never = date(2024, 1, 1), date(2024, 1, 5), date(2024, 1, 9), date(9999, 12, 31)
    apply = lambda dim, rows, day: history.scd2_apply(dim, spark.createDataFrame(rows, source), "customer_id", ["name", "email"], day)
    first = [("a", "A", None), ("b", "B", "b@x")]
    dim = apply(spark.createDataFrame([], VERSIONS), first, day1)
    dim = apply(dim, [("a", "A", "a@x"), ("b", "B", "b@x"), ("c", "C", None)], day2)
    shown = dim.drop("customer_key")
    want = {
        ("a", "A", None, day1, day2, False), ("a", "A", "a@x", day2, never, True),
        ("b", "B", "b@x", day1, never, True), ("c", "C", None, day2, never, True),
    }
    assert as_set(shown) == want
    again = apply(dim, [("a", "A", "a@x"), ("b", "B", "b@x"), ("c", "C", None)], day3)
    assert as_set(again.drop("customer_key")) == want
    assert dim.select("customer_key").distinct().count() == 4
    back = apply(dim, first, day3)
    opened = back.where("is_current").groupBy("customer_id").count()
    assert as_set(opened) == {("a", 1), ("b", 1), ("c", 1)}
    with pytest.raises(Exception, match="required column"):
        apply(dim, [(None, "X", None)], day3).collect()


def test_changed_rows(spark):
    dim = spark.createDataFrame([("a", "A"), ("b", None), ("c", "C")], "id string, name string")
    source = spark.createDataFrame([("a", "A2"), ("b", None), ("c", None), ("d", "D")], "id string, name string")
    assert as_set(history.changed_rows(source, dim, "id", ["name"])) == {("a", "A2"), ("c", None)}
