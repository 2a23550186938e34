"""Distinct counts from stored days."""

import glob
import random

import pytest
from pyspark.sql import functions as F
from samples import as_set

from salesmart.operators import daycounts


def total():
    return F.count(F.lit(1)).alias("n")


def month():
    return F.date_trunc("month", "day").cast("date")


def visits(spark, n=4000, seed=1):
    r = random.Random(seed)
    people = [0, 32766, 32767, 32768, 65535, 65536, 10**9, *range(100, 900)]
    rows = [(f"2024-0{r.randint(1, 3)}-{r.randint(1, 28):02d}", r.choice(people), r.choice([None, r.randint(0, 40)])) for _ in range(n)]
    return spark.createDataFrame(rows, "day string, person long, item long").withColumn("day", F.col("day").cast("date")).repartition(4)


def test_months_from_days(spark, path):
    rows = visits(spark)
    daycounts.store_days(rows, path, "day", ["person"], ["person", "item"], total())
    got = daycounts.merged_counts(spark, path, month(), ["person"], ["person", "item"], F.sum("n").alias("n"))
    want = rows.groupBy(month().alias("period")).agg(total(), F.count_distinct("person").alias("p"), F.count_distinct("item").alias("i"))
    assert as_set(got.select("period", "n", "exact_person", "exact_item")) == as_set(want)
    assert got.where(F.abs(F.col("approx_person") - F.col("exact_person")) > 0.05 * F.col("exact_person")).isEmpty()


def test_windows_from_days(spark, path):
    rows = visits(spark, 600)
    daycounts.store_days(rows, path, "day", [], ["person", "item"], total())
    got = daycounts.rolling_counts(spark, path, "day", 7, ["person", "item"])
    days = rows.select(F.col("day").alias("period")).distinct()
    near = days.join(rows, F.col("day").between(F.date_sub("period", 6), F.col("period")))
    assert as_set(got) == as_set(near.groupBy("period").agg(F.count_distinct("person"), F.count_distinct("item")))


def test_changed_days_alone_are_written(spark, path):
    rows = visits(spark)
    changed = rows.where("day in ('2024-02-03', '2024-03-01')")
    daycounts.store_days(rows.exceptAll(changed), path, "day", ["person"], ["person"], total())
    months = {str(r[0])[:7] for r in changed.select("day").distinct().collect()}
    before = {f for f in glob.glob(f"{path}/*/store_month=*/*.parquet")}
    daycounts.refresh_days(rows, path, "day", changed, ["person"], ["person"], total())
    after = {f for f in glob.glob(f"{path}/*/store_month=*/*.parquet")}
    assert {f.split("store_month=")[1][:7] for f in before ^ after} == months and len(months) < 3
    whole = lambda: daycounts.merged_counts(spark, path, F.lit(1), ["person"], ["person"], F.sum("n").alias("n")).first()
    assert (whole().n, whole().exact_person) == (rows.count(), rows.select("person").distinct().count())
    left = rows.where("month(day) <> 2")
    daycounts.refresh_days(left, path, "day", rows.where("month(day) = 2"), ["person"], ["person"], total())
    assert (whole().n, whole().exact_person) == (left.count(), left.select("person").distinct().count())


def test_numbers_below_zero_fail(spark):
    with pytest.raises(Exception, match="below zero: -1"):
        daycounts.day_bits(spark.sql("select date'2024-01-01' as day, -1L as person"), "day", ["person"]).collect()
    assert daycounts.day_bits(spark.sql("select date'2024-01-01' as day, cast(null as long) as person"), "day", ["person"]).isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_are_made_after_pieces_have_moved(spark, path):
    rows = visits(spark, 600).unionByName(spark.sql("select date'1969-12-29' as day, 7L as person, null as item"))
    daycounts.store_days(rows, path, "day", [], ["person", "item"], total())
    for days in (1, 7, 45):
        got = daycounts.rolling_counts(spark, path, "day", days, ["person", "item"])
        near = rows.select(F.col("day").alias("period")).distinct().join(rows, F.col("day").between(F.date_sub("period", days - 1), F.col("period")))
        assert as_set(got) == as_set(near.groupBy("period").agg(F.count_distinct("person"), F.count_distinct("item")))
    united = plan(got).split("bitmap_or_agg")[-1]  # from the innermost aggregate down
    assert united.index("explode") < united.index("Exchange hashpartitioning(block")
