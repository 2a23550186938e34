"""Bucketed tables: results, plans without an exchange, hot keys, daily additions."""

import uuid

import pytest
from pyspark.sql import functions as F

from salesmart.sources import clustered


def name():
    return "c_" + uuid.uuid4().hex


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def stored(spark, path):
    """Sales of 300 customers, a third of them by customer 7 and some by nobody; all customers but two."""
    sales = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 300).alias("customer_key"),
        F.col("id").alias("sale"), (F.col("id") % 11).alias("amount"))
    customers = spark.range(2, 300).select(F.col("id").alias("customer_key"), F.concat(F.lit("n"), F.col("id")).alias("city"))
    facts = clustered.write_clustered(sales, name(), "customer_key", f"{path}/sales", 8)
    return sales, customers, facts, clustered.write_clustered(customers, name(), "customer_key", f"{path}/customers", facts.buckets, unique=True)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_hot_key_is_kept_apart(stored):
    sales, _, facts, _ = stored
    assert facts.hot_keys == (7,) and facts.hot().count() == sales.where("customer_key = 7").count()
    assert rows(facts.rows().select(*sales.columns)) == rows(sales)
    assert clustered.open_clustered(facts.spark, facts.name) == facts


def test_join_and_totals(stored):
    sales, customers, facts, people = stored
    joined = sales.join(customers, "customer_key")
    assert rows(clustered.join_clustered(facts, people).select(*joined.columns)) == rows(joined)
    totals = [F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total")]
    by_key = clustered.totals_by_key(facts, people, ["city"], *totals)
    assert rows(by_key) == rows(joined.groupBy("customer_key", "city").agg(*totals).select("customer_key", "n", "total", "city"))


def test_no_exchange_above_the_fact(spark, stored):
    _, _, facts, people = stored
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        cold = clustered.Clustered(spark, facts.name, facts.key, facts.buckets)  # without its hot rows
        for df in (clustered.join_clustered(cold, people), clustered.totals_by_key(cold, people, ["city"], F.sum("amount").alias("total"))):
            seen = plan(df)
            assert "Exchange" not in seen and "SortMergeJoin" in seen and "SelectedBucketsCount: 8 out of 8" in seen
        # Hot rows meet a handful of customers where they lie; only their sums move.
        seen = plan(clustered.join_clustered(facts, people))
        assert "hashpartitioning" not in seen and seen.count("BroadcastExchange") == 1
        seen = plan(clustered.totals_by_key(facts, people, ["city"], F.sum("amount").alias("total")))
        assert all("partial_sum" in part for part in seen.split("Exchange hashpartitioning")[1:])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_day_is_added(spark, stored):
    sales, customers, facts, people = stored
    more = spark.createDataFrame([(7, 9001, 3), (8, 9002, 4), (None, 9003, 5), (1000, 9004, 6)], sales.schema).select("amount", "customer_key", "sale")
    clustered.append_clustered(more, clustered.open_clustered(spark, facts.name))
    both = sales.unionByName(more)
    assert rows(facts.rows().select(*sales.columns)) == rows(both)
    assert rows(clustered.join_clustered(facts, people).select("sale", "city")) == rows(both.join(customers, "customer_key").select("sale", "city"))


def test_many_rows_without_a_key(spark, path):
    sales = spark.range(1000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), "id")
    table = clustered.write_clustered(sales, name(), "k", path, 8)
    assert table.hot_keys == (None,) and table.cold().where("k IS NULL").isEmpty() and table.rows().count() == 1000
    assert clustered.open_clustered(spark, table.name).hot_keys == (None,)


def test_an_empty_table_and_its_own_number_of_buckets(spark, path):
    table = clustered.write_clustered(spark.range(0).select(F.col("id").alias("k")), name(), "k", path)
    assert table.buckets == clustered.LEAST_BUCKETS and table.hot_keys == () and table.rows().isEmpty()
    assert [clustered.bucket_number(n) for n in (0, 1 << 25, (1 << 25) + 1, 10**12)] == [8, 8, 16, 1 << 18]


def test_what_does_not_fit_is_refused(spark, stored, path):
    _, customers, facts, people = stored
    other = clustered.write_clustered(customers, name(), "customer_key", f"{path}/other", 16, unique=True)
    with pytest.raises(ValueError):
        clustered.join_clustered(facts, other)
    with pytest.raises(ValueError):
        clustered.totals_by_key(people, facts, [])
    customers.createOrReplaceTempView("plain_customers")
    with pytest.raises(ValueError):
        clustered.open_clustered(spark, "plain_customers")
