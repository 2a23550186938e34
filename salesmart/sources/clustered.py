"""Tables hashed into buckets by a key: what is joined or summed by that key is not moved.

A fact and a dimension with the same number of buckets keep the rows of a key in buckets of the same
number, so a join reads them side by side. Rows of a key that fills more than a bucket by itself would
all meet in one task; they are kept in a table of their own, spread over its files. There are
fewer such keys than buckets, so their rows of a dimension can be sent to all tasks.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesmart.session import drops_copies, settle
from salesmart.sources.tables import is_one_of

#: Table property that names the keys kept apart.
HOT_KEYS = "hot_keys"
#: A bucket is meant to hold about so many rows; there is at least this number of buckets.
ROWS_PER_BUCKET, LEAST_BUCKETS = 1 << 22, 8


@dataclass(frozen=True)
class Clustered:
    """A stored table: its name in the catalog, its key, its buckets and the keys that are kept apart."""

    spark: SparkSession
    name: str
    key: str
    buckets: int
    hot_keys: tuple = ()

    def cold(self) -> DataFrame:
        """Rows that lie in the bucket of their key."""
        return self.spark.table(self.name)

    def hot(self) -> DataFrame:
        """Rows of the keys that are kept apart."""
        return self.spark.table(hot_table(self.name))

    def rows(self) -> DataFrame:
        return self.cold().unionByName(self.hot()) if self.hot_keys else self.cold()

    def is_hot(self) -> Column:
        return F.coalesce(is_one_of(F.col(self.key), self.hot_keys), F.lit(False)) if self.hot_keys else F.lit(False)


def hot_table(name: str) -> str:
    return f"{name}__hot"


def bucket_number(rows: int) -> int:
    """A power of two, so that tables of different sizes still fit each other."""
    buckets = LEAST_BUCKETS
    while buckets * ROWS_PER_BUCKET < rows:
        buckets *= 2
    return buckets


@drops_copies
def write_clustered(df: DataFrame, name: str, key: str, location: str, buckets: int | None = None, unique: bool = False) -> Clustered:
    """Create or replace a table in buckets of ``key``.

    Give a dimension the ``buckets`` of the fact that it is joined to, and ``unique``: its key names
    one row, so none can be hot. A key is hot if it holds more than a bucket's share of the rows; a NULL is a key
    like others here.
    """
    spark = df.sparkSession
    hot: tuple = ()
    if not unique or buckets is None:
        df = settle(df, "clustering")
        total = df.count()
        buckets = bucket_number(total) if buckets is None else buckets
    if not unique:
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > F.lit(total / buckets))
        hot = tuple(sorted((r[0] for r in counts.collect()), key=lambda k: (k is None, k)))  # fewer than buckets
    table = Clustered(spark, name, key, buckets, hot)
    _store(df.where(~table.is_hot()), table, location, "overwrite")
    if hot:
        df.where(table.is_hot()).write.mode("overwrite").option("path", f"{location}/hot").saveAsTable(hot_table(name), format="parquet")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{HOT_KEYS}' = '{json.dumps(hot)}')")
    return table


def _store(rows: DataFrame, table: Clustered, location: str | None, mode: str) -> None:
    """One file for each bucket: rows are dealt out as the buckets are."""
    writer = rows.repartition(table.buckets, table.key).write.format("parquet").mode(mode)
    if location:
        writer = writer.option("path", f"{location}/buckets")
    writer.bucketBy(table.buckets, table.key).sortBy(table.key).saveAsTable(table.name)


def open_clustered(spark: SparkSession, name: str) -> Clustered:
    """A table that :func:`write_clustered` has made."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if "Num Buckets" not in told or HOT_KEYS not in properties:
        raise ValueError(f"not a clustered table: {name}")
    key = told["Bucket Columns"].strip("[]").replace("`", "")
    return Clustered(spark, name, key, int(told["Num Buckets"]), tuple(json.loads(properties[HOT_KEYS])))


@drops_copies
def append_clustered(df: DataFrame, table: Clustered) -> None:
    """Add rows, such as a day's sales, to the buckets of their keys.

    The keys kept apart stay the same until the table is written anew.
    """
    rows = settle(df.select(*table.cold().columns), "appended")
    _store(rows.where(~table.is_hot()), table, None, "append")
    if table.hot_keys:
        rows.where(table.is_hot()).write.mode("append").insertInto(hot_table(table.name))


def join_clustered(facts: Clustered, dimension: Clustered) -> DataFrame:
    """Inner join of a fact and a dimension on the key of both; no fact row moves."""
    _require_fit(facts, dimension)
    joined = facts.cold().join(dimension.cold(), facts.key)
    if not facts.hot_keys:
        return joined
    return joined.unionByName(facts.hot().join(F.broadcast(_hot_rows(facts, dimension)), facts.key))


def totals_by_key(facts: Clustered, dimension: Clustered, attributes: Sequence[str], *totals: Column) -> DataFrame:
    """One row for each key of the fact that the dimension holds: key, attributes and totals.

    A bucket's keys are summed up where they lie; the rows of a hot key are summed in each task before they meet.
    """
    _require_fit(facts, dimension)
    columns = [facts.key, *attributes]
    summed = facts.cold().groupBy(facts.key).agg(*totals).join(dimension.cold().select(*columns), facts.key)
    if facts.hot_keys:
        hot = facts.hot().groupBy(facts.key).agg(*totals)
        summed = summed.unionByName(hot.join(F.broadcast(_hot_rows(facts, dimension).select(*columns)), facts.key))
    return summed


def _hot_rows(facts: Clustered, dimension: Clustered) -> DataFrame:
    """The dimension's rows of the fact's hot keys: one for each, fewer than buckets."""
    return dimension.cold().where(facts.is_hot())


def _require_fit(facts: Clustered, dimension: Clustered) -> None:
    if (facts.key, facts.buckets) != (dimension.key, dimension.buckets) or dimension.hot_keys:
        raise ValueError(f"{facts.name} and {dimension.name} are not clustered alike")
