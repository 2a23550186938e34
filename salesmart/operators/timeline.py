"""Ordered work per key that survives a key owning a large share of the rows.

A window partitioned by key puts all rows of that key into one task. The rows are settled and counted per key
first. A key that fits a task is a window's partition as usual. The time line of a larger one is cut into buckets of about equal
row counts, at bounds drawn from a sample of its own rows, however they lie in time: rows of one moment, or
without any, are told apart by the other order columns. Each bucket is a partition of its own, and what must cross
the edges of buckets is worked out on one summary row per bucket.

Counting is left out where the whole table fits a task. There are at most ``MOST_BUCKETS`` times two buckets and fewer hot
keys than that, whatever the size of the input, so bounds and keys can go through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from salesmart.session import settle
from salesmart.sources.tables import is_one_of

#: Rows that one task may order, and the share of all rows that it takes if that is more.
ROWS_PER_BUCKET, MOST_BUCKETS = 1 << 22, 1024
#: Sampled rows for each bucket, and the number of bounds that are compared at a time.
SAMPLED, FAN = 16, 32
#: A row's bucket: a struct of key and number, so that rows without a key need no join of their own kind.
PART = "__part"


class Timeline(NamedTuple):
    """Settled rows in order of ``order`` per key: those of keys that fit a task, and the others with their bucket."""

    key: str
    order: list[str]
    cold: DataFrame
    hot: DataFrame | None

    def in_key(self):
        return Window.partitionBy(self.key).orderBy(*self.order)

    def in_part(self):
        return Window.partitionBy(PART).orderBy(*self.order)


def _edges(rows: DataFrame, *summary: Column) -> DataFrame:
    """One row per bucket (``__bucket``): rows are partitioned by it already."""
    return rows.groupBy(F.col(PART).alias("__bucket")).agg(*summary)


def _buckets():
    """A key's buckets in their order."""
    return Window.partitionBy("__bucket.key").orderBy("__bucket.number")


def _handed(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows with what their bucket was handed. There are few buckets, so no row moves for it."""
    return rows.join(F.broadcast(edges), F.col(PART) == F.col("__bucket"), "left").drop("__bucket")


def cut_keys(df: DataFrame, key: str, order: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> Timeline:
    """Settle rows and cut the time lines of keys that have too many of them."""
    rows, order = settle(df, "timeline"), list(order)
    total = rows.count()
    limit = max(rows_per_bucket, total // MOST_BUCKETS)
    if total <= limit:
        return Timeline(key, order, rows, None)
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).collect()  # at most MOST_BUCKETS
    if not counted:
        return Timeline(key, order, rows, None)
    is_hot = F.coalesce(is_one_of(F.col(key), [r[0] for r in counted]), F.lit(False))
    hot = rows.where(is_hot)
    bounds = _bounds(hot, key, order, {r[0]: r["n"] for r in counted}, limit)
    # At most two bounds for each of MOST_BUCKETS: sent to all tasks, since a shuffle by key is what is to be avoided.
    held = hot.join(F.broadcast(bounds), F.col(key).eqNullSafe(F.col("__hot_key")), "left")
    at = F.struct(*[F.col(c).alias(c) for c in order])
    step = F.size(F.filter("__steps", lambda bound: bound <= at))
    within = F.size(F.filter(F.element_at("__bounds", F.col("__step") + 1), lambda bound: bound <= at))
    number = F.col("__step") * (FAN + 1) + within
    part = F.struct(F.col(key).alias("key"), number.alias("number")).alias(PART)
    return Timeline(key, order, rows.where(~is_hot), held.withColumn("__step", step).select(*rows.columns, part))


def _bounds(hot: DataFrame, key: str, order: list[str], counts: dict, limit: int) -> DataFrame:
    """(key, first bounds of groups, groups of bounds) of every hot key, from a sample of a few rows for each bucket."""
    share = min(1.0, SAMPLED * sum(-(-n // limit) for n in counts.values()) / sum(counts.values()))
    drawn = hot.where(F.shiftrightunsigned(F.xxhash64(key, *order), 1) <= F.lit(min(int(share * 2**63), 2**63 - 1))).select(key, *order)
    samples: dict = {k: [] for k in counts}
    for row in drawn.collect():
        samples[row[0]].append(tuple(row)[1:])
    rows = []
    for k, found in samples.items():
        found.sort(key=lambda values: [(v is not None, v) for v in values])  # as Spark sorts: NULL first
        buckets = -(-counts[k] // limit)
        cuts = sorted({len(found) * i // buckets for i in range(1, buckets)})
        groups = [[found[i] for i in cuts[low:low + FAN]] for low in range(0, len(cuts), FAN)] or [[]]
        # A row's group is told by the first bounds of the later groups.
        rows.append((k, [g[0] for g in groups[1:]], groups))
    fields = StructType([StructField(c, hot.schema[c].dataType) for c in order])
    schema = StructType([
        StructField("__hot_key", hot.schema[key].dataType), StructField("__steps", ArrayType(fields)), StructField("__bounds", ArrayType(ArrayType(fields)))])
    return hot.sparkSession.createDataFrame(rows, schema)


def with_latest(line: Timeline, value: str, name: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` up to and including each row, per key."""
    def near(window) -> Column:
        return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))

    cold = line.cold.withColumn(name, near(line.in_key()))
    if line.hot is None:
        return cold
    edges = _edges(line.hot, F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*line.order))).alias("__last"))
    before = _buckets().rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select("__bucket", F.last("__last", ignorenulls=True).over(before).alias("__earlier"))
    hot = _handed(line.hot.withColumn("__near", near(line.in_part())), edges)
    return cold.unionByName(hot.withColumn(name, F.coalesce("__near", "__earlier")).select(*cold.columns))


def run_starts(line: Timeline, tracked: Sequence[str], moment: str, name: str) -> DataFrame:
    """The first row of each run of equal ``tracked`` values per key, with struct ``name``: the moment at which the next run starts.

    NULL is a value like others. The struct is NULL for a key's last run.
    """
    payload, when = F.struct(*[F.col(c).alias(c) for c in tracked]), F.struct(F.col(moment).alias(moment))

    def differs(before: Column) -> Column:
        return before.isNull() | (before != payload)  # of structs: fields that are NULL in both are equal

    # One sort serves both steps: what is left of the rows keeps its place and order.
    inside = line.cold.withColumn("__before", F.lag(payload).over(line.in_key()))
    cold = inside.where(differs(F.col("__before"))).withColumn(name, F.lead(when).over(line.in_key())).drop("__before")
    if line.hot is None:
        return cold
    at = F.struct(*line.order)
    rows = line.hot.withColumn("__near", F.lag(payload).over(line.in_part()))
    edges = _edges(
        rows, F.min_by(payload, at).alias("__first"), F.min_by(when, at).alias("__first_at"), F.max_by(payload, at).alias("__last"),
        F.min_by(when, F.when(F.col("__near").isNotNull() & differs(F.col("__near")), at)).alias("__change_at"))
    edges = edges.withColumn("__earlier", F.lag("__last").over(_buckets()))
    # A bucket's first start: its first row, if that differs from what was before, or else the first change in it.
    goes_on = F.col("__earlier").isNotNull() & (F.col("__earlier") == F.col("__first"))
    edges = edges.withColumn("__start", F.when(goes_on, F.col("__change_at")).otherwise(F.col("__first_at")))
    later = _buckets().rowsBetween(1, Window.unboundedFollowing)
    edges = edges.select("__bucket", "__earlier", F.first("__start", ignorenulls=True).over(later).alias("__later"))
    hot = _handed(rows, edges).where(differs(F.coalesce("__near", "__earlier")))
    hot = hot.withColumn(name, F.coalesce(F.lead(when).over(line.in_part()), "__later"))
    return cold.unionByName(hot.select(*cold.columns))
