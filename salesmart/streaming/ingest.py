"""File arrivals, change feeds and sales events as streams.

All run with the ``availableNow`` trigger: start, process what has arrived since the last run,
stop. The checkpoint remembers what was processed; it and the tables belong in shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType, TimestampType

from salesmart.operators.history import DELETE, latest_per_key
from salesmart.operators.star import FACT_IDENTITY, FACT_NEWEST, fact_sales
from salesmart.session import drops_copies, settle
from salesmart.sources.tables import distinct_values, drop_folder, is_complete, partition_values, upsert_days, write_truncate

VERSION, BUCKET = "version", "bucket"
#: Setting that says how many batches' figures a running stream remembers.
KEPT_FIGURES = "spark.sql.streaming.numRecentProgressUpdates"


def file_stream(spark: SparkSession, pattern: str, schema: StructType, fmt: str = "csv", files_per_batch: int | None = None) -> DataFrame:
    """New files under ``pattern`` as a stream."""
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(pattern)


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything that is there, then return the ended stream."""
    stream = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    return stream


def ingest_available_files(
    spark: SparkSession, pattern: str, schema: StructType, target: str, checkpoint: str, fmt: str = "csv",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Append the files that arrived since the last run to ``target``, each exactly once."""
    stream = file_stream(spark, pattern, schema, fmt, files_per_batch)
    run_available(stream.writeStream.format("parquet").option("path", target), checkpoint)
    return spark.read.schema(schema).parquet(target)


def stream_cdc_apply(
    changes: DataFrame, state_path: str, checkpoint: str, key: str, order: Sequence[str], op: str = "op", buckets: int = 64,
) -> DataFrame:
    """Fold a change feed into a state table; return the live rows.

    The state keeps the last change of every key, deletions included, so batches may come in any order. It lies in
    ``buckets`` by a hash of the key. A batch reads and writes the buckets of its own keys only: as a new version, next
    to the others. A bucket's content is that of its newest complete version, and a batch that is run
    again, after any failure, starts from the versions before it and writes the same. State and checkpoint belong together.
    """
    spark, schema = changes.sparkSession, changes.schema
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    @drops_copies
    def fold(batch: DataFrame, batch_id: int) -> None:
        session, path = batch.sparkSession, version_path(state_path, batch_id)
        if not is_complete(session, path):
            state = settle(latest_per_key(batch, [key], order).withColumn(BUCKET, bucket), "changes")
            known = newest_buckets(session, state_path, batch_id - 1)
            old = [known[str(b)] for b in distinct_values(state, BUCKET) if str(b) in known]  # at most ``buckets``
            if old:
                merged = session.read.schema(schema).parquet(*old).unionByName(state.drop(BUCKET))
                state = latest_per_key(merged, [key], order).withColumn(BUCKET, bucket)
            write_truncate(state, path, [BUCKET])
        drop_superseded(session, state_path)

    run_available(changes.writeStream.foreachBatch(fold), checkpoint)
    paths = list(newest_buckets(spark, state_path).values())
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths).where(F.col(op) != DELETE)


def newest_buckets(spark: SparkSession, state_path: str, last: int | None = None) -> dict[str, str]:
    """Each bucket's folder in its newest complete version, up to version ``last``."""
    found = {}
    for version in complete_versions(spark, state_path):
        if last is None or version <= last:
            path = version_path(state_path, version)
            found |= {b: f"{path}/{BUCKET}={b}" for b in partition_values(spark, path, BUCKET)}
    return found


def drop_superseded(spark: SparkSession, state_path: str) -> None:
    """Delete the buckets that have a newer version, and versions without buckets."""
    live = set(newest_buckets(spark, state_path).values())
    versions = complete_versions(spark, state_path)
    for version in versions[:-1]:
        path = version_path(state_path, version)
        held = {f"{path}/{BUCKET}={b}" for b in partition_values(spark, path, BUCKET)}
        for gone in [path] if not held & live else held - live:
            drop_folder(spark, gone)


def version_path(state_path: str, version: int) -> str:
    return f"{state_path}/{VERSION}={version}"


def complete_versions(spark: SparkSession, state_path: str) -> list[int]:
    """Fully written versions of a state table, oldest first."""
    found = sorted(int(v) for v in partition_values(spark, state_path, VERSION))
    return [v for v in found if is_complete(spark, version_path(state_path, v))]


def stream_fact_sales(raw: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Put new sales into the fact, however late they come, by the rules of the daily load.

    A sale is told by its day and its ``transaction_id``, one without an id by all its values. Of one sale's rows in a
    batch the latest counts, and it replaces the stored one, so a replayed batch changes nothing; a sale
    sent again under another day is another sale. A batch reads and rewrites the days that it touches alone.
    """
    spark = raw.sparkSession
    fact = fact_sales(raw)

    def load(batch: DataFrame, _batch_id: int) -> None:
        upsert_days(batch, target, "transaction_date", FACT_IDENTITY, ["customer_key", "product_key"], newest=FACT_NEWEST)

    run_available(fact.writeStream.foreachBatch(load), checkpoint)
    return spark.read.schema(fact.schema).parquet(target)


class Bounded(NamedTuple):
    """Stored sales, and how many rows the run left out: too late, and repeated."""

    sales: DataFrame
    late: int
    repeated: int


def stream_fact_sales_bounded(raw: DataFrame, target: str, checkpoint: str, delay: str = "1 day") -> Bounded:
    """Append new sales with repeats removed; rows that come later than ``delay`` are left out and counted.

    The stream remembers the ids of as long a time only, and needs no look at the stored fact. The bar that tells late
    rows rises between batches. Use :func:`stream_fact_sales` where late rows must be kept.
    """
    spark = raw.sparkSession
    fact = fact_sales(raw).withColumn("transaction_timestamp", F.col("transaction_timestamp").cast(TimestampType()))
    first = fact.withWatermark("transaction_timestamp", delay).dropDuplicatesWithinWatermark(["transaction_id"])
    writer = first.writeStream.format("parquet").option("path", target).partitionBy("transaction_date")
    before = spark.conf.get(KEPT_FIGURES)
    spark.conf.set(KEPT_FIGURES, "1000000")  # those of all batches of the run, not of the last hundred
    try:
        figures = [f for p in run_available(writer, checkpoint).recentProgress for f in p["stateOperators"]]
    finally:
        spark.conf.set(KEPT_FIGURES, before)
    return Bounded(
        spark.read.schema(fact.schema).parquet(target), sum(f["numRowsDroppedByWatermark"] for f in figures),
        sum(f["customMetrics"].get("numDroppedDuplicateRows", 0) for f in figures))
