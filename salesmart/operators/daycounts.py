"""Distinct counts that can be added up: stored per day, merged to months or windows without the facts.

A distinct count of a month is not the sum of its days' counts. What is stored of a day is therefore a sketch of its
values (approximate, of one size for any number of values), and for whole numbers from 0 on, such as customer
numbers, a set of bits (exact): one piece of 4 kB for each 32,768 numbers that occur. Both can be united. A day has few
rows, so the store is partitioned by month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesmart.functions.dates import month_start
from salesmart.session import drops_copies, settle
from salesmart.sources.tables import distinct_values, drop_partitions, is_one_of, overwrite_partitions, partition_values, write_truncate

#: Folders of a store: a row per day, and a row per day, counted column and piece of bits.
DAYS, BITS = "days", "bits"
MONTH = "store_month"
#: Size of a sketch: 2 ** 12 registers, a standard error of about 1.6 percent.
LG_REGISTERS, STANDARD_ERROR = 12, 0.016
#: Least days of a block, within which windows are united.
BLOCK_DAYS = 28


def day_sketches(rows: DataFrame, day: str, counted: Sequence[str], *totals: Column) -> DataFrame:
    """One row per day: ``totals`` and a sketch of each counted column (``<column>_sketch``)."""
    sketches = [F.hll_sketch_agg(c, LG_REGISTERS).alias(f"{c}_sketch") for c in counted]
    return rows.groupBy(day).agg(*totals, *sketches)


def day_bits(rows: DataFrame, day: str, counted: Sequence[str]) -> DataFrame:
    """The sets of whole numbers in the counted columns: (day, column, piece, bits). NULLs are not counted.

    A number is met once per task, day and piece before rows travel; numbers below 0 fail.
    """
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("value")) for c in counted])).alias("v")
    each = rows.select(day, values).select(day, "v.*").where("value IS NOT NULL")
    # Places are counted from 1: a piece holds 32,768 of them.
    number = F.when(F.col("value") >= 0, F.col("value") + 1).otherwise(F.raise_error(F.concat(F.lit("below zero: "), F.col("value"))))
    each = each.select(day, "column", F.bitmap_bucket_number(number).alias("piece"), F.bitmap_bit_position(number).alias("position"))
    return each.groupBy(day, "column", "piece").agg(F.bitmap_construct_agg("position").alias("bits"))


def store_days(rows: DataFrame, path: str, day: str, approximate: Sequence[str], exact: Sequence[str], *totals: Column) -> None:
    """Make a store of all days."""
    write_truncate(_by_month(day_sketches(rows, day, approximate, *totals), day), f"{path}/{DAYS}", [MONTH], [day])
    write_truncate(_by_month(day_bits(rows, day, exact), day), f"{path}/{BITS}", [MONTH], [day])


@drops_copies
def refresh_days(rows: DataFrame, path: str, day: str, changed: DataFrame, approximate: Sequence[str], exact: Sequence[str], *totals: Column) -> None:
    """Make the days of ``changed`` anew, also those that have no rows any more.

    Of rows that are partitioned by day no other partition is read, and of the store only the changed days' months are.
    """
    days = distinct_values(changed, day)  # those of one load
    if days:
        some = rows.where(is_one_of(F.col(day), days))
        _replace(day_sketches(some, day, approximate, *totals), f"{path}/{DAYS}", day, days)
        _replace(day_bits(some, day, exact), f"{path}/{BITS}", day, days)


def _by_month(rows: DataFrame, day: str) -> DataFrame:
    return rows.withColumn(MONTH, month_start(F.col(day)))


def _replace(new: DataFrame, path: str, day: str, days: list) -> None:
    spark, new = new.sparkSession, _by_month(new, day)
    months = list({d and d.replace(day=1) for d in days})
    stored = spark.read.schema(new.schema).parquet(path).where(is_one_of(F.col(MONTH), months))
    rows = settle(stored.where(~F.coalesce(is_one_of(F.col(day), days), F.lit(False))).unionByName(new), "day-counts")
    overwrite_partitions(rows, path, [MONTH], [day])
    held = distinct_values(rows, MONTH)
    drop_partitions(spark, path, MONTH, {str(m) for m in months if m not in held} & set(partition_values(spark, path, MONTH)))


def merged_counts(spark: SparkSession, path: str, period: Column, approximate: Sequence[str], exact: Sequence[str], *totals: Column) -> DataFrame:
    """One row per ``period``, an expression over the day: totals, ``approx_<column>`` and ``exact_<column>``.

    ``totals`` add up the totals of the days. Reads the store alone: some rows a day.
    """
    days, bits = (spark.read.parquet(f"{path}/{name}").withColumn("period", period) for name in (DAYS, BITS))
    sketches = [F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"approx_{c}") for c in approximate]
    merged = days.groupBy("period").agg(*totals, *sketches)
    return merged.join(_counted(bits, exact), "period", "left").fillna(0, [f"exact_{c}" for c in exact]) if exact else merged


def rolling_counts(spark: SparkSession, path: str, day: str, days: int, exact: Sequence[str]) -> DataFrame:
    """Exact counts over the ``days`` days up to each stored day.

    The windows of a block of days are united in one place: a piece travels to the one or two blocks that it counts for, not
    once for each of its windows.
    """
    stored = spark.read.parquet(f"{path}/{DAYS}").select(F.col(day).alias("period"))
    length, first = F.lit(max(BLOCK_DAYS, days)), F.unix_date(day)
    last = first + (days - 1)
    bits = spark.read.parquet(f"{path}/{BITS}").select(
        "column", "piece", "bits", first.alias("first"), last.alias("last"),
        F.explode(F.sequence(F.floor(first / length), F.floor(last / length))).alias("block"),
    ).repartition("block", "column", "piece")
    inside = F.sequence(F.greatest("first", F.col("block") * length), F.least("last", F.col("block") * length + length - 1))
    bits = bits.select("block", "column", "piece", "bits", F.explode(inside).alias("period"))
    pieces = bits.groupBy("block", "period", "column", "piece").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    counted = _sizes(pieces, exact).withColumn("period", F.date_from_unix_date(F.col("period").cast("int")))
    return stored.join(counted, "period", "left").fillna(0, [f"exact_{c}" for c in exact])


def _counted(bits: DataFrame, exact: Sequence[str]) -> DataFrame:
    """The sizes of the united sets of each period: pieces are united first, and hold different numbers."""
    return _sizes(bits.groupBy("period", "column", "piece").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")), exact)


def _sizes(pieces: DataFrame, exact: Sequence[str]) -> DataFrame:
    sizes = [F.sum(F.when(F.col("column") == c, F.col("n"))).alias(f"exact_{c}") for c in exact]
    return pieces.groupBy("period").agg(*sizes)
