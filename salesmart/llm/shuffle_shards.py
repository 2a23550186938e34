"""Global shuffle into shards of equal row counts, by a two-pass external shuffle.

Pass one scatters records by a seeded hash into buckets that fit in memory; pass two loads each bucket, shuffles
it (Spark's ``shuffle`` is a Fisher-Yates shuffle) and writes it. Exact counts of the buckets, known before the
second pass, give each bucket its range of global places, and the places are cut into shards whose counts
differ by one at most.

Only functions of Spark run here. A bucket holds about ``bucket_bytes``. Records are scattered by id and
text, so a hot source or a repeated id spreads out; where rows equal in both make a bucket too large, that
bucket is split into parts by the rows' places in the input, which must therefore be a repeatable scan (files, a
table, a settled frame). A lost task shuffles its buckets again and nobody else's.

Defined results: a null text is stored as null and weighs 16 bytes; null and repeated ids and equal rows are
records of their own; an empty table gives no shards. A column of the input named like a placement column is
replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.session import scratch_path, settle

#: Bytes a record weighs besides its text.
RECORD_BYTES = 16
#: Cells whose counts are summed up in one task when the offsets are made.
CELLS_A_GROUP = 4096


def _offsets(counts: DataFrame) -> DataFrame:
    """(cell, first) of ``counts`` (cell, n): the rows before each cell; no task sees all cells."""
    grouped = counts.withColumn("grp", F.expr(f"cell div {CELLS_A_GROUP}"))
    before = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("grp").agg(F.sum("n").alias("n")).select(
        "grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("grp").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    return grouped.join(groups, "grp").select(
        "cell", (F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("first"))


def place_rows(
    docs: DataFrame, shards: int, seed: int = 42, bucket_bytes: int = 8 << 20, oversize: int = 4, task_bytes: int = 32 << 20,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``docs`` in shuffled order, with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    Buckets beyond ``oversize`` times ``bucket_bytes`` are split. A task is given about ``task_bytes`` of them, whatever the
    size of the input.
    """
    size = F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("long") + RECORD_BYTES
    total = docs.agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")).first()
    if not total["rows"]:
        return _named(docs, docs.columns, F.lit(0), F.lit(0).cast("long"))
    buckets = -(-total["bytes"] // bucket_bytes)
    draw = F.xxhash64(F.lit(seed), docs[doc_id], docs[text])
    rows = docs.select(
        F.pmod(draw, F.lit(buckets)).alias("bucket"), draw.alias("draw"), size.alias("size"),
        F.monotonically_increasing_id().alias("at"), F.struct("*").alias("row"))
    counts = settle(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")), "bucket-counts")
    parts = F.ceil(F.col("bytes") / bucket_bytes)
    large = counts.filter((F.col("bytes") > oversize * bucket_bytes) & (F.col("n") > 1)).select("bucket", parts.alias("parts"))
    most = large.agg(F.max("parts")).first()[0]
    # Tasks are dealt their cells in turn: by a hash some would get many.
    tasks = max(-(-total["bytes"] // task_bytes), docs.sparkSession.sparkContext.defaultParallelism)
    # A cell is a bucket, or a part of one.
    if most is None:
        rows = rows.withColumn("task", F.pmod("bucket", F.lit(tasks))).withColumnRenamed("bucket", "cell")
        counts = counts.select(F.col("bucket").alias("cell"), "n")
    else:
        part = F.coalesce(F.pmod(F.xxhash64(F.lit(seed), "at"), "parts"), F.lit(0))
        rows = rows.join(large, "bucket", "left").withColumn("cell", F.col("bucket") * most + part)
        rows = rows.withColumn("task", F.pmod(F.col("bucket") + part, F.lit(tasks)))
        counts = settle(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "cell-counts")

    filled = (
        rows.select(F.col("task").cast("int").alias("task"), "cell", F.struct("draw", "row").alias("record"))
        .repartitionById(tasks, "task")
        .groupBy("task", "cell").agg(F.array_sort(F.collect_list("record")).alias("records"))
        .join(_offsets(counts), "cell")
        # The draws of shuffle() go on from row to row, so a fixed order of cells makes a run repeatable.
        .sortWithinPartitions("cell")
        .select("first", F.shuffle("records", seed).alias("records"))
        .select("first", F.posexplode("records").alias("pos", "record"))
    )
    place = F.col("first") + F.col("pos")
    shard = F.expr(f"((first + pos) * {shards}) div {total['rows']}")
    placed = filled.select(place.alias("place"), shard.cast("int").alias("in_shard"), "record.row")
    start = F.expr(f"(in_shard * {total['rows']} + {shards - 1}) div {shards}")
    return _named(placed, docs.columns, F.col("in_shard"), F.col("place") - start, "row.")


def _named(frame: DataFrame, columns: list[str], shard, slot, prefix: str = "") -> DataFrame:
    kept = [F.col(f"{prefix}`{c}`") for c in columns if c.lower() not in ("shard", "slot")]
    return frame.select(*kept, shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def write_shards(placed: DataFrame, path: str | None = None) -> str:
    """Writes placed rows as one folder of Parquet files a shard and returns the path."""
    path = path or scratch_path(placed.sparkSession, "shards")
    placed.write.partitionBy("shard").parquet(path)
    return path


def read_shards(placed: DataFrame, path: str) -> DataFrame:
    """The written rows of ``placed``, from ``path``."""
    return placed.sparkSession.read.schema(placed.schema).parquet(path)
