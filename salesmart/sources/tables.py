"""Parquet tables: layouts, write dispositions, schema growth, retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from salesmart.session import drops_copies, settle

# Suffixes of a table's next and previous content during a swap.
NEW, OLD = ".new", ".old"
EXPORT_FORMATS = ("csv", "json", "parquet")
# An upsert takes about so many steps at most, of so many rows at least: what it shuffles and writes aside is that of one step.
UPSERT_STEPS, UPSERT_ROWS = 20, 2_000_000


def add_audit(df: DataFrame, column: str, run_ts: datetime | Column | None = None) -> DataFrame:
    """Stamp every row with one moment per run."""
    stamp = F.current_timestamp() if run_ts is None else run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return df.withColumn(column, stamp)


def arrange(df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> DataFrame:
    """Rows grouped by partition value and sorted for min/max skipping.

    A rebalance (not a plain repartition) lets the adaptive planner split a partition value that
    holds much of the data over several writers and merge small values into one.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    return df


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str], cluster_by: Sequence[str]):
    writer = arrange(df, partition_by, cluster_by).write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def ensure_table(
    spark: SparkSession, name: str, schema: StructType, *, partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (), comment: str = "", labels: dict[str, str] | None = None, location: str | None = None,
) -> DataFrame:
    """Create a catalog table unless it is there; labels and clustering columns become properties."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") for f in schema
    )
    properties = {**(labels or {}), **({"clustered_by": ",".join(cluster_by)} if cluster_by else {})}
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(partition_by)})"
    if location:
        statement += f" LOCATION {_quoted(location)}"
    if comment:
        statement += f" COMMENT {_quoted(comment)}"
    if properties:
        statement += " TBLPROPERTIES (" + ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items()) + ")"
    spark.sql(statement)
    return spark.table(name)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> None:
    _writer(df, "append", partition_by, cluster_by).parquet(path)


def write_truncate(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> None:
    """Replace the whole table. ``df`` must not read ``path``; see :func:`replace_from_itself`."""
    (_writer(df, "overwrite", partition_by, cluster_by).option("partitionOverwriteMode", "static").parquet(path))


def replace_from_itself(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> None:
    """Replace a table with a frame computed from it.

    The new content is written next to the table and then swapped in by two renames. A run that dies
    in between leaves both copies; :func:`table_exists` finishes or undoes the swap.
    """
    spark = df.sparkSession
    write_truncate(df, path + NEW, partition_by, cluster_by)
    drop_folder(spark, path + OLD)
    rename_folder(spark, path, path + OLD)
    rename_folder(spark, path + NEW, path)
    drop_folder(spark, path + OLD)


def write_if_empty(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> None:
    """Write only to a missing or row-less table; anything else is an error."""
    if table_exists(df.sparkSession, path) and not df.sparkSession.read.parquet(path).isEmpty():
        raise ValueError(f"table already holds rows: {path}")
    write_append(df, path, partition_by, cluster_by)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> None:
    """Replace exactly the partitions that ``df`` has rows for; running it again changes nothing."""
    (_writer(df, "overwrite", partition_by, cluster_by).option("partitionOverwriteMode", "dynamic").parquet(path))


@drops_copies
def reload_days(
    df: DataFrame, path: str, column: str, first: date | str | None, last: date | str | None, cluster_by: Sequence[str] = (),
    settled: bool = False,
) -> None:
    """Replace the days ``first``..``last`` by the rows of ``df``: days without new rows become empty.

    A bound that is None is open. The rows are settled first (``settled``: the caller has done so, or they are stored rows,
    also of this table), so that they are computed once for writing them and for finding the days they fill.
    """
    spark = df.sparkSession
    before = {d for d in partition_values(spark, path, column) if (first is None or str(first) <= d) and (last is None or d <= str(last))}
    rows = df if settled else settle(df, "reload")
    # One value per day of the range comes to the driver; rows of the table itself can be read until it is written.
    filled = {str(d) for d in distinct_values(rows, column)} if before else set()
    overwrite_partitions(rows, path, [column], cluster_by)
    drop_partitions(spark, path, column, before - filled)


@drops_copies
def upsert_days(
    df: DataFrame, path: str, column: str, identity: Sequence[str], cluster_by: Sequence[str] = (), partition: Column | None = None,
    partition_name: str | None = None, newest: Sequence[str] = (), settled: bool = False, picked: bool = True,
) -> list:
    """Put rows into the partitions of their own days, late ones too, and keep all others there; return the partitions.

    A row replaces the stored one with the same ``identity``, and within a load :func:`once` picks the newest; rows whose
    identity has a NULL are the same if all their values are. Running a load again changes nothing. Partitions are of
    ``column``, or of the expression ``partition`` over it, named ``partition_name``; only touched ones are read and rewritten, some at a
    time where they hold many rows: the old ones go when all of their new content is written. ``settled``: the caller has picked and
    settled the rows, or only settled them (not ``picked``). A load that was cut off is finished by running it again.
    """
    spark, name = df.sparkSession, partition_name or column
    if partition is not None:
        df = df.withColumn(name, partition)
    apart = column in identity  # rows of different partitions have nothing to do with each other
    if not settled or not (picked or apart):
        df, picked = settle(once(df, identity, newest), "upsert"), True
    held = {r[0]: r[1:] for r in df.groupBy(name).agg(F.count(F.lit(1)), F.min(column), F.max(column)).collect()}
    touched = list(held)  # at most the partitions of one load
    if not touched:
        return touched
    rows, known = {value: n for value, (n, _, _) in held.items()}, table_exists(spark, path)
    stored = spark.read.schema(df.schema).parquet(path) if known else None
    if known:
        for value, n in stored.where(is_one_of(F.col(name), touched)).groupBy(name).count().collect():
            rows[value] += n
    for some in _steps(rows) if apart else [touched]:
        part = df if len(some) == len(touched) else df.where(is_one_of(F.col(name), some))
        if len(some) < len(touched) and partition is not None:  # bounds that files can be skipped by
            bounds = [held[v][1:] for v in some if held[v][1] is not None]
            inside = [F.col(column).between(min(b[0] for b in bounds), max(b[1] for b in bounds))] if bounds else []
            part = part.where(reduce(lambda a, b: a | b, inside, F.col(column).isNull()))
        _upsert(part, stored, path, name, some, identity, cluster_by, newest, picked)
    return touched


def _steps(rows: dict) -> list[list]:
    """Partitions in their order, grouped so that about as many rows fall to each group; ``rows`` has the count of each."""
    most, steps, n = max(UPSERT_ROWS, sum(rows.values()) / UPSERT_STEPS), [], 0
    for value in sorted(rows, key=lambda v: (v is not None, v)):
        if not steps or n + rows[value] > most and value != "":  # an empty text lies in the folder of NULL
            steps, n = [*steps, []], 0
        steps[-1].append(value)
        n += rows[value]
    return steps


@drops_copies
def _upsert(
    new: DataFrame, stored: DataFrame | None, path: str, name: str, values: Sequence, identity: Sequence[str], cluster_by: Sequence[str],
    newest: Sequence[str], picked: bool,
) -> None:
    if not picked:
        new = once(new, identity, newest)
    if stored is not None:
        new = new if picked else settle(new, "upsert")
        new = absent(stored.where(is_one_of(F.col(name), values)), new, identity).unionByName(new)
    overwrite_partitions(new, path, [name], cluster_by)


def distinct_values(df: DataFrame, column: str) -> list:
    """The values of a column that is known to have few, such as the days of a load; NULL is one like others."""
    return [r[0] for r in df.select(column).distinct().collect()]


def is_one_of(column: Column, values: Sequence) -> Column:
    """Whether ``column`` is one of ``values``; NULL is a value like others."""
    held = column.isin([v for v in values if v is not None])
    return held | column.isNull() if None in values else held


def once(df: DataFrame, identity: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """One row for each identity; of rows whose identity has a NULL, those that differ in any value.

    The row with the greatest ``newest`` columns wins, and among equals the one with the greatest other columns, in
    their order: the same whatever the rows' order is. Every task picks its own before the shuffle. The rows are read once.
    """
    rest = [*newest, *(c for c in df.columns if c not in (*identity, *newest))]
    if not rest:
        return df.dropDuplicates()
    row, nameless = F.struct(*rest), _nameless(identity)
    winner = df.groupBy(*identity, F.when(nameless, row).alias("__all")).agg(F.max(F.when(~nameless, row)).alias("__row"))
    return winner.select(*identity, F.coalesce("__all", "__row").alias("__row")).select(*identity, "__row.*").select(*df.columns)


def absent(df: DataFrame, other: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Rows of ``df`` that ``other`` does not hold, by identity or, where that has a NULL, by all values."""
    whole = F.when(_nameless(identity), F.struct(*df.columns))
    held = other.select(*[F.col(c).alias(f"__{c}") for c in identity], whole.alias("__other"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in identity])
    return df.withColumn("__all", whole).join(held, same & F.col("__all").eqNullSafe(F.col("__other")), "left_anti").drop("__all")


def _nameless(identity: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in identity])


def append_evolving(df: DataFrame, path: str, schema: StructType | None = None) -> StructType:
    """Append rows that may bring new columns or leave out old ones; return the widened schema.

    Pass the schema returned last time: without it the files' footers have to be read.
    """
    spark = df.sparkSession
    if schema is None and table_exists(spark, path):
        schema = spark.read.option("mergeSchema", True).parquet(path).schema
    known = {f.name: f.dataType for f in schema} if schema is not None else {}
    clashes = [f.name for f in df.schema if f.name in known and known[f.name] != f.dataType]
    if clashes:
        raise ValueError(f"columns change type: {clashes}")
    df.write.mode("append").parquet(path)
    fields = list(schema.fields) if schema is not None else []
    return StructType(fields + [f for f in df.schema if f.name not in known])


def read_evolving(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All rows, with NULL where a file lacks a column."""
    return spark.read.schema(schema).parquet(path) if schema is not None else spark.read.option("mergeSchema", True).parquet(path)


def union_sources(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_partitioned(spark: SparkSession, path: str, column: str, first: date | str, last: date | str) -> DataFrame:
    """Read a table with a mandatory partition range (both ends included)."""
    if not first or not last:
        raise ValueError(f"a range on {column} is required")
    return spark.read.parquet(path).where(F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def export_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Export to CSV with a header line, JSON lines or Parquet, one file per task."""
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"cannot export {fmt!r}; choose one of {EXPORT_FORMATS}")
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def retained(df: DataFrame, column: str, as_of: Column, days: int) -> DataFrame:
    """Rows whose partition day has not expired by ``as_of``."""
    return df.where(F.col(column) >= F.date_sub(as_of, days))


def expire_partitions(spark: SparkSession, path: str, column: str, as_of: date, days: int) -> list[str]:
    """Delete day partitions older than ``days`` before ``as_of``; return their days."""
    oldest = (as_of - timedelta(days=days)).isoformat()
    return drop_partitions(spark, path, column, {d for d in partition_values(spark, path, column) if d < oldest})


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first partition column, from the folder names."""
    if not table_exists(spark, path):
        return []
    fs, root = _file_system(spark, path)
    names = [status.getPath().getName().partition("=") for status in fs.listStatus(root)]
    return [value for label, _, value in names if label == column]


def drop_partitions(spark: SparkSession, path: str, column: str, values: set[str]) -> list[str]:
    for value in values:
        drop_folder(spark, f"{path}/{column}={value}")
    return sorted(values)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Is there a table? A swap that was cut off (see :func:`replace_from_itself`) is settled first."""
    if not folder_exists(spark, path) and folder_exists(spark, path + OLD):
        rename_folder(spark, path + (NEW if is_complete(spark, path + NEW) else OLD), path)
    return folder_exists(spark, path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Did the job that wrote this folder finish?"""
    return folder_exists(spark, f"{path}/_SUCCESS")


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, root = _file_system(spark, path)
    return fs.exists(root)


def file_stamps(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Moment of change and size of those paths that exist; of a folder, of all files in it."""
    found = {}
    for path in paths:
        fs, root = _file_system(spark, path)
        if fs.exists(root):
            held = fs.listStatus(root)  # of a file: itself
            found[path] = ",".join(sorted(f"{s.getPath().getName()}:{s.getModificationTime()}:{s.getLen()}" for s in held))
    return found


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, root = _file_system(spark, path)
    fs.delete(root, True)


def rename_folder(spark: SparkSession, source: str, target: str) -> None:
    fs, root = _file_system(spark, source)
    if not fs.rename(root, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def _file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root
