"""Sets of files that belong together, such as all files of a day: loaded when the last one is there."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salesmart.session import drops_copies, settle
from salesmart.sources.tables import distinct_values, drop_partitions, file_stamps, overwrite_partitions, partition_values, table_exists

#: Column of a loaded row: the set that its file belongs to.
FILE_SET = "file_set"
LOG = StructType([StructField("path", StringType()), StructField("stamp", StringType()), StructField(FILE_SET, StringType())])


class Arrived(NamedTuple):
    """What a run has found: the visible rows, the sets it loaded, and the files that other sets still wait for."""

    rows: DataFrame
    loaded: list[str]
    missing: dict[str, list[str]]


@drops_copies
def load_complete_sets(
    spark: SparkSession, expected: Mapping[str, Sequence[str]], schema: StructType, target: str, log: str,
    read: Callable[[list[str]], DataFrame],
) -> Arrived:
    """Show the rows of every set of files that is complete.

    ``expected`` names the paths (files, or folders of files) of each set; ``read`` makes a frame with the columns of
    ``schema`` from paths. A set counts from the moment when all its paths exist, empty files too, and then replaces its partition
    of ``target`` (its name is the folder's); of incomplete sets no row is visible. ``log`` remembers the moment and size of each loaded file: a set is
    loaded again if one of its files has changed, and otherwise left alone. The log is written after the rows, so
    a run that was cut off is made good by the next one. The driver holds the names of the expected files only.
    """
    visible = StructType([*schema, StructField(FILE_SET, StringType())])
    known: dict[str, dict[str, str]] = {}
    if table_exists(spark, log):
        for row in spark.read.schema(LOG).parquet(log).where(F.col(FILE_SET).isin(list(expected))).collect():
            known.setdefault(row[FILE_SET], {})[row["path"]] = row["stamp"]
    missing, fresh = {}, {}
    for name, paths in expected.items():
        stamps = file_stamps(spark, paths)
        lacking = [p for p in paths if p not in stamps]
        if lacking:
            missing[name] = lacking
        elif stamps != known.get(name):
            fresh[name] = stamps
    if fresh:
        sets = [read(list(stamps)).select(*schema.names).withColumn(FILE_SET, F.lit(name)) for name, stamps in fresh.items()]
        rows = settle(reduce(DataFrame.unionByName, sets), "arrived")
        overwrite_partitions(rows, target, [FILE_SET])
        emptied = set(fresh) - set(distinct_values(rows, FILE_SET))
        drop_partitions(spark, target, FILE_SET, emptied & set(partition_values(spark, target, FILE_SET)))
        entries = [(path, stamp, name) for name, stamps in fresh.items() for path, stamp in stamps.items()]
        overwrite_partitions(spark.createDataFrame(entries, LOG), log, [FILE_SET])
    shown = spark.read.schema(visible).parquet(target) if table_exists(spark, target) else spark.createDataFrame([], visible)
    return Arrived(shown, sorted(fresh), missing)
