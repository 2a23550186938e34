"""Change capture and history: latest state per key, change feeds, SCD type 2, point in time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.functions.keys import surrogate_key
from salesmart.operators import timeline
from salesmart.operators.merge import absent_rows, merge_table
from salesmart.session import settle
from salesmart.sources.files import require_filled

# End date of an open version and the operation names of a change feed.
OPEN_END = "9999-12-31"
INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    An aggregate rather than a row number: every task reduces its rows to one per key before the
    shuffle, so a key with very many changes costs no more than others.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(newest).select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def cdc_apply(target: DataFrame, changes: DataFrame, key: str, order: Sequence[str], op: str = "op") -> DataFrame:
    """Apply INSERT / UPDATE / DELETE changes; only the last change of each key counts."""
    last = latest_per_key(changes, [key], order)
    columns = [c for c in target.columns if c in changes.columns]
    return merge_table(
        target, last, key,
        update=[c for c in columns if c != key],
        delete_when=F.col(f"s.{op}") == DELETE,
        insert=columns, insert_when=F.col(f"s.{op}") != DELETE, unique_source=True,
    )


def _differs(tracked: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in tracked])


def changed_rows(source: DataFrame, current: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Source rows for whose key the current table holds different tracked values."""
    same = (F.col(f"s.{key}") == F.col(f"t.{key}")) & _differs(tracked)
    return source.alias("s").join(current.alias("t"), same, "left_semi")


def scd2_apply(dimension: DataFrame, source: DataFrame, key: str, tracked: Sequence[str], as_of: date | Column) -> DataFrame:
    """Close the open versions that changed and open new ones; applying the same source twice is safe.

    Columns: ``customer_key`` (per version), the key, the tracked attributes,
    ``effective_start_date``, ``effective_end_date`` (exclusive) and ``is_current``.
    """
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    source = require_filled(source, [key])
    opened = dimension.where("is_current")
    as_is = source.alias("s").join(
        opened.alias("t"), (F.col(f"s.{key}") == F.col(f"t.{key}")) & ~_differs(tracked), "left_semi"
    )
    # Settled: it closes versions and opens new ones.
    fresh = settle(absent_rows(source, as_is, [key]), "fresh-versions")
    closing = {"effective_end_date": day, "is_current": F.lit(False)}
    kept = merge_table(
        dimension, fresh.select(key), key, update=closing, update_when=F.col("t.is_current"), settled=True,
    )
    versions = fresh.select(
        surrogate_key(F.col(key), day).alias("customer_key"), key, *tracked,
        day.alias("effective_start_date"), F.lit(OPEN_END).cast("date").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )
    return kept.unionByName(versions)


def scd2_build(
    changes: DataFrame, key: str, order: Sequence[str], tracked: Sequence[str], rows_per_bucket: int = timeline.ROWS_PER_BUCKET,
) -> DataFrame:
    """Version history from a change log: one row per run of equal tracked values.

    ``order[0]`` is the moment of a change and becomes the validity interval ``[valid_from, valid_to)``.
    Changes without a moment come first. The log is settled, and keys with more than ``rows_per_bucket`` changes are cut.
    """
    moment = order[0]
    line = timeline.cut_keys(changes.select(key, *order, *tracked), key, order, rows_per_bucket)
    return timeline.run_starts(line, tracked, moment, "__after").select(
        key, *tracked, F.col(moment).alias("valid_from"), F.col(f"__after.{moment}").alias("valid_to"),
        F.col("__after").isNull().alias("is_current"),
    )


def point_in_time_join(
    facts: DataFrame, versions: DataFrame, key: str, moment: str, attributes: Sequence[str],
    start: str = "valid_from", end: str = "valid_to", rows_per_bucket: int = timeline.ROWS_PER_BUCKET,
) -> DataFrame:
    """Inner join of facts to the version valid at their moment (``start`` <= moment < ``end``).

    Versions of one key do not overlap, so at most one can be valid: the latest one started. Facts
    and versions are merged into one time line per key and the version is carried forward, which
    is linear also where a key has both many facts and many versions (a join on the key with a range
    condition would compare all of them). Facts of one moment are told apart by a hash of their values.
    """
    fact_columns = facts.columns
    # A version that ended the moment it began is never valid; without these, starts are unique per key.
    versions = versions.where(F.col(end).isNull() | (F.col(start) < F.col(end)))
    line = (
        facts.select(F.col(key).alias("__key"), F.col(moment).alias("__at"), F.lit(1).alias("__kind"),
                     F.xxhash64(*fact_columns).alias("__tie"), F.struct(*fact_columns).alias("__fact"))
        .unionByName(
            versions.select(F.col(key).alias("__key"), F.col(start).alias("__at"), F.lit(0).alias("__kind"), F.lit(0).cast("long").alias("__tie"),
                            F.struct(F.col(end).alias("__end"), *attributes).alias("__version")),
            allowMissingColumns=True,
        )
        .where(F.col("__key").isNotNull())
    )
    cut = timeline.cut_keys(line, "__key", ["__at", "__kind", "__tie"], rows_per_bucket)
    carried = timeline.with_latest(cut, "__version", "__valid")
    until = F.col("__valid.__end")
    return carried.where(
        (F.col("__kind") == 1) & F.col("__valid").isNotNull() & (until.isNull() | (F.col("__at") < until))
    ).select(
        *[F.col(f"__fact.{c}").alias(c) for c in fact_columns], *[F.col(f"__valid.{a}").alias(a) for a in attributes],
    )
