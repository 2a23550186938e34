"""Data-quality checks. Each returns rows; gates also have a strict form that fails the run.

A check that is only a column can be optimised away when nobody reads it, so the strict forms
collect their one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F

from salesmart.functions import rules
from salesmart.functions.money import mean, percent
from salesmart.operators.merge import duplicate_keys
from salesmart.session import settle

PASS = "PASS"
# Lowest share of valid rows (percent), volume band, freshness limit.
MIN_QUALITY_PCT = 95
VOLUME_LOW, VOLUME_HIGH = 0.5, 1.5
VOLUME_DAYS = 8
MAX_AGE_HOURS = 24
# Gate texts.
VALIDATION_PASSED = "VALIDATION_PASSED"
QUALITY_CHECK_PASSED = "QUALITY_CHECK_PASSED"
STAGING_EMPTY = "Staging tabloda veri yok!"
STAGING_TOO_LARGE = "Beklenmedik yüksek veri hacmi!"
STAGING_NEGATIVE_AMOUNT = "Negatif tutar var!"
STAGING_NEGATIVE_QUANTITY = "Negatif miktar var!"
FACT_EMPTY = "Fact tabloya veri eklenmedi!"
NO_STAGING = "Staging boş!"
NOTHING_LOADED = "Production'a veri yüklenmedi!"
TOO_MUCH_LOADED = "Production'da fazla veri var!"
ALL_PASSED = "✅ ALL QUALITY CHECKS PASSED"
NO_DATA = "ERROR: No data found for today"
NULLS_FOUND = "ERROR: Found NULL values - OrderID:%s, CustomerID:%s, ProductID:%s, OrderDate:%s"
BAD_RANGES = "ERROR: Invalid value ranges - InvalidQty:%s, InvalidPrice:%s, InvalidAmount:%s"
BAD_RULES = "ERROR: Business rule violations - InvalidDiscount:%s, NegativeNet:%s"
DUPLICATES_FOUND = "ERROR: Found %s duplicate orders"
LOW_SCORE = "ERROR: Data quality score too low - %s%% (minimum 95%% required)"
PASSED_REPORT = "✅ ALL QUALITY CHECKS PASSED - Total Rows: %s, Quality Score: %s%%"
FAILED_REPORT = """❌ DATA QUALITY CHECKS FAILED:
1. Row Count: %s
2. Null Check: %s
3. Value Range: %s
4. Business Rules: %s
5. Duplicate Check: %s
6. Quality Score: %s
Total Rows: %s, Invalid Records: %s, Quality Score: %s%%"""
# The checks in the order of that report.
CHECKS = (
    "row_count_check", "null_check", "value_range_check", "business_rule_check", "duplicate_check", "quality_score_check",
)


class QualityError(Exception):
    """A strict check failed; the message holds the verdict."""


def require_pass(verdict: DataFrame, column: str, passed: str) -> str:
    """Collect a one-row verdict and fail unless it starts with ``passed``."""
    text = verdict.select(column).first()[0]
    if text is None or not text.startswith(passed):
        raise QualityError(text)
    return text


def check_true(df: DataFrame, condition: Column) -> DataFrame:
    """One row ``passed``: the aggregate ``condition`` holds (NULL counts as failed)."""
    return df.agg(F.coalesce(condition, F.lit(False)).alias("passed"))


def check_min_rows(df: DataFrame, minimum: int) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumn("passed", F.col("row_count") >= minimum)


def check_value(df: DataFrame, value: Column, *, minimum: float | None = None, equals: float | None = None, tolerance: float = 0.0) -> DataFrame:
    """Compare an aggregate with a lower bound, or with a target within a relative tolerance."""
    if (minimum is None) == (equals is None):
        raise ValueError("give either minimum or equals")
    observed = df.agg(value.cast("double").alias("value"))
    if minimum is not None:
        passed = F.col("value") >= minimum
    else:
        passed = F.abs(F.col("value") - equals) <= abs(equals) * tolerance
    return observed.withColumn("passed", F.coalesce(passed, F.lit(False)))


def require_true(check: DataFrame) -> None:
    """Strict form of the checks with a ``passed`` column."""
    row = check.first()
    if not row["passed"]:
        raise QualityError(f"check failed: {row.asDict()}")


def validate_staging(staging: DataFrame, max_rows: int) -> DataFrame:
    """First problem of a staging load, or the pass text; ``max_rows`` is what a load may hold at most."""
    rows = F.count(F.lit(1))
    return staging.agg(
        F.when(rows == 0, STAGING_EMPTY)
        .when(rows > max_rows, STAGING_TOO_LARGE)
        .when(F.count_if(F.col("total_amount") < 0) > 0, STAGING_NEGATIVE_AMOUNT)
        .when(F.count_if(F.col("quantity") < 0) > 0, STAGING_NEGATIVE_QUANTITY)
        .otherwise(VALIDATION_PASSED)
        .alias("validation_result")
    )


def validate_fact_count(fact: DataFrame) -> DataFrame:
    return fact.agg(F.when(F.count(F.lit(1)) == 0, FACT_EMPTY).otherwise(VALIDATION_PASSED).alias("validation"))


def reconcile_counts(staging: DataFrame, production: DataFrame) -> DataFrame:
    """Compare the two row counts; each is a scalar subquery, so nothing is joined."""
    def rows(df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"))

    both = rows(staging).select(F.col("n").alias("staging_count"), rows(production).scalar().alias("prod_count"))
    return both.withColumn(
        "result",
        F.when(F.col("staging_count") == 0, NO_STAGING)
        .when(F.col("prod_count") == 0, NOTHING_LOADED)
        .when(F.col("prod_count") > F.col("staging_count"), TOO_MUCH_LOADED)
        .otherwise(QUALITY_CHECK_PASSED),
    )


def _metric_counts() -> list[Column]:
    """The counts that need no look at other rows."""
    def rows_where(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    return [
        F.count(F.lit(1)).alias("total_rows"),
        rows_where(F.col("order_id").isNull(), "null_order_ids"),
        rows_where(F.col("customer_id").isNull(), "null_customer_ids"),
        rows_where(F.col("product_id").isNull(), "null_product_ids"),
        rows_where(F.col("order_date").isNull(), "null_order_dates"),
        rows_where(F.col("quantity") <= 0, "invalid_quantities"),
        rows_where(F.col("unit_price") <= 0, "invalid_prices"),
        rows_where(F.col("total_amount") <= 0, "invalid_amounts"),
        rows_where(F.col("discount_amount") < 0, "negative_discounts"),
        rows_where(F.col("discount_amount") > F.col("total_amount"), "invalid_discount_amount"),
        rows_where(F.col("net_amount") < 0, "negative_net_amounts"),
        rows_where(F.col("data_quality_flag") != rules.VALID, "invalid_records"),
    ]


def _duplicates() -> Column:
    return (F.count(F.lit(1)) - F.count_distinct("order_id")).alias("duplicate_orders")


def quality_metrics(clean: DataFrame) -> DataFrame:
    """Thirteen counts over clean order lines, in one pass."""
    return clean.agg(*_metric_counts(), _duplicates())


class Watched(NamedTuple):
    """Clean order lines, settled, and the counts that were taken while they were written."""

    rows: DataFrame
    counts: dict

    def metrics(self, summary: DataFrame | None = None) -> DataFrame:
        """What :func:`quality_metrics` says of the rows, without reading them.

        Repeated orders are told by the ``total_orders`` of the ``summary`` if the rows are of one day; orders could repeat
        from day to day otherwise, and one column is read for them.
        """
        counts = {k: v for k, v in self.counts.items() if k not in ("first_day", "last_day")}
        one_day = counts["null_order_dates"] == 0 and self.counts["first_day"] == self.counts["last_day"]
        if summary is not None and one_day:
            distinct = summary.agg(F.coalesce(F.sum("total_orders"), F.lit(0))).first()[0]
            counts["duplicate_orders"] = counts["total_rows"] - distinct
        else:
            counts["duplicate_orders"] = self.rows.agg(_duplicates()).first()[0]
        return self.rows.sparkSession.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))


def watch(clean: DataFrame) -> Watched:
    """Settle clean order lines and count in the same pass.

    The pass writes files and moves nothing behind the counting, so a task that is run again, on a lost executor's behalf, counts once.
    """
    seen = Observation()
    days = [F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")]
    rows = settle(clean.observe(seen, *_metric_counts(), *days), "clean")
    return Watched(rows, dict(seen.get))


def quality_verdicts(metrics: DataFrame) -> DataFrame:
    """Six verdicts (PASS or an ERROR text) and the quality score, from :func:`quality_metrics`."""
    def unless_zero(text: str, *names: str) -> Column:
        bad = reduce(lambda a, b: a | b, [F.col(n) > 0 for n in names])
        return F.when(bad, F.format_string(text, *names)).otherwise(PASS)

    total, invalid = F.col("total_rows"), F.col("invalid_records")
    score = percent(total - invalid, total)
    too_low = (invalid > 0) & ((total - invalid) * 100 < total * MIN_QUALITY_PCT)
    return metrics.select(
        F.when(total == 0, NO_DATA).otherwise(PASS).alias("row_count_check"),
        unless_zero(NULLS_FOUND, "null_order_ids", "null_customer_ids", "null_product_ids", "null_order_dates").alias("null_check"),
        unless_zero(BAD_RANGES, "invalid_quantities", "invalid_prices", "invalid_amounts").alias("value_range_check"),
        unless_zero(BAD_RULES, "invalid_discount_amount", "negative_net_amounts").alias("business_rule_check"),
        unless_zero(DUPLICATES_FOUND, "duplicate_orders").alias("duplicate_check"),
        F.when(too_low, F.format_string(LOW_SCORE, _pct_text(score))).otherwise(PASS).alias("quality_score_check"),
        "total_rows",
        "invalid_records",
        score.alias("quality_score_pct"),
    )


def _pct_text(score: Column) -> Column:
    """A percentage without trailing zeros, as ``97.5`` or ``100``; ``n/a`` where there is none."""
    digits = score.cast("decimal(10,2)").cast("string")
    return F.coalesce(F.regexp_replace(digits, r"\.?0+$", ""), F.lit("n/a"))


def quality_gate(metrics: DataFrame) -> DataFrame:
    """One text: the success line, or the whole report of failed checks."""
    passed = reduce(lambda a, b: a & b, [F.col(c) == PASS for c in CHECKS])
    score = _pct_text(F.col("quality_score_pct"))
    return quality_verdicts(metrics).select(
        F.when(passed, F.format_string(PASSED_REPORT, "total_rows", score))
        .otherwise(F.format_string(FAILED_REPORT, *CHECKS, "total_rows", "invalid_records", score))
        .alias("validation_result")
    )


def enforce_quality(clean: DataFrame) -> str:
    """Strict quality gate over clean order lines."""
    return enforce_metrics(quality_metrics(clean))


def enforce_metrics(metrics: DataFrame) -> str:
    """The same gate over counts that are there already."""
    return require_pass(quality_gate(metrics), "validation_result", ALL_PASSED)


def fact_alerts(fact: DataFrame) -> DataFrame:
    """One row per alert raised by the fact table; no rows when all is well."""
    rows = F.count(F.lit(1))
    counts = fact.agg(
        rows.alias("row_count"),
        F.count_if(F.col("customer_key").isNull() | F.col("product_key").isNull()).alias("null_check"),
        F.count_if(F.col("net_amount") < 0).alias("negative_amount"),
        (rows - F.count_distinct("transaction_id")).alias("duplicate_check"),
    )
    checks = [
        F.struct(F.lit(name).alias("check_name"), F.col(name).alias("issues"), bad.alias("failed"))
        for name, bad in [
            ("row_count", F.col("row_count") == 0),
            *[(n, F.col(n) > 0) for n in ("null_check", "duplicate_check", "negative_amount")],
        ]
    ]
    return counts.select(F.explode(F.array(*checks)).alias("c")).where("c.failed").select("c.check_name", "c.issues")


def require_no_alerts(alerts: DataFrame) -> None:
    found = alerts.collect()
    if found:
        raise QualityError("; ".join(f"{r.check_name}: {r.issues}" for r in found))


def volume_check(fact: DataFrame, as_of: Column, day: str = "transaction_date") -> DataFrame:
    """The day's row count against the mean of the days 1 to 8 before it."""
    per_day = (
        fact.where(F.col(day).between(F.date_sub(as_of, VOLUME_DAYS), as_of))
        .groupBy(F.col(day).alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    earlier = F.col("day") < as_of
    compared = per_day.agg(
        F.coalesce(F.sum(F.when(~earlier, F.col("n"))), F.lit(0)).alias("today_count"),
        mean(F.sum(F.when(earlier, F.col("n"))), F.count_if(earlier)).alias("avg_count"),
    )
    today, usual = F.col("today_count"), F.col("avg_count")
    return compared.withColumn(
        "status", F.when(today < usual * VOLUME_LOW, "LOW").when(today > usual * VOLUME_HIGH, "HIGH").otherwise("OK"),
    )


def freshness_check(df: DataFrame, moment: str, as_of: Column, max_hours: int = MAX_AGE_HOURS) -> DataFrame:
    """Whole hours since the newest row, and whether that is recent enough."""
    hours = F.timestamp_diff("HOUR", F.max(moment), as_of)
    return df.agg(hours.alias("hours_since_update")).withColumn(
        "is_fresh", F.coalesce(F.col("hours_since_update") <= max_hours, F.lit(False))
    )


def schema_check(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per expected column: is it there? Answered from the schema alone."""
    present = set(df.columns)
    rows = [(name, name in present) for name in expected]
    return df.sparkSession.createDataFrame(rows, "column_name string, present boolean")


def require_columns(df: DataFrame, expected: Sequence[str]) -> None:
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise QualityError(f"missing columns: {missing}")


def require_unique(df: DataFrame, column: str) -> None:
    """Fail if a non-null value occurs twice, such as one hashed key for two business keys."""
    repeated = duplicate_keys(df, [column]).limit(3).collect()
    if repeated:
        raise QualityError(f"{column} is not unique: {[row[0] for row in repeated]}")


def column_health(df: DataFrame, not_null: str, unique: str) -> DataFrame:
    """Are all values of one column filled, and of another one distinct?"""
    return df.agg(
        (F.count_if(F.col(not_null).isNull()) == 0).alias("no_nulls"),
        (F.count(F.lit(1)) == F.count_distinct(unique)).alias("no_duplicates"),
    )
