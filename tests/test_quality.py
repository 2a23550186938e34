from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from samples import as_set, staging, staging_rows

from salesmart.operators import quality, star, transform

CLEAN = ["row_count_check", "null_check", "value_range_check", "business_rule_check", "duplicate_check", "quality_score_check"]

MONEY = {"total_amount", "discount_amount", "net_amount"}


def clean(spark, *edits, copies=2):
    """Valid clean rows with the given column edits applied to the first ones."""
    rows = [(f"x{c}{i}", *r[1:]) for c in range(copies) for i, r in enumerate(staging_rows())]
    df = transform.transform_sales(staging(spark, rows=rows))
    data = [r.asDict() for r in df.collect()]
    for i, edit in enumerate(edits):
        data[i].update({k: Decimal(v) if k in MONEY else v for k, v in edit.items()})
    return spark.createDataFrame([tuple(d[c] for c in df.columns) for d in data], df.schema)


@pytest.mark.parametrize(
    "edit,failing",
    [
        ({"order_id": None}, {"null_check", "duplicate_check"}),  # a missing id is also no distinct id
        ({"customer_id": None}, {"null_check"}),
        ({"product_id": None}, {"null_check"}),
        ({"order_date": None}, {"null_check"}),
        ({"quantity": 0}, {"value_range_check"}),
        ({"unit_price": -1.0}, {"value_range_check"}),
        ({"total_amount": 0, "discount_amount": 0}, {"value_range_check"}),
        ({"discount_amount": 10**6}, {"business_rule_check"}),
        ({"net_amount": -1}, {"business_rule_check"}),
        ({"order_id": "x02"}, {"duplicate_check"}),
        ({"data_quality_flag": "MISSING_DATA"}, set()),  # 1 of 30 is tolerated
        ({"discount_amount": -5}, set()),  # counted, not judged
    ],
)
def test_each_defect_fails_its_own_check(spark, edit, failing):
    verdicts = quality.quality_verdicts(quality.quality_metrics(clean(spark, edit))).first()
    assert {c for c in CLEAN if verdicts[c] != "PASS"} == failing


@pytest.mark.parametrize("bad,fails", [(5, False), (6, True)])
def test_quality_score_limit(spark, bad, fails):
    rows = [("VALID" if i >= bad else "MISSING_DATA",) for i in range(100)]
    df = clean(spark).limit(1).drop("data_quality_flag", "order_id").crossJoin(spark.createDataFrame(rows, "data_quality_flag string"))
    df = df.withColumn("order_id", F.monotonically_increasing_id().cast("string"))
    verdict = quality.quality_verdicts(quality.quality_metrics(df)).first()
    assert (verdict.quality_score_check != "PASS") == fails
    if fails:
        assert "94%" in verdict.quality_score_check


def test_gate_passes_and_fails_with_the_whole_report(spark):
    good = clean(spark)
    assert quality.enforce_quality(good) == "✅ ALL QUALITY CHECKS PASSED - Total Rows: 30, Quality Score: 100%"
    with pytest.raises(quality.QualityError, match="InvalidQty:1"):
        quality.enforce_quality(clean(spark, {"quantity": 0}))
    with pytest.raises(quality.QualityError, match="No data found"):
        quality.enforce_quality(good.where("false"))


def test_staging_fact_and_count_gates(spark):
    raw = staging(spark)
    verdict = lambda df, max_rows=100: quality.validate_staging(df, max_rows).first()[0]
    assert verdict(raw) == quality.VALIDATION_PASSED
    assert verdict(raw.where("false")) == quality.STAGING_EMPTY
    assert verdict(raw, max_rows=3) == quality.STAGING_TOO_LARGE
    assert verdict(raw.withColumn("total_amount", -F.col("total_amount"))) == quality.STAGING_NEGATIVE_AMOUNT
    assert verdict(raw.withColumn("quantity", -F.col("quantity"))) == quality.STAGING_NEGATIVE_QUANTITY
    assert quality.reconcile_counts(raw, raw).first().result == quality.QUALITY_CHECK_PASSED
    assert quality.reconcile_counts(raw.where("false"), raw).first().result == quality.NO_STAGING
    assert quality.reconcile_counts(raw, raw.where("false")).first().result == quality.NOTHING_LOADED
    assert quality.reconcile_counts(raw, raw.union(raw)).first().result == quality.TOO_MUCH_LOADED
    with pytest.raises(quality.QualityError):
        quality.require_pass(quality.validate_fact_count(raw.where("false")), "validation", quality.VALIDATION_PASSED)


def test_simple_checks(spark):
    raw = staging(spark)
    total = F.sum("total_amount")
    assert quality.check_true(raw, F.count(F.lit(1)) > 0).first()[0] is True
    assert quality.check_true(raw, F.max("loaded_at").isNull()).first()[0] is False
    assert quality.check_min_rows(raw, 15).first().passed and not quality.check_min_rows(raw, 16).first().passed
    assert quality.check_value(raw, total, minimum=1000).first().passed
    assert not quality.check_value(raw, total, equals=1000, tolerance=0.1).first().passed
    assert quality.check_value(raw, total, equals=40000, tolerance=0.01).first().passed
    with pytest.raises(quality.QualityError):
        quality.require_true(quality.check_min_rows(raw, 16))
    assert as_set(quality.schema_check(raw, ["order_id", "nope"])) == {("order_id", True), ("nope", False)}
    quality.require_unique(raw, "order_id")
    with pytest.raises(quality.QualityError, match="customer_id is not unique"):
        quality.require_unique(raw, "customer_id")
    with pytest.raises(quality.QualityError, match="nope"):
        quality.require_columns(raw, ["order_id", "nope"])
    assert tuple(quality.column_health(raw, "customer_id", "customer_id").first()) == (True, False)


def test_fact_alerts(spark):
    schema = "transaction_id string, customer_key bigint, product_key bigint, net_amount double"
    fine = spark.createDataFrame([("a", 1, 1, 1.0)], schema)
    assert quality.fact_alerts(fine).count() == 0
    bad = spark.createDataFrame([("a", 1, None, -1.0), ("a", None, 1, 1.0)], schema)
    assert as_set(quality.fact_alerts(bad)) == {("null_check", 2), ("duplicate_check", 1), ("negative_amount", 1)}
    assert as_set(quality.fact_alerts(bad.where("false"))) == {("row_count", 0)}
    with pytest.raises(quality.QualityError, match="null_check: 2"):
        quality.require_no_alerts(quality.fact_alerts(bad))


@pytest.mark.parametrize("today,status", [(4, "LOW"), (5, "OK"), (15, "OK"), (16, "HIGH"), (0, "LOW")])
def test_volume_and_freshness(spark, today, status):
    days = [f"2024-01-{d:02d}" for d in range(2, 10) for _ in range(10)] + ["2024-01-10"] * today + ["2024-01-01"] * 500
    fact = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("transaction_date"))
    row = quality.volume_check(fact, F.lit("2024-01-10").cast("date")).first()
    assert (row.today_count, row.avg_count, row.status) == (today, 10.0, status)
    moment = spark.sql("select timestamp'2024-01-10 00:00:00' as t")
    for as_of, hours, fresh in (("2024-01-11 00:59:00", 24, True), ("2024-01-11 01:00:00", 25, False)):
        assert tuple(quality.freshness_check(moment, "t", F.lit(as_of).cast("timestamp")).first()) == (hours, fresh)


def test_orphans_are_counted_per_key(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (3,)], "customer_key int")
    assert as_set(star.orphan_check(fact, spark.createDataFrame([(2,)], "customer_key int"), "customer_key")) == {(1, 2), (3, 1)}
