"""Linear regression of sales amounts on the date, with an effect of its own for every customer.

Least squares over as many dummy columns as there are customers need none of them: within a customer, amounts and
date terms are taken as differences from the customer's means, which leaves normal equations as large as the number of date
terms. Their sums come from one row of sums per customer, and a customer's effect from the same row.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesmart.session import settle

#: Date terms; the constants taken off change no prediction and keep the sums of squares small.
TERMS = ("date_year", "date_day")
FIRST_YEAR, MIDDLE_DAY = 2000, 183
EFFECTS, COEFFICIENTS = "effects", "coefficients"


class SalesRegression(NamedTuple):
    """Coefficients of the date terms, each customer's effect (``customer_id``, ``effect``), and the effect of unknown customers."""

    coefficients: dict[str, float]
    effects: DataFrame
    unknown: float


def _terms(date: Column) -> list[Column]:
    day = date.cast("date")
    values = (F.year(day) - FIRST_YEAR, F.dayofyear(day) - MIDDLE_DAY)
    return [value.cast("double").alias(name) for name, value in zip(TERMS, values)]


def fit_sales_regression(sales: DataFrame, label: str = "amount") -> SalesRegression:
    """Exact least squares on columns ``date``, ``customer_id`` and the label.

    Rows without one of the three take no part. Where the dates do not tell the terms apart, the smallest coefficients are taken.
    Unknown customers get the effect with which the mean of all predictions is the mean amount.
    """
    y = F.col(label).cast("double").alias("y")
    rows = sales.select("customer_id", y, *_terms(F.col("date"))).dropna()
    n = F.count(F.lit(1)).cast("double").alias("n")
    sums = [F.sum(c).alias(f"s_{c}") for c in (*TERMS, "y")]
    products = [F.sum(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for a, b in _pairs()]
    by_customer = settle(rows.groupBy("customer_id").agg(n, *sums, *products), "customer-sums")

    def around_means(a: str, b: str) -> Column:
        return F.sum(F.col(f"s_{a}_{b}") - F.col(f"s_{a}") * F.col(f"s_{b}") / F.col("n")).alias(f"{a}_{b}")

    whole = by_customer.agg(F.sum("n").alias("n"), *[F.sum(f"s_{c}").alias(c) for c in (*TERMS, "y")], *[around_means(a, b) for a, b in _pairs()]).first()
    if not whole["n"]:
        raise ValueError("no row has a date, a customer and an amount")
    matrix = np.array([[whole[f"{min(a, b, key=TERMS.index)}_{max(a, b, key=TERMS.index)}"] for a in TERMS] for b in TERMS])
    solved = np.linalg.lstsq(matrix, np.array([whole[f"{t}_y"] for t in TERMS]), rcond=1e-12)[0]
    coefficients = dict(zip(TERMS, solved.tolist()))
    left = sum((F.col(f"s_{t}") * F.lit(c) for t, c in coefficients.items()), F.lit(0.0))
    effects = by_customer.select("customer_id", ((F.col("s_y") - left) / F.col("n")).alias("effect"))
    unknown = (whole["y"] - sum(c * whole[t] for t, c in coefficients.items())) / whole["n"]
    return SalesRegression(coefficients, effects, unknown)


def _pairs() -> list[tuple[str, str]]:
    names: Sequence[str] = (*TERMS, "y")
    return [(a, b) for i, a in enumerate(TERMS) for b in names[i:]]


def predict_sales(model: SalesRegression, sales: DataFrame) -> DataFrame:
    """``predicted_amount`` for every row; NULL where there is no date."""
    dated = sum((term * F.lit(model.coefficients[name]) for name, term in zip(TERMS, _terms(F.col("date")))), F.lit(0.0))
    known = model.effects.select(F.col("customer_id").alias("__customer"), F.col("effect").alias("__effect"))
    scored = sales.join(known, F.col("customer_id") == F.col("__customer"), "left")
    return scored.select(*sales.columns, (F.coalesce("__effect", F.lit(model.unknown)) + dated).alias("predicted_amount"))


def save_regression(model: SalesRegression, path: str) -> None:
    """Write a model for later predictions; ``path`` must not be the one it was read from."""
    spark = model.effects.sparkSession
    model.effects.write.mode("overwrite").parquet(f"{path}/{EFFECTS}")
    rows = [*model.coefficients.items(), ("unknown", model.unknown)]
    spark.createDataFrame(rows, "name string, value double").coalesce(1).write.mode("overwrite").parquet(f"{path}/{COEFFICIENTS}")


def load_regression(spark: SparkSession, path: str) -> SalesRegression:
    values = {r["name"]: r["value"] for r in spark.read.parquet(f"{path}/{COEFFICIENTS}").collect()}
    return SalesRegression({t: values[t] for t in TERMS}, spark.read.parquet(f"{path}/{EFFECTS}"), values["unknown"])
