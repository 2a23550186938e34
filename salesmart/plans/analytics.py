"""Customer and product analyses: segments, cohorts, velocity, baskets, customer totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.functions import rules
from salesmart.functions.dates import month_start, week_start
from salesmart.functions.money import as_doubles, percent
from salesmart.operators.ranking import with_ntiles
from salesmart.session import settle

SCORES = 5
# Weeks looked at, and weeks of the recent and of the previous period.
VELOCITY_WEEKS, RECENT_WEEKS, PREVIOUS_WEEKS = 12, 4, 8


def rfm_segments(fact: DataFrame, dim_customer: DataFrame, as_of: Column, tie: str = "customer_key") -> DataFrame:
    """Recency, frequency and money scores (1-5) and segment of every customer, best first.

    Customers with equal values are ordered by the number in ``tie``.
    """
    per_customer = fact.groupBy("customer_key").agg(
        F.max("transaction_date").alias("last_purchase_date"),
        F.count_distinct("transaction_id").alias("frequency"),
        F.sum("net_amount").alias("monetary_value"),
    )
    metrics = per_customer.join(dim_customer, "customer_key").select(
        F.col(tie).alias("tie"), "customer_id", "customer_name",
        F.date_diff(as_of, "last_purchase_date").cast("bigint").alias("recency_days"), "frequency", "monetary_value",
    )
    # Three global orders follow; the facts are aggregated once for all of them.
    # Whole numbers: days, orders and cents.
    orders = {"r_score": -F.col("recency_days"), "f_score": F.col("frequency"), "m_score": (F.col("monetary_value") * 100).cast("bigint")}
    scored = with_ntiles(settle(metrics, "rfm"), SCORES, orders, F.col("tie"))
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return as_doubles(
        scored.select(
            "customer_id", "customer_name", "recency_days", "frequency", "monetary_value", r, f, m,
            (r + f + m).alias("rfm_total"), rules.rfm_segment(r, f, m).alias("customer_segment"),
        )
    ).orderBy(F.desc("rfm_total"), "customer_id")


def cohort_retention(fact: DataFrame) -> DataFrame:
    """Active customers per first-purchase month and later month, with the share retained.

    One shuffle of the facts, of at most one set of months per customer and task.
    """
    month = month_start(F.col("transaction_date"))
    customers = fact.where(F.col("customer_key").isNotNull()).groupBy("customer_key").agg(F.collect_set(month).alias("months"))
    cells = (
        customers.select(F.array_min("months").alias("cohort_month"), F.explode("months").alias("transaction_month"))
        .groupBy("cohort_month", "transaction_month")
        .agg(F.count(F.lit(1)).alias("customer_count"))
    )
    in_cohort = Window.partitionBy("cohort_month").orderBy("transaction_month")
    sized = cells.withColumn("cohort_size", F.first_value("customer_count").over(in_cohort))
    return as_doubles(
        sized.withColumn("retention_rate", percent(F.col("customer_count"), F.col("cohort_size")))
    ).orderBy("cohort_month", "transaction_month")


def sales_velocity(fact: DataFrame, dim_product: DataFrame, as_of: Column, rows: int = 20) -> DataFrame:
    """Products by growth of their mean weekly sales, last four weeks against the four before."""
    recent = fact.where(F.col("transaction_date") >= F.date_sub(as_of, 7 * VELOCITY_WEEKS))
    weekly = recent.groupBy("product_key", week_start(F.col("transaction_date")).alias("week")).agg(
        F.sum("net_amount").alias("sales")
    )
    is_last = F.col("week") >= F.date_sub(as_of, 7 * RECENT_WEEKS)
    is_previous = ~is_last & (F.col("week") >= F.date_sub(as_of, 7 * PREVIOUS_WEEKS))

    def total(when: Column) -> Column:
        return F.sum(F.when(when, F.col("sales")))

    per_product = weekly.groupBy("product_key").agg(
        total(is_last).alias("last_sum"), F.count_if(is_last).alias("last_n"),
        total(is_previous).alias("prev_sum"), F.count_if(is_previous).alias("prev_n"),
    ).where(F.col("prev_n") > 0)
    last_n, prev_n = F.col("last_n").cast("decimal(4,0)"), F.col("prev_n").cast("decimal(4,0)")
    last_sum, prev_sum = F.col("last_sum").cast("decimal(18,2)"), F.col("prev_sum").cast("decimal(18,2)")
    # Ratio of the means, brought to one fraction so that it is rounded once.
    growth = percent(last_sum * prev_n - prev_sum * last_n, prev_sum * last_n)
    return as_doubles(
        per_product.join(dim_product.select("product_key", "product_id", "product_name", "category"), "product_key")
        .select(
            "product_id", "product_name", "category",
            (F.try_divide(F.col("last_sum").cast("double"), F.col("last_n"))).alias("last_4w_avg"),
            (F.col("prev_sum").cast("double") / F.col("prev_n")).alias("prev_4w_avg"),
            growth.alias("growth_rate_pct"),
        )
        .orderBy(F.desc_nulls_last("growth_rate_pct"), "product_id")
        .limit(rows)
    )


#: Of so many baskets at most an item keeps a bit each, in one 64-bit number.
MOST_LARGE = 63


def pair_support(baskets: DataFrame, min_support: int, chunk: int = 512) -> DataFrame:
    """Item pairs that share at least ``min_support`` baskets, with the number they share.

    ``baskets`` holds distinct (basket, item) rows and is read several times: hand in a settled
    frame. Items that are themselves in fewer than ``min_support`` baskets are dropped first: no pair
    of theirs can reach it. The ``min_support - 1`` largest baskets (of more than ``chunk`` items, 63 at most) emit no pairs: a pair
    that reaches the support shares another basket too and is found there. What it shares of the large ones is the
    intersection of its items' bits, one for each of these baskets. Every other basket is cut into slices of
    about ``chunk`` items, and each slice meets the whole basket in a task of its own.
    """
    frequent = baskets.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_support)
    kept = baskets.join(frequent.select("item"), "item", "left_semi")
    large = largest_baskets(kept, min(min_support - 1, MOST_LARGE), chunk)
    pairs = emitted_pairs(kept.where(~F.col("basket").isin(large)) if large else kept, chunk)
    counted = pairs.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= min_support - len(large))
    if not large:
        return counted
    bits = baskets.sparkSession.createDataFrame([(b, 1 << i) for i, b in enumerate(large)], f"basket {baskets.schema['basket'].dataType.simpleString()}, bit bigint")
    masks = kept.join(F.broadcast(bits), "basket").groupBy("item").agg(F.bit_or("bit").alias("mask"))
    for side in ("a", "b"):
        counted = counted.join(masks.select(F.col("item").alias(f"item_{side}"), F.col("mask").alias(f"mask_{side}")), f"item_{side}", "left")
    both = F.coalesce(F.bit_count(F.col("mask_a").bitwiseAND(F.col("mask_b"))), F.lit(0))
    counted = counted.select("item_a", "item_b", (F.col("shared") + both).alias("shared"))
    return counted.where(F.col("shared") >= min_support)


def largest_baskets(baskets: DataFrame, most: int, items: int) -> list:
    """The ``most`` largest baskets of more than ``items`` items, ``most`` being a small number."""
    if most < 1:
        return []
    sizes = baskets.groupBy("basket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > items)
    return [r[0] for r in sizes.orderBy(F.desc("n"), "basket").limit(most).collect()]


def emitted_pairs(baskets: DataFrame, chunk: int) -> DataFrame:
    """(item_a, item_b) once for each basket that holds both."""
    slices = F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("slices")
    sized = baskets.join(baskets.groupBy("basket").agg(F.count(F.lit(1)).alias("n"), slices).where("n > 1"), "basket")
    left = sized.select("basket", F.col("item").alias("item_a"), F.pmod(F.xxhash64("item"), "slices").cast("int").alias("slice"))
    right = sized.select("basket", F.col("item").alias("item_b"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    return left.join(right, ["basket", "slice"]).where(F.col("item_a") < F.col("item_b")).select("item_a", "item_b")


def product_affinity(
    fact: DataFrame, names: DataFrame, item: str = "product_key", code: str = "product_id", name: str = "product_name",
    min_support: int = 10, rows: int = 20, chunk: int = 512,
) -> DataFrame:
    """Items bought together in at least ``min_support`` transactions, most frequent pairs first.

    ``names`` maps ``item`` to the ``name`` to show and to the ``code`` that orders the two items of
    a pair, and pairs with equal counts.
    """
    # One look at the facts: transactions without an item count too, but pair with nothing.
    baskets = fact.select(F.col("transaction_id").alias("basket"), F.col(item).alias("item")).dropna(subset=["basket"])
    baskets = settle(baskets.distinct(), "baskets")
    pairs = pair_support(baskets.dropna(), min_support, chunk)
    transactions = baskets.agg(F.count_distinct("basket")).scalar()
    label = F.struct(F.col(code).alias("code"), F.col(name).alias("name"))
    a = names.select(F.col(item).alias("item_a"), label.alias("a"))
    b = names.select(F.col(item).alias("item_b"), label.alias("b"))
    named = pairs.join(a, "item_a").join(b, "item_b").select(
        "shared", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    top = named.orderBy(F.desc("shared"), "a", "b").limit(rows)
    return as_doubles(
        top.select(
            F.col("a.name").alias("product_a"), F.col("b.name").alias("product_b"), F.col("shared").alias("co_occurrence_count"),
            percent(F.col("shared"), transactions).alias("support_pct"),
        )
    )


def customer_totals(customers: DataFrame, orders: DataFrame, vip_above: float = rules.VIP_ABOVE) -> DataFrame:
    """Every customer with the sum of their orders (0 without any) and a segment.

    Orders are summed per customer before the join.
    """
    spent = orders.groupBy("customer_id").agg(F.sum("amount").alias("spent"))
    total = F.coalesce(F.col("spent"), F.lit(0))
    return customers.join(spent, "customer_id", "left").select(
        "customer_id", "customer_name", "city", total.alias("total_orders"),
        rules.customer_segment(total, vip_above).alias("customer_segment"),
    )


def customer_summary(totals: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers, VIPs and revenue; the revenue includes orders of unknown customers."""
    revenue = orders.agg(F.coalesce(F.sum("amount"), F.lit(0))).scalar()
    counted = totals.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("customer_segment") == rules.VIP).alias("vip_customers"),
    )
    return as_doubles(counted.select("total_customers", revenue.alias("total_revenue"), "vip_customers"))
