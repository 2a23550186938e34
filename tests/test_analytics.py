import random
from collections import Counter
from datetime import date, datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import Window, functions as F
from samples import as_list, as_set

from salesmart.operators import ranking, star
from salesmart.plans import analytics, models, reports
from salesmart.sources import synthetic


@pytest.mark.parametrize("rows,tiles", [(3000, 5), (3, 5), (7, 5), (1, 5), (0, 5), (500, 7)])
def test_tiles_equal_the_window_function(spark, rows, tiles):
    rng = random.Random(rows)
    # A third of the rows share one number; some have none.
    data = [(i, rng.choice([7, 7, rng.randrange(40), rng.randrange(10**6), None]), rng.randrange(-10**12, 10**12)) for i in range(rows)]
    df = spark.createDataFrame(data, "id bigint, v bigint, w bigint")
    got = ranking.with_ntiles(df, tiles, {"t": F.col("v"), "u": -F.col("w")}, F.col("id"))
    want = df.withColumn("t", F.ntile(tiles).over(Window.orderBy("v", "id"))).withColumn("u", F.ntile(tiles).over(Window.orderBy(F.desc("w"), "id")))
    assert as_list(got) == as_list(want)


def pairs_by_hand(baskets, support):
    count = Counter(p for items in baskets.values() for p in combinations(sorted(items), 2))
    return {(*p, n) for p, n in count.items() if n >= support}


@pytest.mark.parametrize("support", [1, 2, 3, 6])
@pytest.mark.parametrize("chunk", [4, 25, 10_000])
def test_pairs_equal_brute_force_with_huge_baskets(spark, support, chunk):
    rng = random.Random(support * 31 + chunk)
    baskets = {b: {rng.randrange(60) for _ in range(rng.choice([1, 2, 3, 8]))} for b in range(120)}
    baskets[500] = set(range(60))  # holds a large share of all rows
    baskets[501] = set(range(10, 55))
    baskets[502] = set(range(30, 60))
    rows = [(b, i) for b, items in baskets.items() for i in items]
    got = analytics.pair_support(spark.createDataFrame(rows, "basket bigint, item bigint"), support, chunk)
    assert as_set(got) == pairs_by_hand(baskets, support)


def tiny_star(spark):
    raw = [
        ("1", "c1", "p1", 1, 10.0, 10.0, 0.0, "2024-01-06 10:00:00"),
        ("1", "c1", "p2", 2, 10.0, 20.0, 1.0, "2024-01-06 10:00:00"),
        ("2", "c2", "p1", 1, 10.0, 10.0, 1.5, "2024-02-05 10:00:00"),
        ("3", "c1", "p1", 1, 10.0, 10.0, 4.0, "2024-02-06 10:00:00"),
    ]
    schema = "transaction_id string, customer_id string, product_id string, quantity bigint, unit_price double, total_amount double, discount_amount double, transaction_timestamp string"
    customers = spark.createDataFrame([("c1", "A", "a@x", "X", "T", "2023-01-01"), ("c2", "B", "b@x", "Y", "T", "2023-01-01")], "customer_id string, customer_name string, email string, city string, country string, created_date string")
    products = spark.createDataFrame([("p1", "P1", "k", "s", 10.0), ("p2", "P2", "k", "s", 10.0)], "product_id string, product_name string, category string, subcategory string, unit_price double")
    return star.fact_sales(spark.createDataFrame(raw, schema)), star.dim_customer(customers), star.dim_product(products), star.dim_date(spark)


def test_reports_on_a_tiny_star(spark):
    fact, customers, products, days = tiny_star(spark)
    day = reports.daily_sales_report(fact, days, date(2024, 1, 6)).first()
    assert (day.day_name, day.is_weekend, day.total_transactions, day.unique_products, day.net_sales) == ("Saturday", True, 1, 2, 29.0)
    assert len(reports.daily_sales_report(fact, days).columns) == 14
    trend = as_list(reports.monthly_trend(fact, days), "month", "net_sales", "prev_month_sales", "mom_growth_pct")
    assert trend == [(1, 29.0, None, None), (2, 14.5, 29.0, -50.0)]
    assert as_set(reports.weekend_vs_weekday(fact, days, 2024), "day_type", "total_transactions") == {("Weekend", 1), ("Weekday", 2)}
    assert as_set(reports.category_sales(fact, products), "order_count", "units_sold", "discount_rate_pct") == {(3, 5, 13.0)}
    assert as_set(reports.geo_sales(fact, customers), "city", "unique_customers", "total_orders", "city_rank_in_country") == {("X", 1, 2, 1), ("Y", 1, 1, 2)}
    assert [r.customer_id for r in reports.top_customers(fact, customers).collect()] == ["c1", "c2"]
    assert [(r.discount_bucket, r.order_count) for r in reports.discount_effectiveness(fact).collect()] == [("No Discount", 1), ("1-10%", 1), ("11-20%", 1), (">30%", 1)]
    series = reports.daily_net_series(fact, F.lit("2024-02-06").cast("date"))
    assert series.count() == 32 and series.agg(F.sum("net_sales")).first()[0] == 43.5
    retention = as_set(analytics.cohort_retention(fact), "cohort_month", "transaction_month", "customer_count", "cohort_size", "retention_rate")
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    assert retention == {(jan, jan, 1, 1, 100.0), (jan, feb, 1, 1, 100.0), (feb, feb, 1, 1, 100.0)}
    affinity = analytics.product_affinity(fact, products, min_support=1)
    assert as_set(affinity) == {("P1", "P2", 1, 33.33)}
    growth = analytics.sales_velocity(fact, products, F.lit("2024-02-10").cast("date"))
    assert as_set(growth, "product_id", "last_4w_avg", "prev_4w_avg", "growth_rate_pct") == {("p1", 14.5, 10.0, 45.0), ("p2", None, 19.0, None)}


def test_reports_do_not_join_raw_facts_to_customers(spark):
    fact, customers, *_ = tiny_star(spark)
    plan = reports.top_customers(fact, customers)._jdf.queryExecution().optimizedPlan().toString()
    join, *below = plan[plan.index("Join "):].splitlines()
    assert "Inner" in join and "Aggregate [customer_key" in "".join(below[:3])


def test_customer_totals(spark):
    customers = spark.createDataFrame([(1, "Ahmet", "Istanbul"), (2, "Ayşe", "Ankara"), (3, "Mehmet", "Izmir")], "customer_id int, customer_name string, city string")
    orders = spark.createDataFrame([(101, 1, 250.50), (102, 2, 175.00), (103, 1, 450.75)], "order_id int, customer_id int, amount double").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    totals = analytics.customer_totals(customers, orders)
    got = {(r.customer_id, float(r.total_orders), r.customer_segment) for r in totals.collect()}
    assert got == {(1, 701.25, "VIP"), (2, 175.0, "Standard"), (3, 0.0, "Standard")}
    assert tuple(analytics.customer_summary(totals, orders).first()) == (3, 876.25, 1)


def test_generated_sales(spark):
    made = synthetic.synth_sales(spark, 4000, 100, 23, "2026-02-28 18:00:00")
    assert made.count() == 4000 and made.select("transaction_id").distinct().count() == 4000
    assert as_list(made) == as_list(synthetic.synth_sales(spark, 4000, 100, 23, "2026-02-28 18:00:00"))
    bounds = made.agg(F.min("quantity"), F.max("quantity"), F.min("transaction_timestamp"), F.max("transaction_timestamp"), F.count_distinct("customer_id"), F.count_distinct("product_id")).first()
    assert bounds[:2] == (1, 5) and bounds[2] > "2026-02-27 18:00:00" and bounds[3] <= "2026-02-28 18:00:00" and bounds[4:] == (100, 23)
    shares = {round(r[0], 2) for r in made.select(F.col("discount_amount") / F.col("total_amount")).collect()}
    assert shares == {0.0, 0.05, 0.1, 0.15}
    people = synthetic.synth_customers(spark, 50, "2026-02-28")
    assert people.where(F.date_diff(F.lit("2026-02-28").cast("date"), F.to_date("created_date")).between(30, 730)).count() == 50
    assert as_set(synthetic.synth_products(spark, 23).groupBy("category").count()) == {("Electronics", 8), ("Home Appliances", 5), ("Fashion", 5), ("Books", 5)}


def test_regression_follows_a_line(spark):
    start = datetime(2024, 1, 1)
    rows = [((start + timedelta(days=i)).date(), "c1", 10.0 + 2 * i) for i in range(200)]
    sales = spark.createDataFrame(rows, "date date, customer_id string, amount double")
    scored = models.predict_sales(models.fit_sales_regression(sales), sales)
    worst = scored.agg(F.max(F.abs(F.col("amount") - F.col("predicted_amount")))).first()[0]
    assert worst < 2


def test_every_customer_has_an_effect_of_its_own(spark, path):
    rng = random.Random(4)
    effect = {f"c{i}": rng.uniform(-500, 500) for i in range(700)}
    rows = []
    for name, own in effect.items():
        for _ in range(rng.randint(1, 6)):
            day = date(2019, 1, 1) + timedelta(days=rng.randrange(2000))
            rows.append((day, name, own + 12.5 * (day.year - 2000) - 0.25 * (day.timetuple().tm_yday - 183)))
    rows += [(None, "c1", 5.0), (date(2020, 1, 1), None, 7.0), (date(2020, 1, 1), "c1", None)]
    sales = spark.createDataFrame(rows, "date date, customer_id string, amount double")
    models.save_regression(models.fit_sales_regression(sales), path)
    model = models.load_regression(spark, path)
    assert abs(model.coefficients["date_year"] - 12.5) < 1e-6 and abs(model.coefficients["date_day"] + 0.25) < 1e-6
    assert all(abs(r.effect - effect[r.customer_id]) < 1e-6 for r in model.effects.collect()) and model.effects.count() == 700
    scored = models.predict_sales(model, sales.unionByName(spark.createDataFrame([(date(2000, 7, 1), "new", 0.0)], sales.schema)))
    assert scored.where("amount is not null and customer_id like 'c%' and date is not null and abs(amount - predicted_amount) > 1e-6").isEmpty()
    assert scored.where("predicted_amount is null").count() == 1 and scored.columns == [*sales.columns, "predicted_amount"]
    new = scored.where("customer_id = 'new'").first().predicted_amount
    assert abs(new - model.unknown) < 1e-6


def test_regression_where_dates_do_not_vary(spark):
    sales = spark.createDataFrame([(date(2020, 5, 1), "a", 1.0), (date(2020, 5, 1), "a", 3.0), (date(2020, 5, 1), "b", 10.0)], "date date, customer_id string, amount double")
    model = models.fit_sales_regression(sales)
    assert set(model.coefficients.values()) == {0.0} and as_set(model.effects) == {("a", 2.0), ("b", 10.0)}
    with pytest.raises(ValueError):
        models.fit_sales_regression(sales.where("false"))


@pytest.mark.parametrize("support", [1, 2, 3, 5])
def test_large_baskets_emit_no_pairs(spark, support):
    rng = random.Random(support)
    held = {b: set(rng.sample(range(3000), size)) for b, size in enumerate([1200, 800, 790, *[rng.randint(1, 9) for _ in range(1500)]])}
    # Some pairs of the large baskets come again in small ones.
    for b in range(2000, 2060):
        held[b] = set(rng.sample(sorted(held[b % 3]), 4))
    rows = [(b, i) for b, items in held.items() for i in items]
    baskets = spark.createDataFrame(rows, "basket bigint, item bigint")
    counts = Counter(p for items in held.values() for p in combinations(sorted(items), 2))
    got = {(r.item_a, r.item_b): r.shared for r in analytics.pair_support(baskets, support, chunk=500).collect()}
    assert got == {p: n for p, n in counts.items() if n >= support}


def test_one_basket_of_ten_thousand_items(spark):
    rows = [(0, i) for i in range(10_000)] + [(1 + i // 4, (7 * i) % 10_000) for i in range(20_000)] + [(9000, 7), (9000, 14), (9000, 10_001)]
    baskets = spark.createDataFrame(rows, "basket bigint, item bigint")
    large = analytics.largest_baskets(baskets, 1, 512)
    assert large == [0]
    emitted = analytics.emitted_pairs(baskets.where(~F.col("basket").isin(large)), 512).count()
    assert emitted * 1000 < 10_000 * 9_999 / 2  # what the large basket alone would emit
    small = {}
    for basket, item in rows[10_000:]:
        small.setdefault(basket, set()).add(item)
    counts = Counter(p for items in small.values() for p in combinations(sorted(items), 2))
    got = {(r.item_a, r.item_b): r.shared for r in analytics.pair_support(baskets, 2).collect()}
    assert got == {p: n + 1 for p, n in counts.items() if max(p) < 10_000}  # the large one holds all items but one
