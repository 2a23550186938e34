"""Generated sales files of any size, for load tests. Every row is computed from its number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The vocabulary of the generated files.
CITIES = ("Istanbul", "Ankara", "Izmir", "Bursa", "Antalya", "Adana", "Konya", "Gaziantep")
FIRST_NAMES = ("Ahmet", "Mehmet", "Mustafa", "Ali", "Hüseyin", "Ayşe", "Fatma", "Emine", "Zeynep", "Hatice")
LAST_NAMES = ("Yılmaz", "Kaya", "Demir", "Çelik", "Şahin", "Yıldız", "Aydın", "Özdemir", "Arslan", "Doğan")
COUNTRY = "Turkey"
# Category, price range and share of the catalogue (products per 23).
CATEGORIES = (
    ("Electronics", 1000.0, 15000.0, 8),
    ("Home Appliances", 2000.0, 10000.0, 5),
    ("Fashion", 100.0, 2000.0, 5),
    ("Books", 20.0, 200.0, 5),
)
# Discount shares, drawn with equal chance.
DISCOUNTS = (0.0, 0.0, 0.05, 0.10, 0.15)
MAX_QUANTITY = 5


def _pick(values, seed: int) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.floor(F.rand(seed) * len(values)) + 1).cast("int"))


def _whole(low: int, high: int, seed: int) -> Column:
    return F.floor(F.rand(seed) * (high - low + 1)).cast("bigint") + low


def synth_customers(spark: SparkSession, rows: int, as_of: str, seed: int = 42) -> DataFrame:
    people = spark.range(1, rows + 1).select(
        F.format_string("CUST%05d", "id").alias("customer_id"),
        _pick(FIRST_NAMES, seed).alias("first"),
        _pick(LAST_NAMES, seed + 1).alias("last"),
        _pick(CITIES, seed + 2).alias("city"),
        _whole(30, 730, seed + 3).cast("int").alias("age"),
    )
    return people.select(
        "customer_id",
        F.concat_ws(" ", "first", "last").alias("customer_name"),
        F.concat(F.lower("first"), F.lit("."), F.lower("last"), F.lit("@example.com")).alias("email"),
        "city",
        F.lit(COUNTRY).alias("country"),
        F.date_format(F.date_sub(F.lit(as_of).cast("date"), F.col("age")), "yyyy-MM-dd").alias("created_date"),
    )


def synth_products(spark: SparkSession, rows: int, seed: int = 42) -> DataFrame:
    spread = [i for i, (_, _, _, weight) in enumerate(CATEGORIES) for _ in range(weight)]
    slot = F.element_at(F.array(*map(F.lit, spread)), ((F.col("id") - 1) % len(spread) + 1).cast("int"))
    kinds = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for n, lo, hi, _ in CATEGORIES])
    return (
        spark.range(1, rows + 1)
        .withColumn("kind", F.element_at(kinds, slot + 1))
        .select(
            F.format_string("PROD%04d", "id").alias("product_id"),
            F.concat_ws(" ", "kind.name", "id").alias("product_name"),
            F.col("kind.name").alias("category"),
            F.concat(F.lit("Sub-"), F.substring("kind.name", 1, 3)).alias("subcategory"),
            F.round(F.col("kind.lo") + F.rand(seed) * (F.col("kind.hi") - F.col("kind.lo")), 2).alias("unit_price"),
        )
    )


def synth_sales(spark: SparkSession, rows: int, customers: int, products: int, as_of: str, seed: int = 42) -> DataFrame:
    """``rows`` transactions in the 24 hours before ``as_of`` (a timestamp text).

    Customer and product are drawn by number, so no join against their tables' ids is needed; the
    price comes from a shuffle-or-broadcast join the planner chooses by the catalogue's size.
    """
    drawn = spark.range(1, rows + 1).select(
        F.format_string("TXN%08d", "id").alias("transaction_id"),
        F.format_string("CUST%05d", _whole(1, customers, seed + 10)).alias("customer_id"),
        F.format_string("PROD%04d", _whole(1, products, seed + 11)).alias("product_id"),
        _whole(1, MAX_QUANTITY, seed + 12).alias("quantity"),
        _pick(DISCOUNTS, seed + 13).alias("share"),
        _whole(0, 24 * 3600 - 1, seed + 14).alias("age"),
    )
    prices = synth_products(spark, products, seed).select("product_id", "unit_price")
    total = F.round(F.col("quantity") * F.col("unit_price"), 2)
    moment = F.timestamp_seconds(F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.col("age"))
    return (
        drawn.join(prices, "product_id")
        .withColumn("total_amount", total)
        .select(
            "transaction_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
            F.round(F.col("total_amount") * F.col("share"), 2).alias("discount_amount"),
            F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("transaction_timestamp"),
        )
    )
