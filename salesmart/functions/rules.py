"""Business rules as column expressions. First matching rule wins, NULL compares as unknown."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Order sizes and their upper bounds (exclusive) on the order total.
ORDER_SIZES = (("Small", 1000), ("Medium", 5000), ("Large", 10000))
LARGEST_ORDER = "Extra Large"

# Row quality flags.
INVALID_AMOUNT = "INVALID_AMOUNT"
INVALID_DISCOUNT = "INVALID_DISCOUNT"
MISSING_DATA = "MISSING_DATA"
VALID = "VALID"

# Sales performance tiers with their lower bounds (exclusive), and stock advice.
PERFORMANCE_TIERS = (("Mükemmel", 35000), ("İyi", 20000))
LOWEST_TIER = "Orta"
RESTOCK, ENOUGH_STOCK = "Stoğu artır", "Mevcut stok yeterli"

# Customer segments by total spending.
VIP, STANDARD = "VIP", "Standard"
VIP_ABOVE = 300

# Discount buckets with their upper bounds (inclusive, percent of the order total).
NO_DISCOUNT = "No Discount"
DISCOUNT_BUCKETS = (("1-10%", 10), ("11-20%", 20), ("21-30%", 30))
TOP_DISCOUNT = ">30%"

# Recency / frequency / monetary segments.
CHAMPIONS, LOYAL, NEW, AT_RISK, LOST, OTHERS = (
    "Champions", "Loyal Customers", "New Customers", "At Risk", "Lost", "Others",
)


def order_size(total: Column) -> Column:
    """Size bucket of an order line. A NULL total falls through to the last bucket."""
    rule = None
    for label, bound in ORDER_SIZES:
        rule = F.when(total < bound, label) if rule is None else rule.when(total < bound, label)
    return rule.otherwise(LARGEST_ORDER)


def quality_flag(quantity: Column, price: Column, total: Column, discount: Column, name: Column, category: Column) -> Column:
    not_positive = (quantity <= 0) | (price <= 0) | (total <= 0)
    return (
        F.when(not_positive, INVALID_AMOUNT)
        .when(discount > total, INVALID_DISCOUNT)
        .when(name.isNull() | category.isNull(), MISSING_DATA)
        .otherwise(VALID)
    )


def performance_tier(total_sales: Column) -> Column:
    (best, best_above), (good, good_above) = PERFORMANCE_TIERS
    return F.when(total_sales > best_above, best).when(total_sales > good_above, good).otherwise(LOWEST_TIER)


def stock_advice(total_sales: Column) -> Column:
    return F.when(total_sales > PERFORMANCE_TIERS[0][1], RESTOCK).otherwise(ENOUGH_STOCK)


def customer_segment(total: Column, vip_above: float = VIP_ABOVE) -> Column:
    return F.when(total > vip_above, VIP).otherwise(STANDARD)


def discount_bucket(discount: Column, total: Column) -> Column:
    share = F.try_divide(discount * 100, total)
    rule = F.when(discount == 0, NO_DISCOUNT)
    for label, bound in DISCOUNT_BUCKETS:
        rule = rule.when(share <= bound, label)
    return rule.otherwise(TOP_DISCOUNT)


def discount_bucket_rank(bucket: Column) -> Column:
    """Display position of a discount bucket, from no discount to the deepest one."""
    labels = [NO_DISCOUNT, *[label for label, _ in DISCOUNT_BUCKETS]]
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, labels)), bucket), F.lit(0)), F.lit(len(labels) + 1))


def rfm_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    def all_at_least(score: int) -> Column:
        return (recency >= score) & (frequency >= score) & (monetary >= score)

    return (
        F.when(all_at_least(4), CHAMPIONS)
        .when(all_at_least(3), LOYAL)
        .when((recency >= 4) & (frequency <= 2), NEW)
        .when((recency <= 2) & (frequency >= 3), AT_RISK)
        .when((recency <= 2) & (frequency <= 2), LOST)
        .otherwise(OTHERS)
    )


def price_with_tax(price: Column, rate: Column) -> Column:
    return price * (rate + 1)
