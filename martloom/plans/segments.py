"""Customer segments over the last twelve months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions import as_instant, as_text, clean_lower, first_match, money_sum
from martloom.operators.lookup import enrich
from martloom.operators.periods import trailing_months
from martloom.operators.ranking import with_percent_rank
from martloom.operators.rollup import heaviest
from martloom.plans.conform import UNRECOGNISED_STATUSES, order_totals

# Cut points, bounds and names of the segments and personas.
VALUE_CUTS = (0.85, 0.40)
VOLUME_CUTS = (7, 2)
PERSONAS = ("VIP", "Core Customer", "Casual Buyer")
SIX_PERSONAS = {
    ("High", "High"): "VIP Loyalists",
    ("High", "Medium"): "Premium One-Offs",
    ("High", "Low"): "Premium One-Offs",
    ("Medium", "High"): "Frequent Core Shoppers",
    ("Medium", "Low"): "Casual Core Shoppers",
    ("Low", "High"): "Bargain Hunters",
    ("Low", "Low"): "Occasional Low-Value",
}
CUSTOMER_TIERS = {
    ("High", "High"): "High Value Customer",
    ("High", "Low"): "High Value Customer",
    ("Medium", "High"): "Medium Value Customer",
    ("Medium", "Medium"): "Medium Value Customer",
    ("Low", "Low"): "Low Value Customer",
    ("Medium", "Low"): "Medium Value Customer",
    ("Low", "High"): "Low Value Customer",
}


def tier(measure: str, cuts: tuple[float, float]) -> Column:
    """High from the first cut, Medium from the second, else Low; an unknown measure is Low."""
    high, medium = cuts
    return first_match([(F.col(measure) >= high, "High"), (F.col(measure) >= medium, "Medium")], "Low")


def delivered_orders(raw_orders: DataFrame) -> DataFrame:
    delivered = raw_orders.filter(clean_lower("order_status") == "delivered")
    return delivered.withColumn("order_purchase_timestamp", as_instant("order_purchase_timestamp"))


def last_12m_orders(raw_orders: DataFrame, raw_items: DataFrame, raw_customers: DataFrame) -> DataFrame:
    return recent_orders(delivered_orders(raw_orders), raw_items, raw_customers)


def recent_orders(
    delivered: DataFrame, raw_items: DataFrame, raw_customers: DataFrame, known_totals: DataFrame | None = None
) -> DataFrame:
    """Delivered orders of the twelve months before the newest delivered one, with order total and
    customer. The total is NULL for an order without items. Stored totals of all orders save the sum over the items."""
    recent = trailing_months(delivered, "order_purchase_timestamp", 12)
    totals = known_totals
    if totals is None:  # only items of these orders are summed and moved, not those of all years
        totals = order_totals(raw_items.join(recent.select("order_id"), on="order_id", how="left_semi"))
    with_totals = enrich(recent, totals, ["order_id"], ["total_price"])
    return enrich(with_totals, raw_customers, ["customer_id"], ["customer_unique_id"])


def _with_value_segment(customers: DataFrame, cuts: tuple[float, float]) -> DataFrame:
    """The percent rank reads its input twice. Both readers start at the same shuffle by customer, which Spark
    reuses, so orders and items are read once."""
    ranked = with_percent_rank(customers, "total_price_unique_cust", "spend_percentile")
    return ranked.withColumns(
        {
            "spend_percentile_100": F.col("spend_percentile") * 100,
            "value_segment": tier("spend_percentile", cuts),
        }
    )


def customer_value(recent: DataFrame, cuts: tuple[float, float] = VALUE_CUTS) -> DataFrame:
    """Spend, its percent rank and the value segment per customer."""
    spend = recent.groupBy("customer_unique_id").agg(money_sum("total_price").alias("total_price_unique_cust"))
    return _with_value_segment(spend, cuts)


def customer_volume(recent: DataFrame, cuts: tuple[int, int] = VOLUME_CUTS) -> DataFrame:
    """Order count and volume segment per customer."""
    counts = recent.groupBy("customer_unique_id").agg(F.count("order_id").alias("order_volume"))
    return counts.withColumn("volume_segment", tier("order_volume", cuts))


def base_persona() -> Column:
    """High spenders are VIP. Core customers buy medium in both senses, or often. The rest are casual."""
    value, volume = F.col("value_segment"), F.col("volume_segment")
    vip, core, casual = PERSONAS
    return first_match(
        [(value == "High", vip), ((volume == "High") | ((value == "Medium") & (volume == "Medium")), core)], casual
    )


def matrix_persona(matrix: dict[tuple[str, str], str], default: str | None = None) -> Column:
    """Label by (value, volume) cell; cells the matrix leaves out get the default."""
    value, volume = F.col("value_segment"), F.col("volume_segment")
    return first_match([((value == v) & (volume == q), label) for (v, q), label in matrix.items()], default)


def customer_segmentation(
    recent: DataFrame,
    value_cuts: tuple[float, float] = VALUE_CUTS,
    volume_cuts: tuple[int, int] = VOLUME_CUTS,
    persona: Column | None = None,
) -> DataFrame:
    """Both segments and the persona per known customer.

    Spend and volume come from one aggregate instead of two joined ones. Orders of unknown
    customers still take part in the percent rank as one group, and leave afterwards.
    """
    customers = recent.groupBy("customer_unique_id").agg(
        money_sum("total_price").alias("total_price_unique_cust"), F.count("order_id").alias("order_volume")
    )
    valued = _with_value_segment(customers, value_cuts).filter("customer_unique_id IS NOT NULL")
    segmented = valued.withColumn("volume_segment", tier("order_volume", volume_cuts))
    labelled = segmented.withColumn("customer_persona", base_persona() if persona is None else persona)
    return labelled.select(
        "customer_unique_id",
        "total_price_unique_cust",
        "spend_percentile",
        "spend_percentile_100",
        "value_segment",
        "order_volume",
        "volume_segment",
        "customer_persona",
    )


def payment_preference(raw_orders: DataFrame, payments: DataFrame, raw_customers: DataFrame) -> DataFrame:
    """Payment type with the largest total per customer over valid orders; equal totals go to the
    most recently used type.

    Payments are first combined per order and type, so the joins see few rows per order.
    """
    valid = raw_orders.select(
        as_text("order_id").alias("order_id"),
        as_text("customer_id").alias("customer_id"),
        as_instant("order_purchase_timestamp").alias("purchased"),
        clean_lower("order_status").alias("status"),
    ).filter(~F.coalesce(F.col("status").isin(*UNRECOGNISED_STATUSES), F.lit(False)))
    owned = enrich(valid, raw_customers, ["customer_id"], ["customer_unique_id"]).filter(
        "customer_unique_id IS NOT NULL"
    )
    per_order = payments.groupBy("order_id", "payment_type").agg(money_sum("payment_value").alias("paid"))
    per_type = (
        per_order.join(owned.select("order_id", "customer_unique_id", "purchased"), on="order_id", how="inner")
        .groupBy("customer_unique_id", "payment_type")
        .agg(money_sum("paid").alias("paid"), F.max("purchased").alias("last_used"))
    )
    return per_type.groupBy("customer_unique_id").agg(
        heaviest("payment_type", "paid", F.col("last_used")).alias("preferred_payment_type"),
        money_sum("paid").alias("total_paid"),
    )


def customer_activity(raw_customers: DataFrame, recent: DataFrame) -> DataFrame:
    """Every customer, tagged by whether they bought in the last twelve months."""
    active = recent.groupBy("customer_unique_id").agg(F.count("order_id").alias("order_volume"))
    everyone = raw_customers.select("customer_unique_id").filter("customer_unique_id IS NOT NULL").distinct()
    tagged = everyone.join(active, on="customer_unique_id", how="left")
    return tagged.select(
        "customer_unique_id",
        F.coalesce("order_volume", F.lit(0)).alias("order_volume"),
        F.when(F.col("order_volume").isNull(), "Inactive/Historical").otherwise("Active").alias("activity"),
    )


# --- listings -----------------------------------------------------------------------------------


def customer_id_multiplicity(raw_customers: DataFrame) -> DataFrame:
    return (
        raw_customers.groupBy("customer_unique_id")
        .agg(F.count("customer_id").alias("customer_ids"))
        .orderBy(F.desc("customer_ids"), "customer_unique_id")
    )


def volume_histogram(recent: DataFrame) -> DataFrame:
    """Customers per volume segment; orders of unknown customers form one entry."""
    return customer_volume(recent).groupBy("volume_segment").agg(F.count(F.lit(1)).alias("customers"))


def percentile_band(valued: DataFrame, low: float, high: float) -> DataFrame:
    band = valued.filter(F.col("spend_percentile").between(low, high))
    return band.orderBy(F.desc("spend_percentile"), "customer_unique_id")


def purchase_range(recent: DataFrame) -> DataFrame:
    """Newest and oldest purchase and number of customers in the window."""
    per_customer = recent.groupBy("customer_unique_id").agg(
        F.max("order_purchase_timestamp").alias("newest"), F.min("order_purchase_timestamp").alias("oldest")
    )
    return per_customer.agg(
        F.max("newest").alias("newest_purchase"),
        F.min("oldest").alias("oldest_purchase"),
        F.count(F.lit(1)).alias("customers"),
    )
