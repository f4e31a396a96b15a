"""Cleaned and conformed tables, one function per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions import (
    absent,
    as_instant,
    as_int,
    as_money,
    as_text,
    clean_lower,
    clean_upper,
    day,
    day_delta,
    first_match,
    flag,
    money_add,
    money_diff,
    money_sum,
    month_start,
)
from martloom.operators.lookup import enrich, translate
from martloom.operators.rollup import Labels
from martloom.plans.rules import PAYMENT_TYPES

# Order states that do not count as revenue, and the name of a missing category.
UNRECOGNISED_STATUSES = ("canceled", "unavailable")
UNKNOWN_CATEGORY = "unknown"

SIZE_COLUMNS = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
ORDER_INSTANTS = {
    "order_purchase_ts": "order_purchase_timestamp",
    "order_approved_ts": "order_approved_at",
    "order_delivered_carrier_ts": "order_delivered_carrier_date",
    "order_delivered_customer_ts": "order_delivered_customer_date",
    "order_estimated_delivery_ts": "order_estimated_delivery_date",
}


# --- payments -----------------------------------------------------------------------------------


def typed_payments(raw_payments: DataFrame) -> DataFrame:
    return raw_payments.select(
        as_text("order_id").alias("order_id"),
        as_int("payment_sequential").alias("payment_sequential"),
        clean_lower("payment_type").alias("payment_type"),
        as_int("payment_installments").alias("payment_installments"),
        as_money("payment_value").alias("payment_value"),
    )


def clean_payments(typed: DataFrame) -> DataFrame:
    """Payment rows with an order and a value that is not negative."""
    return typed.filter("order_id IS NOT NULL AND payment_value >= 0")


def payments_clean(raw_payments: DataFrame) -> DataFrame:
    return clean_payments(typed_payments(raw_payments))


def payments_per_order(payments: DataFrame, known_types: tuple[str, ...] = PAYMENT_TYPES) -> DataFrame:
    """One row per order. The primary type is that of the single largest payment; ties go to the
    lower sequence number, then the larger type name.

    Types on the list are kept in buffers of fixed size; orders with other types get those from a second, small
    aggregate over their rows, which adaptive execution drops when there are none.
    """
    types = Labels("payment_type", known_types)
    totals = payments.groupBy("order_id").agg(
        money_sum("payment_value").alias("total_payment_value"),
        F.count(F.lit(1)).alias("n_payments"),
        F.max("payment_installments").alias("installments_max"),
        types.bits().alias("_known"),
        F.max(types.packed("payment_value", "payment_sequential")).alias("_heaviest"),
    )
    others = types.others(payments, "order_id", "payment_value", "payment_sequential")
    labels = F.coalesce("other_labels", F.array().cast("array<string>"))
    return totals.join(others, on="order_id", how="left").select(
        "order_id",
        "total_payment_value",
        "n_payments",
        "installments_max",
        F.array_join(F.array_sort(F.concat(types.listed("_known"), labels)), ",").alias("payment_type_mix"),
        types.winner("_heaviest", F.col("other_winner")).alias("primary_payment_type"),
    )


# --- products and items -------------------------------------------------------------------------


def named_products(raw_products: DataFrame, raw_translation: DataFrame) -> DataFrame:
    """Products with an English category: translated, else as given, else `unknown`."""
    products = raw_products.select(
        as_text("product_id").alias("product_id"),
        "product_category_name",
        *[as_int(c).alias(c) for c in SIZE_COLUMNS],
    )
    return translate(
        products,
        raw_translation,
        term="product_category_name",
        source="product_category_name",
        target="product_category_name_english",
        output="product_category_en",
        default=UNKNOWN_CATEGORY,
    ).select("product_id", "product_category_name", *SIZE_COLUMNS, "product_category_en")


def product_catalog(raw_products: DataFrame, raw_translation: DataFrame) -> DataFrame:
    return named_products(raw_products, raw_translation).filter("product_id IS NOT NULL")


def typed_items(raw_items: DataFrame) -> DataFrame:
    return raw_items.select(
        as_text("order_id").alias("order_id"),
        as_int("order_item_id").alias("order_item_id"),
        as_text("product_id").alias("product_id"),
        as_text("seller_id").alias("seller_id"),
        as_money("price").alias("price"),
        as_money("freight_value").alias("freight_value"),
    )


def priced(items: DataFrame) -> DataFrame:
    """Typed items whose price and freight are known and not negative, with their sum."""
    kept = items.filter("price >= 0 AND freight_value >= 0")
    return kept.withColumn("item_total_revenue", money_add("price", "freight_value"))


def likely_priced(raw_items: DataFrame) -> DataFrame:
    """Raw items without most of those that `priced` leaves out. On the columns as they are, so it reaches the scan."""
    return raw_items.filter((F.col("price").try_cast("double") >= 0) & (F.col("freight_value").try_cast("double") >= 0))


def priced_items(raw_items: DataFrame) -> DataFrame:
    return priced(typed_items(likely_priced(raw_items)))


def categorised_items(raw_items: DataFrame, catalog: DataFrame, broadcast_below: int | None = None) -> DataFrame:
    """All typed items with the category of their product."""
    return enrich(typed_items(raw_items), catalog, ["product_id"], ["product_category_en"], broadcast_below)


def order_items_revenue(raw_items: DataFrame, catalog: DataFrame, broadcast_below: int | None = None) -> DataFrame:
    return priced_categories(categorised_items(likely_priced(raw_items), catalog, broadcast_below))


def priced_categories(categorised: DataFrame) -> DataFrame:
    """Priced items with their English category."""
    return priced(categorised).select(
        "product_id",
        "order_id",
        "order_item_id",
        "seller_id",
        "price",
        "freight_value",
        F.coalesce("product_category_en", F.lit(UNKNOWN_CATEGORY)).alias("product_category_en"),
        "item_total_revenue",
    )


def items_per_order(items: DataFrame) -> DataFrame:
    """One row per order. Works on priced items with or without a category; without one the product
    join is not needed."""
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        money_sum("price").alias("gross_revenue"),
        money_sum("freight_value").alias("freight_total"),
        money_sum("item_total_revenue").alias("revenue_total"),
    )


def category_per_order(items: DataFrame) -> DataFrame:
    """Item revenue per order and category: a large order shrinks to one row per category it holds."""
    return items.groupBy("order_id", "product_category_en").agg(
        money_sum("item_total_revenue").alias("item_total_revenue")
    )


def order_totals(raw_items: DataFrame) -> DataFrame:
    """Sum of price and freight per order over all items, unfiltered."""
    total = money_add(as_money("price"), as_money("freight_value"))
    return raw_items.groupBy(as_text("order_id").alias("order_id")).agg(money_sum(total).alias("total_price"))


# --- orders -------------------------------------------------------------------------------------


def standard_orders(raw_orders: DataFrame, instants: tuple[str, ...] = tuple(ORDER_INSTANTS)) -> DataFrame:
    """Typed orders with a normalized status and zone-free timestamps."""
    return raw_orders.select(
        as_text("order_id").alias("order_id"),
        as_text("customer_id").alias("customer_id"),
        clean_lower("order_status").alias("order_status"),
        *[as_instant(ORDER_INSTANTS[name]).alias(name) for name in instants],
    )


def with_purchase_calendar(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {
            "order_purchase_date": day("order_purchase_ts"),
            "order_purchase_month": month_start("order_purchase_ts"),
        }
    )


def _revenue_orders(raw_orders: DataFrame, customer_geo: DataFrame | None) -> DataFrame:
    """Orders with customer place. This join comes first: later ones are all on `order_id`, so the
    finished fact stays partitioned by it."""
    place = ("customer_unique_id", "customer_state", "customer_city_std")
    orders = standard_orders(raw_orders, ("order_purchase_ts",)).filter("order_id IS NOT NULL")
    if customer_geo is None:
        return orders.select("*", *absent(*place))
    return enrich(orders, customer_geo, ["customer_id"], list(place))


def _recognised_flag() -> Column:
    """Only canceled and unavailable orders do not count; an unknown status does."""
    void = F.coalesce(F.col("order_status").isin(*UNRECOGNISED_STATUSES), F.lit(False))
    return flag(~void)


def _with_revenue_measures(orders: DataFrame, revenue: str) -> DataFrame:
    paid = F.coalesce("total_payment_value", F.lit(0.0))
    return with_purchase_calendar(orders).withColumns(
        {
            "order_purchase_year": F.year("order_purchase_ts"),
            "payment_reconciliation_delta": money_diff(revenue, paid),
            "is_revenue_recognised": _recognised_flag(),
        }
    )


def order_months(raw_orders: DataFrame) -> DataFrame:
    """Order, purchase month and revenue flag: all that item-level marts need of the order fact."""
    orders = standard_orders(raw_orders, ("order_purchase_ts",)).filter("order_id IS NOT NULL")
    return with_purchase_calendar(orders).select(
        "order_id", "order_purchase_month", _recognised_flag().alias("is_revenue_recognised")
    )


def orders_revenue(
    raw_orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    customer_geo: DataFrame | None,
) -> DataFrame:
    """Order fact: one row per order that has items. Payments of unknown orders fall away because
    orders drive every join."""
    joined = (
        _revenue_orders(raw_orders, customer_geo)
        .join(items, on="order_id", how="inner")
        .join(payments, on="order_id", how="left")
    )
    return _with_revenue_measures(joined, "revenue_total")


def orders_revenue_item_grain(
    raw_orders: DataFrame, order_items: DataFrame, payments: DataFrame, customer_geo: DataFrame | None
) -> DataFrame:
    """The order fact at line-item grain, with the delta taken per item."""
    joined = (
        _revenue_orders(raw_orders, customer_geo)
        .join(order_items, on="order_id", how="inner")
        .join(payments, on="order_id", how="left")
    )
    return _with_revenue_measures(joined, "item_total_revenue")


# --- places -------------------------------------------------------------------------------------


def typed_geolocation(raw_geolocation: DataFrame) -> DataFrame:
    return raw_geolocation.select(
        as_int("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        clean_upper("geolocation_state").alias("geo_state"),
        clean_lower("geolocation_city").alias("geo_city"),
        F.col("geolocation_lat").try_cast("decimal(28,15)").alias("lat"),
        F.col("geolocation_lng").try_cast("decimal(28,15)").alias("lng"),
    )


def geo_zip_prefix(raw_geolocation: DataFrame) -> DataFrame:
    return zip_places(typed_geolocation(raw_geolocation))


def zip_places(typed: DataFrame) -> DataFrame:
    """One place per zip prefix and state; the city is the alphabetically first one."""

    def center(c: str):
        return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))

    return (
        typed.filter("zip_code_prefix IS NOT NULL")
        .groupBy("zip_code_prefix", "geo_state")
        .agg(center("lat").alias("avg_lat"), center("lng").alias("avg_lng"), F.min("geo_city").alias("geo_city"))
    )


def _placed(df: DataFrame, geo: DataFrame, prefix: str) -> DataFrame:
    """Coordinates for rows whose zip prefix and state both match."""
    spots = geo.select(
        F.col("zip_code_prefix").alias(f"{prefix}_zip_code_prefix"),
        F.col("geo_state").alias(f"{prefix}_state"),
        F.col("avg_lat").alias(f"{prefix}_lat"),
        F.col("avg_lng").alias(f"{prefix}_lng"),
    )
    joined = df.join(spots, on=[f"{prefix}_zip_code_prefix", f"{prefix}_state"], how="left")
    return joined.select(*df.columns, f"{prefix}_lat", f"{prefix}_lng")


def _place_columns(prefix: str) -> list:
    return [
        as_int(f"{prefix}_zip_code_prefix").alias(f"{prefix}_zip_code_prefix"),
        clean_lower(f"{prefix}_city").alias(f"{prefix}_city_std"),
        clean_upper(f"{prefix}_state").alias(f"{prefix}_state"),
    ]


def typed_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select("customer_id", "customer_unique_id", *_place_columns("customer"))


def typed_sellers(raw_sellers: DataFrame) -> DataFrame:
    return raw_sellers.select("seller_id", *_place_columns("seller"))


def customer_places(raw_customers: DataFrame) -> DataFrame:
    """Customers with cleaned places, before coordinates. Marts that need no coordinates stop here
    and skip the geolocation scan and join."""
    return typed_customers(raw_customers).filter("customer_id IS NOT NULL")


def seller_places(raw_sellers: DataFrame) -> DataFrame:
    return typed_sellers(raw_sellers).filter("seller_id IS NOT NULL")


def located(typed: DataFrame, geo: DataFrame, prefix: str) -> DataFrame:
    """Known customers or sellers with coordinates."""
    return _placed(typed.filter(f"{prefix}_id IS NOT NULL"), geo, prefix)


def customer_geo(raw_customers: DataFrame, geo: DataFrame) -> DataFrame:
    return located(typed_customers(raw_customers), geo, "customer")


def seller_geo(raw_sellers: DataFrame, geo: DataFrame) -> DataFrame:
    return located(typed_sellers(raw_sellers), geo, "seller")


# --- delivery -----------------------------------------------------------------------------------


def _delivery_bucket(late: tuple[tuple[int, int | None, str], ...]):
    delta = F.col("delivery_delta_days")
    bands = [
        ((delta >= low) & (delta <= high) if high else delta >= low, name) for low, high, name in late
    ]
    return first_match(
        [
            (F.col("order_status") != "delivered", "not_delivered"),
            (F.col("order_delivered_customer_ts").isNull(), "delivery_timestamp_missing"),
            (F.col("order_estimated_delivery_ts").isNull(), "estimated_timestamp_missing"),
            (delta < 0, "early"),
            (delta == 0, "on_time"),
            *bands,
        ]
    )


# Bands of days late.
LATE_BANDS = ((1, 3, "late_1_3_days"), (4, 7, "late_4_7_days"), (8, None, "late_8_plus_days"))


def delivery_orders(raw_orders: DataFrame, customers: DataFrame) -> DataFrame:
    return measured_deliveries(standard_orders(raw_orders), customers)


def measured_deliveries(standard: DataFrame, customers: DataFrame) -> DataFrame:
    """Order-level delivery fact over standard orders. Only delivered orders have a delta against the promised date."""
    orders = standard.filter("order_id IS NOT NULL")
    placed = enrich(orders, customers, ["customer_id"], [c for c in customers.columns if c != "customer_id"])
    delivered = F.col("order_status") == "delivered"
    arrived, promised = "order_delivered_customer_ts", "order_estimated_delivery_ts"
    late_by = F.col("delivery_delta_days")
    measured = placed.withColumns(
        {
            "is_delivered": flag(delivered),
            "has_actual_delivery_ts": flag(F.col(arrived).isNotNull()),
            "has_estimated_delivery_ts": flag(F.col(promised).isNotNull()),
            "delivery_delta_days": F.when(delivered, day_delta(arrived, promised)),
            "purchase_to_delivery_days": day_delta(arrived, "order_purchase_ts"),
            "carrier_to_customer_days": day_delta(arrived, "order_delivered_carrier_ts"),
            "estimated_lead_time_days": day_delta(promised, "order_purchase_ts"),
        }
    )
    graded = measured.withColumns(
        {
            "is_late": F.when(late_by.isNotNull(), flag(late_by > 0)),
            "delivery_status_bucket": _delivery_bucket(LATE_BANDS),
        }
    )
    return with_purchase_calendar(graded)


def order_seller_totals(raw_items: DataFrame) -> DataFrame:
    """One row per order and seller. A reader that needs no product count gets a plain aggregate:
    Catalyst drops the distinct count and its extra shuffle."""
    keys = [as_text("order_id").alias("order_id"), as_text("seller_id").alias("seller_id")]
    return raw_items.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("item_count"),
        F.count_distinct(as_text("product_id")).alias("distinct_product_count"),
        money_sum(as_money("price")).alias("order_seller_item_value"),
        money_sum(as_money("freight_value")).alias("order_seller_freight_value"),
        F.max(as_instant("shipping_limit_date")).alias("max_shipping_limit_ts"),
    )


def order_seller_rollup(raw_items: DataFrame, sellers: DataFrame) -> DataFrame:
    return known_order_sellers(order_seller_totals(raw_items), sellers)


def known_order_sellers(totals: DataFrame, sellers: DataFrame) -> DataFrame:
    """The known orders and sellers of `order_seller_totals`, with the seller's place."""
    rollup = totals.filter("order_id IS NOT NULL AND seller_id IS NOT NULL")
    return enrich(rollup, sellers, ["seller_id"], [c for c in sellers.columns if c != "seller_id"])


def delivery_order_items(deliveries: DataFrame, rollup: DataFrame) -> DataFrame:
    """Delivery fact per order and seller."""
    return rollup.join(deliveries.drop("customer_unique_id"), on="order_id", how="inner")
