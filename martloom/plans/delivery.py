"""Delivery marts, built on per-group histograms of the delay in days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.functions import snapshot
from martloom.operators.ranking import with_dense_rank
from martloom.operators.spread import (
    histogram,
    mean_amount,
    mean_count,
    mean_value,
    median,
    rate,
    rows_total,
    tallies,
    with_median_marker,
)

MONTH, DELTA = "order_purchase_month", "delivery_delta_days"
SEVERE_AFTER_DAYS = 7
DURATIONS = {
    "avg_purchase_to_delivery_days": "purchase_to_delivery_days",
    "avg_carrier_to_customer_days": "carrier_to_customer_days",
    "avg_estimated_lead_time_days": "estimated_lead_time_days",
}


def _measured(deliveries: DataFrame, *known: str) -> DataFrame:
    """Rows with a delay and with every named group column."""
    for c in (DELTA, *known):
        deliveries = deliveries.filter(F.col(c).isNotNull())
    return deliveries


def _delay() -> list[Column]:
    return [mean_value(DELTA).alias("avg_delivery_delta_days"), median().alias("median_delivery_delta_days")]


def _lateness() -> list[Column]:
    delta = F.col(DELTA)
    return [
        rate(delta > 0).alias("late_delivery_rate"),
        rate(delta > SEVERE_AFTER_DAYS).alias("severe_delay_rate"),
    ]


def _punctuality() -> list[Column]:
    delta = F.col(DELTA)
    return [rate(delta <= 0).alias("on_time_or_early_rate"), rate(delta < 0).alias("early_delivery_rate")]


def _summarize(hist: DataFrame, keys: list[str], *measures: Column) -> DataFrame:
    return with_median_marker(hist, keys, DELTA).groupBy(*keys).agg(*measures)


def _order_measures() -> list[Column]:
    return [
        rows_total().alias("total_delivered_orders"),
        *_delay(),
        *[mean_count(column).alias(name) for name, column in DURATIONS.items()],
        *_lateness(),
        *_punctuality(),
    ]


def delivery_state_month(deliveries: DataFrame) -> DataFrame:
    keys = [MONTH, "customer_state"]
    hist = histogram(_measured(deliveries, "customer_state"), keys, DELTA, list(DURATIONS.values()))
    summary = _summarize(hist, keys, *_order_measures())
    return with_dense_rank(summary, MONTH, "avg_delivery_delta_days", "state_delay_rank_in_month")


def delivery_hotspots(deliveries: DataFrame) -> DataFrame:
    keys = ["customer_state"]
    hist = histogram(_measured(deliveries, "customer_state"), keys, DELTA)
    summary = _summarize(
        hist, keys, rows_total().alias("total_delivered_orders"), *_delay(), *_lateness()
    )
    return with_dense_rank(summary, None, "avg_delivery_delta_days", "hotspot_rank")


def delivery_exec_summary(deliveries: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row of delivery figures, also on empty input."""
    hist = histogram(_measured(deliveries), [], DELTA, list(DURATIONS.values()))
    return _summarize(hist, [], *_order_measures()).withColumn("kpi_generated_ts", snapshot(as_of))


def _seller_side(
    order_items: DataFrame, keys: list[str], counts: list[str], amounts: list[str], *measures: Column
) -> DataFrame:
    """Marts at order and seller grain.

    Orders are counted in two levels: rows shrink to one per order and group first, where they lie (they arrive
    partitioned by order, so nothing moves), then to the delay histogram. Sellers are counted in two levels as
    well. Both start at the same joined rows and read the same columns of them, so Spark reuses the shuffles of
    items and orders below. No step sorts or marks rows within an order.
    """
    base = _measured(order_items, *[k for k in keys if k != MONTH])
    per_order = base.groupBy("order_id", *keys, DELTA).agg(*tallies(counts, amounts))
    sums = [c for c in per_order.columns if c.startswith(("_n", "_sum", "_cnt"))]
    hist = per_order.groupBy(*keys, DELTA).agg(F.count(F.lit(1)).alias("_orders"), *[F.sum(c).alias(c) for c in sums])
    per_seller = base.groupBy(*keys, "seller_id").agg(*tallies(counts, amounts), F.max(DELTA).alias("_delta"))
    seen = F.col("_delta").isNotNull()  # always true; with the counts below it keeps all columns in the shuffle
    for c in sums:
        if c.startswith("_cnt"):
            seen = seen & (F.col(c) >= 0)
    sellers = per_seller.groupBy(*keys).agg(F.count(F.when(seen, F.col("seller_id"))).alias("_sellers"))
    return _summarize(
        hist.unionByName(sellers, allowMissingColumns=True),
        keys,
        F.sum("_orders").alias("total_orders"),
        F.sum("_sellers").alias("active_sellers"),
        *measures,
    )


def delivery_seller_state_month(order_items: DataFrame) -> DataFrame:
    value, freight = "order_seller_item_value", "order_seller_freight_value"
    summary = _seller_side(
        order_items,
        [MONTH, "seller_state"],
        [],
        [value, freight],
        *_delay(),
        mean_amount(value).alias("avg_order_seller_item_value"),
        mean_amount(freight).alias("avg_order_seller_freight_value"),
        *_lateness(),
    )
    return with_dense_rank(summary, MONTH, "avg_delivery_delta_days", "seller_state_delay_rank_in_month")


def delivery_corridor_month(order_items: DataFrame) -> DataFrame:
    duration, freight = "purchase_to_delivery_days", "order_seller_freight_value"
    summary = _seller_side(
        order_items,
        [MONTH, "seller_state", "customer_state"],
        [duration],
        [freight],
        *_delay(),
        mean_count(duration).alias("avg_purchase_to_delivery_days"),
        mean_amount(freight).alias("avg_freight_value"),
        *_lateness(),
    )
    return with_dense_rank(summary, MONTH, "avg_delivery_delta_days", "corridor_delay_rank_in_month")


# --- listings -----------------------------------------------------------------------------------


def bucket_counts(deliveries: DataFrame) -> DataFrame:
    return (
        deliveries.groupBy("delivery_status_bucket")
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy(F.desc("orders"), "delivery_status_bucket")
    )


def delta_range(deliveries: DataFrame) -> DataFrame:
    return _measured(deliveries).agg(
        F.min(DELTA).alias("min_delta"), F.max(DELTA).alias("max_delta"), F.avg(DELTA).alias("avg_delta")
    )


def delivery_profile(deliveries: DataFrame) -> DataFrame:
    """Orders, mean delay and late rate by customer state, unknown state included."""
    hist = histogram(_measured(deliveries), ["customer_state"], DELTA)
    return (
        hist.groupBy("customer_state")
        .agg(
            rows_total().alias("orders"),
            mean_value(DELTA).alias("avg_delta_days"),
            rate(F.col(DELTA) > 0).alias("late_rate"),
        )
        .orderBy(F.desc("avg_delta_days"), "customer_state")
    )


def worst_hotspots(hotspots: DataFrame, k: int = 10) -> DataFrame:
    return hotspots.orderBy("hotspot_rank", "customer_state").limit(k)


def worst_states(by_state: DataFrame, k: int = 20) -> DataFrame:
    order = (F.desc_nulls_last(MONTH), "state_delay_rank_in_month", "customer_state")
    return by_state.orderBy(*order).limit(k)


def worst_corridors(corridors: DataFrame, k: int = 20) -> DataFrame:
    order = (F.desc_nulls_last(MONTH), "corridor_delay_rank_in_month", "seller_state", "customer_state")
    return corridors.orderBy(*order).limit(k)
