"""How each table comes about: its rows before any cleaning, and what makes the table of them.

The model, the rule report and the publisher all start from the same rows. So violations are counted on what arrived,
not on what cleaning has left, and the counts are the same in all three places.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

from martloom.plans import conform, delivery, revenue, segments

if TYPE_CHECKING:
    from martloom.plans.model import RetailModel


@dataclass(frozen=True)
class Stage:
    """`rows` gives the table's input with everything the rules look at; `finish` cleans and completes it.

    `lean` may give the same input without rows that `finish` drops anyway, in a form that reaches
    the scan; it serves where nobody counts.
    """

    rows: Callable[[RetailModel], DataFrame]
    finish: Callable[[RetailModel, DataFrame], DataFrame] = lambda m, df: df
    lean: Callable[[RetailModel], DataFrame] | None = None


def _recent(m: RetailModel, delivered: DataFrame) -> DataFrame:
    return segments.recent_orders(delivered, m.raw.raw_order_items, m.raw.raw_customers, m.known_totals)


STAGES: dict[str, Stage] = {
    # conformed tables
    "payments_clean": Stage(
        lambda m: conform.typed_payments(m.raw.raw_order_payments), lambda m, df: conform.clean_payments(df)
    ),
    "payments_order_agg": Stage(lambda m: conform.payments_per_order(m.payments_clean)),
    "product_catalog": Stage(
        lambda m: conform.named_products(m.raw.raw_products, m.raw.raw_product_names_translation),
        lambda m, df: df.filter("product_id IS NOT NULL"),
    ),
    "order_items_revenue": Stage(
        lambda m: conform.categorised_items(m.raw.raw_order_items, m.product_catalog),
        lambda m, df: conform.priced_categories(df),
        lambda m: conform.categorised_items(conform.likely_priced(m.raw.raw_order_items), m.product_catalog),
    ),
    "orders_revenue": Stage(
        lambda m: conform.orders_revenue(
            m.raw.raw_orders, m.items_per_order, m.payments_order_agg, m.customer_places
        )
    ),
    "geo_zip_prefix": Stage(
        lambda m: conform.typed_geolocation(m.raw.raw_geolocation), lambda m, df: conform.zip_places(df)
    ),
    "customer_geo": Stage(
        lambda m: conform.typed_customers(m.raw.raw_customers), lambda m, df: conform.located(df, m.geo_zip_prefix, "customer")
    ),
    "seller_geo": Stage(
        lambda m: conform.typed_sellers(m.raw.raw_sellers), lambda m, df: conform.located(df, m.geo_zip_prefix, "seller")
    ),
    "delivery_order": Stage(
        lambda m: conform.standard_orders(m.raw.raw_orders), lambda m, df: conform.measured_deliveries(df, m.customer_geo)
    ),
    "order_seller_rollup": Stage(
        lambda m: conform.order_seller_totals(m.raw.raw_order_items),
        lambda m, df: conform.known_order_sellers(df, m.seller_geo),
    ),
    "delivery_order_item": Stage(lambda m: conform.delivery_order_items(m.delivery_order, m.order_seller_rollup)),
    "order_totals": Stage(lambda m: conform.order_totals(m.raw.raw_order_items)),
    "last_12m_orders": Stage(lambda m: segments.delivered_orders(m.raw.raw_orders), _recent),
    "customer_value_segment": Stage(lambda m: segments.customer_value(m.last_12m_orders)),
    "customer_volume_segment": Stage(lambda m: segments.customer_volume(m.last_12m_orders)),
    # marts
    "revenue_monthly": Stage(lambda m: revenue.revenue_monthly(m.order_fact)),
    "revenue_by_category_month": Stage(
        lambda m: revenue.revenue_by_category_month(m.order_months, m.category_per_order)
    ),
    "revenue_by_state_month": Stage(lambda m: revenue.revenue_by_state_month(m.orders_revenue)),
    "revenue_by_payment_type_month": Stage(lambda m: revenue.revenue_by_payment_type_month(m.order_fact)),
    "revenue_exec_summary": Stage(
        lambda m: revenue.summary_of_categories(m.orders_revenue, m.category_months, m.as_of)
    ),
    "delivery_state_month": Stage(lambda m: delivery.delivery_state_month(m.delivery_order_places)),
    "delivery_seller_state_month": Stage(
        lambda m: delivery.delivery_seller_state_month(m.delivery_order_item_places)
    ),
    "delivery_corridor_month": Stage(lambda m: delivery.delivery_corridor_month(m.delivery_order_item_places)),
    "delivery_hotspots": Stage(lambda m: delivery.delivery_hotspots(m.delivery_order_places)),
    "delivery_exec_summary": Stage(lambda m: delivery.delivery_exec_summary(m.delivery_order_places, m.as_of)),
    "customer_segmentation": Stage(lambda m: segments.customer_segmentation(m.known_recent_orders)),
}
