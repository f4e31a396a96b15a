"""The tables as one lazily composed model."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Observation

from martloom.operators.quality import as_drop_rules, enforce, observe
from martloom.operators.sampling import sample_by_key
from martloom.plans import conform, revenue
from martloom.plans.rules import RULES
from martloom.plans.stages import STAGES
from martloom.sources.schemas import RAW_RULES
from martloom.sources.star import RawTables


def _table(name: str) -> cached_property:
    return cached_property(lambda model: model.build(name))


class RetailModel:
    """Each property is a DataFrame over the source tables; nothing runs until one is read.

    `landed` are the source tables as delivered, `raw` what their own rules let through. Drop and fail rules of the
    conformed tables are part of the frames (`martloom.plans.stages`). A property builds its plan once, so marts that share
    an upstream table share its plan, and Spark reuses the shuffles inside one query. To share work
    between queries, publish the tables (`martloom.plans.publish`). `as_of` replaces the time that summaries carry.
    """

    def __init__(self, landed: RawTables, as_of: str | None = None):
        self.landed, self.as_of = landed, as_of
        self.raw = landed.mapped(lambda name, df: enforce(df, as_drop_rules(RAW_RULES.get(name, {}))))

    def sampled(self, fraction: float) -> RetailModel:
        """The model over a fraction of the orders, with their items and payments."""
        names = ("raw_orders", "raw_order_items", "raw_order_payments")
        picked = {name: sample_by_key(self.landed[name], "order_id", fraction) for name in names}
        return RetailModel(self.landed.replacing(**picked), self.as_of)

    def build(self, name: str, watch: Observation | None = None) -> DataFrame:
        """A table of `STAGES`. With `watch`, reading it counts its input rows and their rule violations."""
        stage, rules = STAGES[name], RULES.get(name, ())
        if watch is not None:
            rows = observe(stage.rows(self), rules, watch)
        else:
            rows = (stage.lean or stage.rows)(self)
        return enforce(stage.finish(self, rows), rules)

    # conformed tables

    payments_clean = _table("payments_clean")
    payments_order_agg = _table("payments_order_agg")
    product_catalog = _table("product_catalog")
    order_items_revenue = _table("order_items_revenue")
    orders_revenue = _table("orders_revenue")
    geo_zip_prefix = _table("geo_zip_prefix")
    customer_geo = _table("customer_geo")
    seller_geo = _table("seller_geo")
    delivery_order = _table("delivery_order")
    order_seller_rollup = _table("order_seller_rollup")
    delivery_order_item = _table("delivery_order_item")
    order_totals = _table("order_totals")
    last_12m_orders = _table("last_12m_orders")
    customer_value_segment = _table("customer_value_segment")
    customer_volume_segment = _table("customer_volume_segment")

    # marts

    revenue_monthly = _table("revenue_monthly")
    revenue_by_category_month = _table("revenue_by_category_month")
    revenue_by_state_month = _table("revenue_by_state_month")
    revenue_by_payment_type_month = _table("revenue_by_payment_type_month")
    revenue_exec_summary = _table("revenue_exec_summary")
    delivery_state_month = _table("delivery_state_month")
    delivery_seller_state_month = _table("delivery_seller_state_month")
    delivery_corridor_month = _table("delivery_corridor_month")
    delivery_hotspots = _table("delivery_hotspots")
    delivery_exec_summary = _table("delivery_exec_summary")
    customer_segmentation = _table("customer_segmentation")

    # narrow forms inside plans, of no interest to readers

    @cached_property
    def priced_items(self) -> DataFrame:
        return conform.priced_items(self.raw.raw_order_items)

    @cached_property
    def items_per_order(self) -> DataFrame:
        return conform.items_per_order(self.priced_items)

    @cached_property
    def category_per_order(self) -> DataFrame:
        return conform.category_per_order(self.order_items_revenue)

    @cached_property
    def customer_places(self) -> DataFrame:
        return conform.customer_places(self.raw.raw_customers)

    @cached_property
    def order_fact(self) -> DataFrame:
        """The order fact without customer places, for marts that do not group by them."""
        return conform.orders_revenue(self.raw.raw_orders, self.items_per_order, self.payments_order_agg, None)

    @cached_property
    def order_months(self) -> DataFrame:
        return conform.order_months(self.raw.raw_orders)

    @cached_property
    def category_months(self) -> DataFrame:
        return revenue.category_month_totals(self.order_months, self.category_per_order)

    @cached_property
    def known_totals(self) -> DataFrame | None:
        """Totals of all orders where they are stored; nothing to read otherwise."""
        return None

    @cached_property
    def orders_revenue_item_grain(self) -> DataFrame:
        return conform.orders_revenue_item_grain(
            self.raw.raw_orders, self.order_items_revenue, self.payments_order_agg, self.customer_places
        )

    @cached_property
    def delivery_order_places(self) -> DataFrame:
        """The delivery fact without coordinates, which no mart reads."""
        return conform.delivery_orders(self.raw.raw_orders, self.customer_places)

    @cached_property
    def delivery_order_item_places(self) -> DataFrame:
        rollup = conform.order_seller_rollup(self.raw.raw_order_items, conform.seller_places(self.raw.raw_sellers))
        return conform.delivery_order_items(self.delivery_order_places, rollup)

    @cached_property
    def known_recent_orders(self) -> DataFrame:
        """The last twelve months, where an order of an unknown customer stops the job."""
        return enforce(self.last_12m_orders, RULES["customer_volume_segment"])
