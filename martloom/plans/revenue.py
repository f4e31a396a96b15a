"""Revenue marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.functions import exact_mean, money_sum, pct_change, ratio, snapshot
from martloom.operators.periods import with_period_change, with_rolling_sum
from martloom.operators.ranking import with_dense_rank, with_share
from martloom.operators.rollup import heaviest

MONTH = "order_purchase_month"


def recognised(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("is_revenue_recognised") == 1)


def revenue_monthly(orders: DataFrame) -> DataFrame:
    """Orders, revenue and growth per month. Orders have one row each, so a count is a distinct count."""
    monthly = (
        recognised(orders)
        .filter(F.col(MONTH).isNotNull())
        .groupBy(MONTH)
        .agg(F.count("order_id").alias("total_orders"), money_sum("revenue_total").alias("total_revenue"))
        .withColumn("aov", ratio("total_revenue", "total_orders"))
    )
    monthly = with_period_change(monthly, MONTH, "total_revenue", {"revenue_mom_pct": 1, "revenue_yoy_pct": 12})
    return with_rolling_sum(monthly, MONTH, "total_revenue", {"revenue_rolling_3m": 3, "revenue_rolling_6m": 6})


def category_month_totals(months: DataFrame, category_orders: DataFrame) -> DataFrame:
    """Totals per month and category from items already rolled up per order and category, so that
    each input row is one order of that category. `months` is the order fact or `order_months`: an
    order without items has nothing to join, so both give the same result."""
    dated = recognised(months).select("order_id", MONTH)
    return (
        category_orders.join(dated, on="order_id", how="inner")
        .groupBy(MONTH, "product_category_en")
        .agg(F.count("order_id").alias("total_orders"), money_sum("item_total_revenue").alias("total_revenue"))
    )


def revenue_by_category_month(months: DataFrame, category_orders: DataFrame) -> DataFrame:
    totals = category_month_totals(months, category_orders)
    shared = with_share(totals, MONTH, "total_revenue", "revenue_share_of_month")
    return with_dense_rank(shared, MONTH, "total_revenue", "category_rank_in_month")


def revenue_by_state_month(orders: DataFrame) -> DataFrame:
    """Totals per month and state. Grouping by customer first turns the distinct count into a count."""
    per_customer = (
        recognised(orders)
        .filter(F.col("customer_state").isNotNull())
        .groupBy(MONTH, "customer_state", "customer_unique_id")
        .agg(F.count("order_id").alias("_orders"), money_sum("revenue_total").alias("_revenue"))
    )
    totals = (
        per_customer.groupBy(MONTH, "customer_state")
        .agg(
            F.sum("_orders").alias("total_orders"),
            F.count("customer_unique_id").alias("total_customers"),
            money_sum("_revenue").alias("total_revenue"),
        )
        .withColumn("aov", ratio("total_revenue", "total_orders"))
    )
    shared = with_share(totals, MONTH, "total_revenue", "revenue_share_of_month")
    return with_dense_rank(shared, MONTH, "total_revenue", "state_rank_in_month")


def revenue_by_payment_type_month(orders: DataFrame) -> DataFrame:
    totals = (
        recognised(orders)
        .filter(F.col("primary_payment_type").isNotNull())
        .groupBy(MONTH, "primary_payment_type")
        .agg(
            F.count("order_id").alias("total_orders"),
            money_sum("revenue_total").alias("total_revenue"),
            F.avg("installments_max").alias("avg_installments"),
        )
    )
    return with_share(totals, MONTH, "total_revenue", "share_of_month_revenue")


def _daily(orders: DataFrame) -> DataFrame:
    """Recognised revenue per day, state and payment type: everything the summary needs from the
    order fact in one pass, in a few rows per day."""
    return (
        recognised(orders)
        .groupBy("order_purchase_date", "customer_state", "primary_payment_type")
        .agg(F.count("order_id").alias("orders"), money_sum("revenue_total").alias("revenue"))
    )


def _figures(daily: DataFrame, categories: DataFrame) -> DataFrame:
    """One row of totals, periods and top labels.

    The small daily table is regrouped by day, by state and by payment type at once, and stacked on
    the category totals: one plan, whose branches run side by side. Day rows give the totals, with
    the last 365 days and the 365 before them measured from the newest day.
    """
    axes = ["order_purchase_date", "customer_state", "primary_payment_type"]
    by_axis = daily.groupingSets([[a] for a in axes], *axes).agg(
        (F.grouping(axes[0]) == 0).alias("is_day"),
        F.sum("orders").alias("orders"),
        money_sum("revenue").alias("revenue"),
    )
    by_category = categories.groupBy("product_category_en").agg(money_sum("total_revenue").alias("revenue"))
    stacked = by_axis.unionByName(by_category, allowMissingColumns=True)
    newest = F.max("order_purchase_date").over(Window.partitionBy())
    dated = stacked.withColumn("age", F.datediff(newest, F.col("order_purchase_date")))
    is_day = F.col("is_day")

    def within(low: int, high: int) -> Column:
        inside = is_day & (F.col("age") >= low) & (F.col("age") < high)
        return F.coalesce(money_sum(F.when(inside, F.col("revenue"))), F.lit(0.0))

    def top(axis: str) -> Column:
        return F.max_by(axis, F.when(F.col(axis).isNotNull(), F.struct("revenue", axis))).alias(f"top_{axis}")

    return dated.agg(
        F.coalesce(F.sum(F.when(is_day, F.col("orders"))), F.lit(0)).alias("total_orders"),
        money_sum(F.when(is_day, F.col("revenue"))).alias("total_revenue"),
        within(0, 365).alias("last_12m_revenue"),
        within(365, 730).alias("prior_12m_revenue"),
        *[top(axis) for axis in ("product_category_en", *axes[1:])],
    )


def revenue_exec_summary(
    orders: DataFrame, months: DataFrame, category_orders: DataFrame, as_of: str | None = None
) -> DataFrame:
    return summary_of_categories(orders, category_month_totals(months, category_orders), as_of)


def summary_of_categories(orders: DataFrame, categories: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row of headline figures, also on empty input. `categories` are `category_month_totals` or the mart made of
    them. `as_of` replaces the current time."""
    return _figures(_daily(orders), categories).select(
        "total_orders",
        "total_revenue",
        "last_12m_revenue",
        "prior_12m_revenue",
        ratio("total_revenue", "total_orders").alias("aov"),
        pct_change("last_12m_revenue", "prior_12m_revenue").alias("yoy_growth_pct"),
        F.col("top_product_category_en").alias("top_category"),
        "top_customer_state",
        F.col("top_primary_payment_type").alias("top_payment_type"),
        snapshot(as_of).alias("kpi_generated_ts"),
    )


def peak_month(monthly: DataFrame) -> DataFrame:
    """The month with the largest revenue; the later one when equal."""
    return monthly.agg(
        heaviest(MONTH, "total_revenue").alias("peak_month"), F.max("total_revenue").alias("peak_month_revenue")
    )


# --- listings -----------------------------------------------------------------------------------


def top_categories(by_category: DataFrame, k: int = 10) -> DataFrame:
    """Largest categories. An order counts once for each category and month it appears in."""
    return (
        by_category.groupBy("product_category_en")
        .agg(
            money_sum("total_revenue").alias("total_revenue"),
            F.sum("total_orders").alias("order_category_pairs"),
        )
        .orderBy(F.desc("total_revenue"), "product_category_en")
        .limit(k)
    )


def state_totals(by_state: DataFrame) -> DataFrame:
    return (
        by_state.groupBy("customer_state")
        .agg(
            money_sum("total_revenue").alias("total_revenue"),
            F.sum("total_orders").alias("total_orders"),
            exact_mean("aov").alias("avg_aov"),
        )
        .orderBy(F.desc("total_revenue"), "customer_state")
    )


def payment_totals(by_payment: DataFrame) -> DataFrame:
    return (
        by_payment.groupBy("primary_payment_type")
        .agg(
            money_sum("total_revenue").alias("total_revenue"),
            F.sum("total_orders").alias("total_orders"),
            exact_mean("avg_installments").alias("avg_installments"),
            exact_mean("share_of_month_revenue", 100).alias("avg_share_of_month_pct"),
        )
        .orderBy(F.desc("total_revenue"), "primary_payment_type")
    )


def monthly_listing(monthly: DataFrame) -> DataFrame:
    money = ("total_revenue", "aov", "revenue_mom_pct", "revenue_yoy_pct", "revenue_rolling_3m", "revenue_rolling_6m")
    return monthly.select(MONTH, "total_orders", *[F.round(c, 2).alias(c) for c in money]).orderBy(MONTH)
