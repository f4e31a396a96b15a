"""Validation queries over source tables and marts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.functions import money_sum, ratio
from martloom.operators.lookup import grain, orphans, share_of
from martloom.plans.conform import UNKNOWN_CATEGORY
from martloom.plans.rules import RECONCILIATION_TOLERANCE


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _stack(
        [
            df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
            for name, df in tables.items()
        ]
    )


def _counted_by_footer(spark: SparkSession, folder: str) -> DataFrame:
    """A folder table read through the connector that can push a count down to Parquet footers."""
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set(key, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        return spark.read.parquet(folder)
    finally:
        spark.conf.set(key, before)


def footer_counts(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """Row counts of stored tables by name. Only file footers are read, however large the tables are.

    Needs `spark.sql.parquet.aggregatePushdown`, which sessions of this library set.
    """
    return row_counts({name: _counted_by_footer(spark, folder) for name, folder in folders.items()})


def row_count_audit(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected against actual counts. Both frames hold one row per table; a table that is missing on
    either side fails."""
    joined = expected.select("table_name", F.col("row_count").alias("expected_count")).join(
        counts.select("table_name", F.col("row_count").alias("actual_count")), on="table_name", how="full"
    )
    difference = F.col("actual_count") - F.col("expected_count")
    return joined.withColumns(
        {"difference": difference, "status": F.when(difference == 0, "PASS").otherwise("FAIL")}
    )


def payment_profile(raw_payments: DataFrame) -> DataFrame:
    value = F.col("payment_value")
    return raw_payments.agg(
        F.count_if(value < 0).alias("negative_payments"),
        F.count_if(value.isNull()).alias("null_payments"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


def ghost_payments(raw_payments: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """Payments of unknown orders. Counted per order id before the anti join, so the join sees each
    id once."""
    per_order = raw_payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return orphans(per_order, raw_orders, "order_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("ghost_payment_rows")
    )


def grain_check(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    return _stack([grain(df, keys, name) for name, (df, keys) in tables.items()])


def payment_mix(payments_per_order: DataFrame) -> DataFrame:
    return (
        payments_per_order.groupBy("primary_payment_type")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            money_sum("total_payment_value").alias("total_value"),
        )
        .orderBy(F.desc("orders"), "primary_payment_type")
    )


def reconciliation_summary(orders: DataFrame) -> DataFrame:
    """Coverage of the order fact and how closely payments match revenue."""
    gap = F.abs("payment_reconciliation_delta")
    near = gap / F.greatest(F.col("revenue_total"), F.lit(1.0))
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("is_revenue_recognised").alias("recognised_orders"),
        money_sum("revenue_total").alias("revenue_total"),
        money_sum("total_payment_value").alias("payments_total"),
        F.round(ratio(money_sum(gap), F.count(gap)), 2).alias("avg_abs_recon_delta"),
        F.round(share_of(near < RECONCILIATION_TOLERANCE) * 100, 2).alias("pct_reconciled_within_5pct"),
    )


def unknown_category_rate(order_items: DataFrame) -> DataFrame:
    unknown = F.count_if(F.col("product_category_en") == UNKNOWN_CATEGORY)
    return order_items.agg(
        unknown.alias("unknown_items"),
        F.count(F.lit(1)).alias("total_items"),
        F.round(ratio(unknown * 100, F.count(F.lit(1))), 2).alias("unknown_pct"),
    )


def _months_off(mart: DataFrame, share: str) -> DataFrame:
    months = mart.groupBy("order_purchase_month").agg(F.round(F.sum(share), 2).alias("share_sum"))
    return months.agg(
        F.count(F.lit(1)).alias("months"),
        F.count_if(F.col("share_sum") != 1.0).alias("months_off"),
    )


def share_sum_check(marts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Months whose shares do not add up to one, per mart."""
    return _stack(
        [_months_off(df, share).withColumn("mart", F.lit(name)) for name, (df, share) in marts.items()]
    )


def _scalar_check(name: str, frame: DataFrame, value: str, test: str, bound: float) -> DataFrame:
    got = F.col(value).cast("double")
    ok: Column = got == bound if test == "==" else got < bound
    return frame.select(
        F.lit(name).alias("check_name"),
        F.lit(test).alias("test"),
        F.lit(float(bound)).alias("expected"),
        got.alias("actual"),
        F.when(ok, "PASS").otherwise("FAIL").alias("status"),
    )


def invariants(
    payments: DataFrame,
    payments_per_order: DataFrame,
    orders: DataFrame,
    raw_orders: DataFrame,
    order_items: DataFrame,
    by_category: DataFrame,
    by_state: DataFrame,
    by_payment: DataFrame,
    exec_summary: DataFrame,
) -> DataFrame:
    """One row per invariant of the revenue tables, with its value and verdict."""
    ghosts = orphans(orders.select("order_id"), raw_orders, "order_id").agg(F.count(F.lit(1)).alias("n"))
    spare = grain(payments_per_order, ["order_id"], "payments_order_agg")
    return _stack(
        [
            _scalar_check(
                "no_negative_payments", payments.agg(F.count_if(F.col("payment_value") < 0).alias("n")), "n", "==", 0
            ),
            _scalar_check(
                "payments_rollup_is_order_grain",
                spare.select((F.col("row_count") - F.col("unique_keys")).alias("n")),
                "n",
                "==",
                0,
            ),
            _scalar_check("no_ghost_orders_in_fact", ghosts, "n", "==", 0),
            _scalar_check(
                "unknown_category_under_5pct", unknown_category_rate(order_items), "unknown_pct", "<", 5.0
            ),
            *[
                _scalar_check(f"{name}_share_sums_to_one", _months_off(df, share), "months_off", "==", 0)
                for name, df, share in (
                    ("category", by_category, "revenue_share_of_month"),
                    ("state", by_state, "revenue_share_of_month"),
                    ("payment_type", by_payment, "share_of_month_revenue"),
                )
            ],
            _scalar_check(
                "exec_summary_is_single_row", exec_summary.agg(F.count(F.lit(1)).alias("n")), "n", "==", 1
            ),
        ]
    )


def require_pass(report: DataFrame) -> DataFrame:
    """The report itself; reading it fails when any check failed."""
    failed = F.concat(F.lit("invariant failed: "), F.col("check_name"))
    return report.filter(F.when(F.col("status") == "PASS", F.lit(True)).otherwise(F.raise_error(failed).cast("boolean")))


def null_state_orders(orders: DataFrame) -> DataFrame:
    return orders.filter("customer_state IS NULL")
