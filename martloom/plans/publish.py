"""Write the model's tables, conformed ones first, and build the marts from the stored copies.

A table replaces its last version when it is complete; a rule that stops the job leaves the last version.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from martloom.functions import published
from martloom.plans import audits
from martloom.plans.model import RetailModel
from martloom.sources.ingest import complete, save_table, stored, write_table
from martloom.sources.store import Audit, open_folder, swap_folders

CONFORMED = (
    "payments_clean",
    "payments_order_agg",
    "product_catalog",
    "order_items_revenue",
    "geo_zip_prefix",
    "customer_geo",
    "seller_geo",
    "orders_revenue",
    "delivery_order",
    "order_seller_rollup",
    "delivery_order_item",
    "order_totals",
    "last_12m_orders",
    "customer_value_segment",
    "customer_volume_segment",
)
MARTS = (
    "revenue_monthly",
    "revenue_by_category_month",
    "revenue_by_state_month",
    "revenue_by_payment_type_month",
    "revenue_exec_summary",
    "delivery_state_month",
    "delivery_seller_state_month",
    "delivery_corridor_month",
    "delivery_hotspots",
    "delivery_exec_summary",
    "customer_segmentation",
)
# Narrow forms the marts use inside one plan, and the stored table that serves in their place.
SERVED_BY = {
    "order_fact": "orders_revenue",
    "order_months": "orders_revenue",
    "customer_places": "customer_geo",
    "delivery_order_places": "delivery_order",
    "delivery_order_item_places": "delivery_order_item",
    "known_totals": "order_totals",
    "category_months": "revenue_by_category_month",
}


# Tables that meet each other on the order; bucketed alike they join without a shuffle.
BY_ORDER = (
    "payments_order_agg",
    "order_items_revenue",
    "orders_revenue",
    "delivery_order",
    "order_seller_rollup",
    "delivery_order_item",
    "order_totals",
)


@dataclass
class TableReport:
    """Rows that arrived, rows written, and violations of each rule among those that arrived."""

    table: str
    rows_seen: int
    rows: int
    violations: dict[str, int]


def _publish(
    model: RetailModel,
    tables: tuple[str, ...],
    write: Callable[[DataFrame, str, tuple[Audit, ...]], None],
    read: Callable[[DataFrame, str], DataFrame],
) -> list[TableReport]:
    """One job a table: it is written, and its input rows, violations and output rows are counted on the way."""
    reports = []
    for name in tables:
        watch, written = Observation(), Observation()
        frame = published(model.build(name, watch)).observe(written, F.count(F.lit(1)).alias("rows"))
        write(frame, name, (complete(written),))
        counts = dict(watch.get)
        reports.append(TableReport(name, counts.pop("rows_seen", 0), written.get["rows"], counts))
        _serve(model, name, read(frame, name))
    return reports


def _serve(model: RetailModel, name: str, copy: DataFrame) -> None:
    """From now on the model reads a table, and the narrow forms it serves for, from storage."""
    for served in (name, *[narrow for narrow, table in SERVED_BY.items() if table == name]):
        setattr(model, served, copy)


def sharing(model: RetailModel, tables: dict[str, tuple[str, ...]]) -> RetailModel:
    """A model that reads these tables from scratch copies, each written once, for queries that read many marts at
    once. A copy holds the columns named for it, or all."""
    shared = RetailModel(model.landed, model.as_of)
    for name, columns in tables.items():
        _serve(shared, name, stored(getattr(shared, name).select(*columns or "*"), name))
    return shared


def publish(
    model: RetailModel,
    target: str,
    tables: tuple[str, ...] = CONFORMED + MARTS,
    partition_by: dict[str, tuple[str, ...]] | None = None,
) -> list[TableReport]:
    """Write the tables under `target`, each in one pass that also counts rows and rule violations on its input.

    Every written table replaces its plan in the model, so later tables read it from storage: nothing
    is computed twice, scans fetch only the columns a mart needs, and a lost executor costs at most
    the table in progress. `partition_by` splits a table by column values, for readers that prune.
    """
    split = partition_by or {}
    return _publish(
        model,
        tables,
        lambda df, name, checks: write_table(df, f"{target}/{name}", partition_by=split.get(name, ()), audits=checks),
        lambda df, name: df.sparkSession.read.schema(df.schema).parquet(f"{target}/{name}"),
    )


def publish_to_catalog(
    model: RetailModel, database: str, buckets: int | None = None, tables: tuple[str, ...] = CONFORMED + MARTS
) -> list[TableReport]:
    """The same as named tables of a database. With `buckets`, tables at order grain are bucketed by
    order, so the marts and facts built from them join without moving rows.

    Rows are brought together by bucket before the write, one file per bucket. An order that holds a
    large part of all rows makes its bucket large; publish such data without buckets.
    """

    def write(df: DataFrame, name: str, checks: tuple[Audit, ...]) -> None:
        if buckets and name in BY_ORDER:
            save_table(df.repartition(buckets, "order_id"), f"{database}.{name}", bucket_by=(buckets, "order_id"), audits=checks)
        else:
            save_table(df, f"{database}.{name}", audits=checks)

    return _publish(model, tables, write, lambda df, name: df.sparkSession.table(f"{database}.{name}"))


def read_published(spark: SparkSession, target: str, name: str) -> DataFrame:
    return open_folder(spark, f"{target}/{name}")


def stored_counts(spark: SparkSession, target: str, tables: tuple[str, ...] = CONFORMED + MARTS) -> DataFrame:
    """Rows of published tables, from the footers of their files alone."""
    return audits.footer_counts(spark, {name: f"{target}/{name}" for name in tables})


def invariant_report(model: RetailModel) -> DataFrame:
    """One row for each invariant of the revenue tables."""
    return audits.invariants(
        model.payments_clean,
        model.payments_order_agg,
        model.orders_revenue,
        model.raw.raw_orders,
        model.order_items_revenue,
        model.revenue_by_category_month,
        model.revenue_by_state_month,
        model.revenue_by_payment_type_month,
        model.revenue_exec_summary,
    )


def gate(model: RetailModel) -> DataFrame:
    """The invariants, as a frame that stops whatever job reads it when one of them does not hold."""
    return audits.require_pass(invariant_report(model))


def release(model: RetailModel, target: str, tables: tuple[str, ...] = CONFORMED + MARTS) -> list[TableReport]:
    """Publish below `<target>/candidate`, pass the gate on the stored copies, then swap `<target>/current` for it.

    If a rule, an audit or an invariant fails, `current` keeps the last release as a whole.
    """
    spark = model.landed.raw_orders.sparkSession
    candidate, current = f"{target}/candidate", f"{target}/current"
    staged = RetailModel(model.landed, model.as_of)  # its frames read the candidate, which is about to move
    reports = publish(staged, candidate, tables)
    gate(staged).collect()  # one row for each invariant
    swap_folders(spark, candidate, current)
    for name in tables:
        _serve(model, name, spark.read.schema(getattr(staged, name).schema).parquet(f"{current}/{name}"))
    return reports
