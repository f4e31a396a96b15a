"""Every named query, as a function of the model."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.functions import money_sum
from martloom.operators import sketches
from martloom.operators.quality import DROP, FAIL, WARN, Expectation, enforce, violation_report
from martloom.operators.sampling import sample_by_key
from martloom.plans import audits, conform, delivery, revenue, segments
from martloom.plans.model import RetailModel
from martloom.plans.publish import CONFORMED, MARTS, gate, invariant_report, publish, sharing, stored_counts
from martloom.plans.rules import RULES
from martloom.plans.stages import STAGES
from martloom.session import scratch_dir
from martloom.sources.ingest import load_all, read_folder, read_source, read_tables, write_csv, write_table
from martloom.sources.schemas import FileSource, default_config, sources_from_config
from martloom.sources.store import AuditError, open_folder

AS_OF = "2024-01-01 00:00:00"
Query = Callable[[RetailModel], DataFrame]

BROADCAST_BELOW = 64 << 20  # bytes in memory up to which the product catalog is hinted

_SHARES = {
    "revenue_by_category_month": "revenue_share_of_month",
    "revenue_by_state_month": "revenue_share_of_month",
    "revenue_by_payment_type_month": "share_of_month_revenue",
}
_MART_TABLES = (
    "payments_clean",
    "payments_order_agg",
    "product_catalog",
    "order_items_revenue",
    "items_per_order",
    "orders_revenue",
    "geo_zip_prefix",
    "customer_geo",
    "seller_geo",
    "delivery_order",
    "order_seller_rollup",
    "delivery_order_item",
    "order_totals",
    "last_12m_orders",
    "customer_value_segment",
    "customer_volume_segment",
    "revenue_monthly",
    "revenue_by_category_month",
    "revenue_by_state_month",
    "revenue_by_payment_type_month",
    "delivery_state_month",
    "delivery_seller_state_month",
    "delivery_corridor_month",
    "delivery_hotspots",
    "customer_segmentation",
)
# Facts that several of the tables above are made of, and the columns those read; none: all.
_SHARED_FACTS = {
    "orders_revenue": (
        "order_id",
        "order_purchase_month",
        "customer_unique_id",
        "customer_state",
        "primary_payment_type",
        "installments_max",
        "revenue_total",
        "is_revenue_recognised",
    ),
    "order_totals": (),
    "last_12m_orders": (),
}
_STORED_TABLES = tuple(name for name in CONFORMED + MARTS if name in _MART_TABLES)


def _table(name: str) -> Query:
    return lambda m: getattr(m, name)


# --- quality ------------------------------------------------------------------------------------


def _reports(m: RetailModel, *actions: str) -> DataFrame:
    """Passes and violations of every rule on the rows its table is made of, before cleaning removes offenders."""
    frames = [
        violation_report(STAGES[name].rows(m), [r for r in rules if r.action in actions], name)
        for name, rules in RULES.items()
        if any(r.action in actions for r in rules)
    ]
    return reduce(DataFrame.unionByName, frames)


def _publish_report(m: RetailModel) -> DataFrame:
    """The same figures, counted while the tables are written."""
    spark = _spark(m)
    lines = [
        (report.table, rule.name, rule.action, report.rows_seen - report.violations[rule.name], report.violations[rule.name])
        for report in publish(m, scratch_dir(spark, "published"), CONFORMED + MARTS)
        for rule in RULES.get(report.table, ())
    ]
    return spark.createDataFrame(lines, "table_name string, rule_name string, action string, passed bigint, violations bigint")


def _dropped_customers(m: RetailModel) -> DataFrame:
    return m.raw.raw_customers


def _count_audit(m: RetailModel) -> DataFrame:
    """Delivered rows against the rows the source rules let through."""
    return audits.row_count_audit(audits.row_counts(m.raw), audits.row_counts(m.landed))


def _grains(m: RetailModel) -> DataFrame:
    return audits.grain_check(
        {
            "payments_order_agg": (m.payments_order_agg, ["order_id"]),
            "product_catalog": (m.product_catalog, ["product_id"]),
            "orders_revenue": (m.orders_revenue, ["order_id"]),
            "geo_zip_prefix": (m.geo_zip_prefix, ["zip_code_prefix", "geo_state"]),
            "customer_geo": (m.customer_geo, ["customer_id"]),
            "seller_geo": (m.seller_geo, ["seller_id"]),
            "order_seller_rollup": (m.order_seller_rollup, ["order_id", "seller_id"]),
            "raw_order_items": (m.raw.raw_order_items, ["order_id", "order_item_id"]),
        }
    )


def _mart_counts(m: RetailModel) -> DataFrame:
    """Rows of every table; the facts that several of them read are written once and read from there."""
    shared = sharing(m, _SHARED_FACTS)
    return audits.row_counts({name: getattr(shared, name) for name in _MART_TABLES})


def _stored_counts(m: RetailModel) -> DataFrame:
    """Write the tables, then count them by their files' footers."""
    target = scratch_dir(_spark(m), "published")
    publish(m, target, _STORED_TABLES)
    return stored_counts(_spark(m), target, _STORED_TABLES)


# --- ingest -------------------------------------------------------------------------------------


def _landed_csv(spark: SparkSession, m: RetailModel, *names: str) -> list[FileSource]:
    """The source tables written out as CSV files, and their configuration."""
    folder = scratch_dir(spark, "csv")
    chosen = [s for s in sources_from_config(default_config(folder)) if s.table_name in (names or m.landed)]
    for source in chosen:
        write_csv(m.landed[source.table_name], source.path, source)
    return chosen


def _spark(m: RetailModel) -> SparkSession:
    return m.landed.raw_orders.sparkSession


def _loaded_counts(m: RetailModel) -> DataFrame:
    """Load every source from CSV into tables; rows read, rows kept and rule violations per table."""
    spark = _spark(m)
    target = scratch_dir(spark, "bronze")
    lines = []
    for report in load_all(spark, _landed_csv(spark, m), target):
        kept = spark.read.parquet(f"{target}/{report.table_name}")
        lines.append(
            kept.agg(
                F.lit(report.table_name).alias("table_name"),
                F.lit(report.rows_read).cast("bigint").alias("rows_read"),
                F.count("ingestion_ts").alias("rows_kept"),
                F.lit(sum(report.violations.values())).cast("bigint").alias("violations"),
            )
        )
    return reduce(DataFrame.unionByName, lines)


def _ingested(table: str) -> Query:
    def query(m: RetailModel) -> DataFrame:
        spark = _spark(m)
        return read_tables(spark, _landed_csv(spark, m, table))[table].drop("ingestion_ts")

    return query


def _lineage(m: RetailModel) -> DataFrame:
    """Rows per landing folder of all sources, from the path each row came from."""
    spark = _spark(m)
    folder = F.regexp_extract("source_file", r"/([a-z_]+)\.csv/", 1)
    frames = [
        read_source(spark, s, lineage=True).select(folder.alias("landed_as"), "ingestion_ts")
        for s in _landed_csv(spark, m)
    ]
    stacked = reduce(DataFrame.unionByName, frames)
    return stacked.groupBy("landed_as").agg(F.count("ingestion_ts").alias("row_count"))


def _folder(m: RetailModel) -> DataFrame:
    """All nine landed sources as one frame, columns matched by the files' headers."""
    spark = _spark(m)
    sources = _landed_csv(spark, m)
    quoted = [s for s in sources if s.multiLine]

    def options(header: tuple[str, ...]) -> dict:
        """Text with line ends needs whole files; they are told by their columns."""
        return next((s.reader_options() for s in quoted if header[0] == s.schema.split()[0]), {})

    folder = sources[0].path.rpartition("/")[0]
    return read_folder(spark, folder, options_for=options, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def _overwrites(m: RetailModel) -> DataFrame:
    """Rows of a stored table after its first write, a write that a rule stops half-way, one that an audit refuses, and a good one."""
    spark = _spark(m)
    target = f"{scratch_dir(spark, 'overwritten')}/payments"
    payments, steps = m.payments_clean, []

    def after(step: str, write: Callable[[], None], refused: type[Exception] | None = None) -> None:
        if refused is None:
            write()
        else:
            try:
                write()
            except refused:
                pass
            else:
                raise AssertionError(f"{step} was not refused")
        rows = open_folder(spark, target).agg(F.count(F.lit(1)).alias("row_count"), money_sum("payment_value").alias("total_value"))
        kept = scratch_dir(spark, "steps")
        rows.withColumn("step", F.lit(step)).write.parquet(kept)
        steps.append(spark.read.parquet(kept))

    def none_left(staged: DataFrame) -> None:
        raise AuditError(f"{staged.count()} rows are too many")

    last = Expectation("not_the_last", "payment_sequential < 7", FAIL)
    after("first", lambda: write_table(payments, target))
    after("stopped_by_rule", lambda: write_table(enforce(payments, [last]), target), PySparkException)
    after("refused_by_audit", lambda: write_table(payments.limit(5), target, audits=(none_left,)), AuditError)
    after("from_itself", lambda: write_table(spark.read.parquet(target).filter("payment_sequential = 1"), target))
    return reduce(DataFrame.unionByName, steps)


# --- sketches -----------------------------------------------------------------------------------


def _customers_by_year(m: RetailModel) -> DataFrame:
    """Customers per state and year from stored monthly sketches, beside the exact count."""
    spark, keys = _spark(m), ["customer_state", "order_purchase_year"]
    orders = revenue.recognised(m.orders_revenue).filter("customer_state IS NOT NULL")
    folder = scratch_dir(spark, "sketches")
    write_table(sketches.distinct_sketches(orders, [*keys, "order_purchase_month"], "customer_unique_id"), folder)
    estimated = sketches.distinct_rollup(open_folder(spark, folder), keys).select(*keys, sketches.distinct_estimate().alias("estimate"))
    exact = orders.groupBy(*keys, "customer_unique_id").agg(F.lit(1).alias("n")).groupBy(*keys).agg(F.count("customer_unique_id").alias("customers"))
    off = F.abs(F.col("estimate") - F.col("customers"))
    return exact.join(estimated, keys).select(
        *keys, "customers", (off <= F.ceil(F.col("customers") * 3 * sketches.distinct_error())).alias("sketch_within_bound")
    )


def _freight_medians(m: RetailModel) -> DataFrame:
    """Median freight of an order's seller per seller state, from stored monthly sketches, checked by its rank."""
    spark, value = _spark(m), "order_seller_freight_value"
    rows = m.delivery_order_item_places.filter(f"seller_state IS NOT NULL AND {value} IS NOT NULL")
    folder = scratch_dir(spark, "sketches")
    write_table(sketches.quantile_sketches(rows, ["seller_state", "order_purchase_month"], value), folder)
    medians = sketches.quantile_rollup(open_folder(spark, folder), ["seller_state"]).select("seller_state", sketches.quantile_estimate(0.5).alias("median"))
    ranked = rows.join(medians, "seller_state").groupBy("seller_state").agg(
        F.count(F.lit(1)).alias("order_sellers"),
        F.count_if(F.col(value) < F.col("median")).alias("below"),
        F.count_if(F.col(value) <= F.col("median")).alias("upto"),
    )
    slack, half = F.col("order_sellers") * sketches.rank_error() + 1, F.col("order_sellers") / 2
    return ranked.select(
        "seller_state", "order_sellers", ((F.col("below") <= half + slack) & (F.col("upto") >= half - slack)).alias("sketch_within_bound")
    )


# --- samples ------------------------------------------------------------------------------------


def _sample_sizes(m: RetailModel) -> DataFrame:
    """Orders kept at the two benchmark fractions, chosen by the digest of their ids."""
    frames = [
        sample_by_key(m.raw.raw_orders, "order_id", fraction).agg(
            F.lit(fraction).alias("fraction"), F.count(F.lit(1)).alias("row_count")
        )
        for fraction in (0.5, 0.1)
    ]
    return reduce(DataFrame.unionByName, frames)


QUERIES: dict[str, Query] = {
    # sources
    "ingest_csv_roundtrip": _loaded_counts,
    "ingest_orders_csv": _ingested("raw_orders"),
    "ingest_payments_csv": _ingested("raw_order_payments"),
    "ingest_multiline_csv": _ingested("raw_order_reviews"),
    "ingest_lineage": _lineage,
    "ingest_folder_csv": _folder,
    "overwrite_keeps_old": _overwrites,
    "sample_scaling": _sample_sizes,
    "customers_by_state_year": _customers_by_year,
    "freight_median_by_state": _freight_medians,
    "sample_by_key_half": lambda m: m.sampled(0.5).revenue_monthly,
    "sample_by_key_tenth": lambda m: m.sampled(0.1).revenue_monthly,
    # quality
    "dq_warn_counts": lambda m: _reports(m, WARN),
    "dq_report": lambda m: _reports(m, WARN, DROP, FAIL),
    "publish_report": _publish_report,
    "dq_drop": lambda m: enforce(
        conform.typed_payments(m.raw.raw_order_payments), [r for r in RULES["payments_clean"] if r.action == DROP]
    ),
    "dq_all_or_drop": _dropped_customers,
    "dq_fail": lambda m: enforce(conform.payments_per_order(m.payments_clean), RULES["payments_order_agg"]),
    # conformed tables
    "std_orders": lambda m: conform.with_purchase_calendar(conform.standard_orders(m.raw.raw_orders)).withColumn(
        "order_purchase_year", F.year("order_purchase_ts")
    ),
    "payments_clean": _table("payments_clean"),
    "payments_order_agg": _table("payments_order_agg"),
    "product_catalog": _table("product_catalog"),
    "order_items_revenue": _table("order_items_revenue"),
    "order_items_revenue_broadcast": lambda m: conform.order_items_revenue(
        m.raw.raw_order_items, m.product_catalog, BROADCAST_BELOW
    ),
    "items_per_order": _table("items_per_order"),
    "orders_revenue": _table("orders_revenue"),
    "orders_revenue_no_customers": lambda m: conform.orders_revenue(
        m.raw.raw_orders, m.items_per_order, m.payments_order_agg, None
    ),
    "orders_revenue_item_grain": _table("orders_revenue_item_grain"),
    "geo_zip_prefix": _table("geo_zip_prefix"),
    "customer_geo": _table("customer_geo"),
    "seller_geo": _table("seller_geo"),
    "delivery_order": _table("delivery_order"),
    "order_seller_rollup": _table("order_seller_rollup"),
    "delivery_order_item": _table("delivery_order_item"),
    "order_totals": _table("order_totals"),
    "last_12m_orders": _table("last_12m_orders"),
    "customer_value_segment": _table("customer_value_segment"),
    "customer_volume_segment": _table("customer_volume_segment"),
    # marts
    "revenue_monthly": _table("revenue_monthly"),
    "revenue_by_category_month": _table("revenue_by_category_month"),
    "revenue_by_state_month": _table("revenue_by_state_month"),
    "revenue_by_payment_type_month": _table("revenue_by_payment_type_month"),
    "revenue_exec_summary": lambda m: m.revenue_exec_summary.drop("kpi_generated_ts"),
    "delivery_state_month": _table("delivery_state_month"),
    "delivery_seller_state_month": _table("delivery_seller_state_month"),
    "delivery_corridor_month": _table("delivery_corridor_month"),
    "delivery_hotspots": _table("delivery_hotspots"),
    "delivery_exec_summary": lambda m: m.delivery_exec_summary.drop("kpi_generated_ts"),
    "revenue_exec_summary_as_of": lambda m: RetailModel(m.landed, AS_OF).revenue_exec_summary,
    "delivery_exec_summary_as_of": lambda m: RetailModel(m.landed, AS_OF).delivery_exec_summary,
    "customer_segmentation": _table("customer_segmentation"),
    # documented extensions of the segments and the summary
    "customer_payment_preference": lambda m: segments.payment_preference(
        m.raw.raw_orders, m.payments_clean, m.raw.raw_customers
    ),
    "customer_six_personas": lambda m: segments.customer_segmentation(
        m.last_12m_orders,
        value_cuts=(0.85, 0.30),
        persona=segments.matrix_persona(segments.SIX_PERSONAS, "Unassigned"),
    ),
    "customer_tiers": lambda m: segments.customer_segmentation(
        m.last_12m_orders, persona=segments.matrix_persona(segments.CUSTOMER_TIERS, "Unassigned")
    ),
    "customer_activity": lambda m: segments.customer_activity(m.raw.raw_customers, m.last_12m_orders),
    "peak_month": lambda m: revenue.peak_month(m.revenue_monthly),
    # listings
    "monthly_listing": lambda m: revenue.monthly_listing(m.revenue_monthly),
    "top_categories": lambda m: revenue.top_categories(m.revenue_by_category_month),
    "top_states": lambda m: revenue.state_totals(m.revenue_by_state_month).limit(10),
    "state_totals": lambda m: revenue.state_totals(m.revenue_by_state_month),
    "payment_totals": lambda m: revenue.payment_totals(m.revenue_by_payment_type_month),
    "delivery_buckets": lambda m: delivery.bucket_counts(m.delivery_order_places),
    "delivery_delta_range": lambda m: delivery.delta_range(m.delivery_order_places),
    "delivery_profile": lambda m: delivery.delivery_profile(m.delivery_order_places),
    "worst_hotspots": lambda m: delivery.worst_hotspots(m.delivery_hotspots),
    "worst_states": lambda m: delivery.worst_states(m.delivery_state_month),
    "worst_corridors": lambda m: delivery.worst_corridors(m.delivery_corridor_month),
    "customer_id_multiplicity": lambda m: segments.customer_id_multiplicity(m.raw.raw_customers),
    "volume_histogram": lambda m: segments.volume_histogram(m.last_12m_orders),
    "percentile_band": lambda m: segments.percentile_band(m.customer_value_segment, 0.6, 0.7),
    "purchase_range": lambda m: segments.purchase_range(m.last_12m_orders),
    "null_state_orders": lambda m: audits.null_state_orders(m.orders_revenue),
    # audits
    "row_counts": lambda m: audits.row_counts(m.landed),
    "stored_row_counts": _stored_counts,
    "mart_row_counts": _mart_counts,
    "row_count_audit": _count_audit,
    "payment_profile": lambda m: audits.payment_profile(m.landed.raw_order_payments),
    "ghost_payments": lambda m: audits.ghost_payments(m.raw.raw_order_payments, m.raw.raw_orders),
    "grain_check": _grains,
    "payment_mix": lambda m: audits.payment_mix(m.payments_order_agg),
    "reconciliation_summary": lambda m: audits.reconciliation_summary(m.orders_revenue),
    "unknown_category_rate": lambda m: audits.unknown_category_rate(m.order_items_revenue),
    "share_sum_check": lambda m: audits.share_sum_check({n: (getattr(m, n), s) for n, s in _SHARES.items()}),
    "invariant_gate": invariant_report,
    "invariant_gate_enforced": gate,
}
