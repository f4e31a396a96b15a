"""The shape of the plans: what is read, what is shuffled, what stays in generated code."""

import pytest
from pyspark.errors import PySparkException

from martloom.operators.sampling import sample_by_key
from martloom.plans.catalog import QUERIES
from martloom.plans.model import RetailModel
from martloom.plans.publish import CONFORMED, MARTS, publish, publish_to_catalog, read_published
from martloom.session import scratch_dir
from martloom.sources.star import raw_tables
from tests.plans import plan_text, read_schemas

SF_DIR = "/root/testdata/sf0.001"
LARGE_PLANS = [n for n in CONFORMED + MARTS if n not in ("customer_value_segment", "customer_segmentation")]


@pytest.fixture(scope="module")
def model(spark):
    return RetailModel(raw_tables(spark, SF_DIR))


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when every side is too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LARGE_PLANS)
def test_no_cross_joins_and_no_python(model, no_broadcast, name):
    text = plan_text(getattr(model, name))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert unwanted not in text


def test_monthly_reads_five_columns(model):
    """Payments, customers and products play no part in the monthly mart."""
    assert sorted(read_schemas(model.revenue_monthly)) == [
        "l_orderkey:bigint,l_quantity:double,l_extendedprice:double",
        "o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz",
    ]


def test_item_filter_reaches_the_scan(model):
    text = plan_text(model.items_per_order)
    assert "GreaterThanOrEqual(l_extendedprice,0.0)" in text
    assert "GreaterThanOrEqual(l_quantity,0.0)" in text


def test_monthly_shuffles_orders_and_items_once(model, no_broadcast):
    """One exchange for orders, one for items, then the tiny monthly rows."""
    text = plan_text(model.revenue_monthly)
    assert text.count("hashpartitioning(order_id") == 2
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_order_fact_joins_on_one_partitioning(model, no_broadcast):
    """Items, payments and orders each move once by order; the customer join comes before. Payments of types that are
    not on the list, few or none, move by order and type and then by order."""
    text = plan_text(model.orders_revenue)
    assert text.count("hashpartitioning(order_id") == 5
    assert text.count("hashpartitioning(customer_id") == 2


def test_seller_mart_scans_items_once(model, no_broadcast):
    """Orders and sellers are counted over the same shuffled items: the plan that ran holds one shuffle of them."""
    mart = model.delivery_corridor_month
    assert plan_text(mart).count("l_extendedprice") == 0
    assert len({s for s in read_schemas(mart) if "l_orderkey" in s}) == 1
    mart.collect()
    ran = plan_text(mart).split("== Initial Plan ==")[0]
    assert ran.count("ReusedExchange") >= 2
    assert ran.count("Scan parquet") == 4  # items, sellers, orders, customers


def test_delay_marts_use_plain_hash_aggregates(model):
    for name in ("delivery_state_month", "delivery_corridor_month", "delivery_hotspots", "delivery_exec_summary"):
        text = plan_text(getattr(model, name))
        assert "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_segment_window_is_a_scan_filter(model):
    text = plan_text(model.last_12m_orders)
    assert "Subquery" in text and "add_months" in text
    assert "CartesianProduct" not in text


def test_percent_rank_never_sorts_rows_in_one_task(spark):
    from martloom.operators.ranking import with_percent_rank

    text = plan_text(with_percent_rank(spark.range(100).selectExpr("id AS x", "id % 7 AS k"), "x", "p"))
    single = [part for part in text.split("\n\n") if "SinglePartition" in part]
    assert len(single) == 1 and "_top" in single[0]


def test_sampling_by_key_keeps_pairs_and_adds_no_shuffle(model):
    orders = sample_by_key(model.raw.raw_orders, "order_id", 0.25)
    items = sample_by_key(model.raw.raw_order_items, "order_id", 0.25)
    assert "Exchange" not in plan_text(items)
    total, kept = model.raw.raw_orders.count(), orders.count()
    assert 0.2 * total < kept < 0.3 * total
    every = model.raw.raw_order_items.join(orders.select("order_id"), "order_id", "left_semi").count()
    assert every == items.join(orders.select("order_id"), "order_id", "left_semi").count()


def test_skewed_join_is_split(spark):
    """A hot key's partition is divided at run time."""
    from martloom.operators.lookup import enrich

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 60_000, numPartitions=8).selectExpr(
            "if(id % 3 = 0, 'hot', cast(id AS string)) AS product_id", "id"
        )
        catalog = spark.range(60_000).selectExpr("cast(id AS string) AS product_id", "id % 9 AS c").union(
            spark.sql("SELECT 'hot' AS product_id, 1L AS c")
        )
        joined = enrich(facts, catalog, ["product_id"], ["c"])
        rows = joined.collect()
        assert len(rows) == 60_000 and all(r.c is not None for r in rows)
        joined = enrich(facts, catalog, ["product_id"], ["c"])
        joined.collect()
        assert "skew=true" in plan_text(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_published_marts_equal_the_composed_ones(spark):
    composed = RetailModel(raw_tables(spark, SF_DIR))
    stored = RetailModel(raw_tables(spark, SF_DIR))
    target = scratch_dir(spark, "published")
    reports = {r.table: r for r in publish(stored, target, partition_by={"orders_revenue": ("order_purchase_month",)})}
    assert set(reports) == set(CONFORMED + MARTS)
    assert reports["orders_revenue"].violations["payment_reconciles"] > 0
    for name in MARTS:
        mart = read_published(spark, target, name).drop("kpi_generated_ts")
        want = getattr(composed, name).drop("kpi_generated_ts").select(*mart.columns)
        assert sorted(map(str, mart.collect())) == sorted(map(str, want.collect())), name
        assert reports[name].rows == mart.count()
    pruned = read_published(spark, target, "orders_revenue").filter("order_purchase_month = date'1997-05-01'")
    assert "PartitionFilters: [isnotnull(order_purchase_month" in plan_text(pruned)


def test_bucketed_tables_spare_the_order_shuffle(spark, no_broadcast):
    spark.sql("CREATE DATABASE IF NOT EXISTS retail")
    model, plain = (RetailModel(raw_tables(spark, SF_DIR)) for _ in range(2))
    facts = ("payments_order_agg", "product_catalog", "order_items_revenue", "customer_geo", "orders_revenue")
    reports = publish_to_catalog(model, "retail", buckets=4, tables=facts)
    assert [r.table for r in reports] == list(facts)
    mart = model.revenue_by_category_month
    assert "hashpartitioning(order_id" not in plan_text(mart)
    assert sorted(map(str, mart.collect())) == sorted(map(str, plain.revenue_by_category_month.collect()))


def test_every_survey_query_is_registered():
    named = """ingest_csv_roundtrip ingest_multiline_csv sample_scaling dq_warn_counts dq_drop dq_fail
    dq_all_or_drop dq_report std_orders delivery_buckets payments_clean orders_revenue product_catalog
    order_items_revenue customer_geo seller_geo delivery_order_item revenue_monthly last_12m_orders
    revenue_exec_summary ghost_payments customer_segmentation top_categories top_states worst_corridors
    row_counts payments_order_agg items_per_order geo_zip_prefix delivery_order order_seller_rollup
    order_totals customer_value_segment customer_volume_segment revenue_by_category_month
    revenue_by_state_month revenue_by_payment_type_month delivery_state_month delivery_seller_state_month
    delivery_corridor_month delivery_hotspots delivery_exec_summary row_count_audit payment_profile
    grain_check payment_mix reconciliation_summary unknown_category_rate state_totals payment_totals
    share_sum_check invariant_gate delivery_profile customer_id_multiplicity volume_histogram
    percentile_band orders_revenue_item_grain""".split()
    assert set(named) <= set(QUERIES)


def test_marts_from_ingested_files_equal_the_direct_ones(spark):
    from martloom.sources.ingest import read_tables, write_csv
    from martloom.sources.schemas import default_config, sources_from_config
    from martloom.sources.star import RawTables

    raw = raw_tables(spark, SF_DIR)
    sources = sources_from_config(default_config(scratch_dir(spark, "landing")))
    for source in sources:
        write_csv(raw[source.table_name], source.path, source)
    landed = RetailModel(RawTables.of(**read_tables(spark, sources)))
    direct = RetailModel(raw)
    for name in ("revenue_by_payment_type_month", "revenue_by_category_month", "seller_geo", "order_totals"):
        got = sorted(map(str, getattr(landed, name).collect()))
        assert got and got == sorted(map(str, getattr(direct, name).collect()))
    # Broken customers, which the source rules drop, are in neither model.
    for name in ("customer_volume_segment", "customer_segmentation", "customer_geo"):
        assert sorted(map(str, getattr(landed, name).collect())) == sorted(map(str, getattr(direct, name).collect()))
    lost = RetailModel(raw.replacing(raw_customers=raw.raw_customers.filter("cast(customer_id AS bigint) % 3 <> 0")))
    for name in ("customer_volume_segment", "customer_segmentation"):
        with pytest.raises(Exception, match="customer_unique_id_not_null"):  # several readers of one shuffle report it
            getattr(lost, name).collect()


def test_hot_order_at_item_grain_is_split(spark):
    """The item-grain fact keeps adaptive splitting although more joins on the order follow."""
    from martloom.plans import conform

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 60_000, numPartitions=8)
        orders = rows.selectExpr(
            "cast(id AS string) AS order_id", "'c' AS customer_id", "'delivered' AS order_status",
            "timestamp_ntz'2022-01-01 00:00:00' AS order_purchase_timestamp",
        )
        items = rows.selectExpr(
            "if(id % 3 = 0, '1', cast(id AS string)) AS order_id", "'p' AS product_id", "id AS order_item_id",
            "cast(id AS double) AS price", "1.0D AS item_total_revenue", "'x' AS product_category_en",
        )
        payments = rows.selectExpr(
            "cast(id AS string) AS order_id", "1.0D AS payment_value", "'boleto' AS payment_type",
            "1 AS payment_sequential", "1 AS payment_installments",
        )
        fact = conform.orders_revenue_item_grain(orders, items, conform.payments_per_order(payments), None)
        assert len(fact.collect()) == 60_000
        assert "skew=true" in plan_text(fact)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# --- broadcast by plan statistics


def test_broadcast_hint_follows_the_planned_bytes(spark, model, no_broadcast):
    from martloom.operators.lookup import GROWTH_IN_MEMORY, enrich, planned_bytes

    catalog = model.product_catalog
    spark.sparkContext.setJobGroup("composition", "no job may run here")
    size = planned_bytes(catalog.select("product_id", "product_category_en")) * GROWTH_IN_MEMORY
    below = enrich(model.priced_items, catalog, ["product_id"], ["product_category_en"], size + 1)
    above = enrich(model.priced_items, catalog, ["product_id"], ["product_category_en"], size)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("composition") == []
    spark.sparkContext.setJobGroup("other", "")
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan_text(below)
    assert "BroadcastHashJoin LeftOuter BuildRight" not in plan_text(above)
    assert below.count() == above.count()


def test_segments_run_no_job_while_they_are_composed(spark):
    model = RetailModel(raw_tables(spark, SF_DIR))
    spark.sparkContext.setJobGroup("segments", "no job may run here")
    for name in ("customer_value_segment", "customer_segmentation"):
        plan_text(getattr(model, name))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("segments") == []
    spark.sparkContext.setJobGroup("other", "")


def test_percent_rank_reuses_the_shuffle_of_customers(spark, no_broadcast):
    segmented = RetailModel(raw_tables(spark, SF_DIR)).customer_segmentation
    segmented.collect()
    ran = plan_text(segmented).split("== Initial Plan ==")[0]
    assert ran.count("ReusedExchange") >= 1


# --- payments and sellers in primitive buffers


def test_payments_need_no_sort_aggregate(model, no_broadcast):
    for name in ("payments_order_agg", "revenue_by_payment_type_month"):
        text = plan_text(getattr(model, name))
        assert "SortAggregate" not in text
        # types that are not on the list are gathered apart, from their rows alone
        assert text.split("(1) ")[0].count("ObjectHashAggregate") <= 2


def test_seller_marts_sort_no_rows_within_orders(model, no_broadcast):
    for name in ("delivery_corridor_month", "delivery_seller_state_month"):
        text = plan_text(getattr(model, name))
        assert "Expand" not in text and "[order_id" not in "".join(p for p in text.split("\n\n") if ") Window" in p.split("\n")[0])


def test_sampled_keys_are_compared_as_text(model):
    assert "conv(" not in plan_text(sample_by_key(model.raw.raw_orders, "order_id", 0.5))
