"""Facts that are stored once serve every table made of them, with the same rows."""

import pytest

from martloom.plans.model import RetailModel
from martloom.plans.publish import publish, sharing
from martloom.session import scratch_dir
from martloom.sources.star import STAR_SCHEMAS, raw_tables
from tests.plans import plan_text

ROWS = {
    "orders": (
        60,
        "id AS o_orderkey",
        "id % 7 AS o_custkey",
        "if(id % 3 = 0, 'F', 'O') AS o_orderstatus",
        "1D AS o_totalprice",
        "cast(date_add(date'2020-01-01', cast(id * 11 AS int)) AS timestamp_ntz) AS o_orderdate",
        "'1' AS o_orderpriority",
    ),
    "lineitem": (
        300,
        "id % 55 AS l_orderkey",
        "id % 9 AS l_partkey",
        "id % 4 AS l_suppkey",
        "cast(id AS int) AS l_linenumber",
        "cast(id % 50 AS double) AS l_quantity",
        "id * 1.25D AS l_extendedprice",
        "0D AS l_discount",
        "0D AS l_tax",
        "if(id % 2 = 0, 'A', 'R') AS l_returnflag",
        "'F' AS l_linestatus",
        "timestamp_ntz'2021-01-01 00:00:00' AS l_shipdate",
    ),
    "part": (
        9,
        "id AS p_partkey",
        "'n' AS p_name",
        "'b' AS p_brand",
        "concat('KIND ', id % 3) AS p_type",
        "cast(id AS int) AS p_size",
        "1D AS p_retailprice",
    ),
    "customer": (
        7,
        "id AS c_custkey",
        "'n' AS c_name",
        "cast(id % 3 AS int) AS c_nationkey",
        "1D AS c_acctbal",
        "'m' AS c_mktsegment",
    ),
    "supplier": (4, "id AS s_suppkey", "'n' AS s_name", "cast(id AS int) AS s_nationkey", "1D AS s_acctbal"),
}


@pytest.fixture(scope="module")
def folder(spark):
    folder = scratch_dir(spark, "star")
    for name, (n, *columns) in ROWS.items():
        rows = spark.range(n).selectExpr(*columns)
        rows.select(*[f.strip().split()[0] for f in STAR_SCHEMAS[name].split(",")]).write.parquet(f"{folder}/{name}.parquet")
    return folder


def rows_of(df):
    return sorted(map(str, df.drop("kpi_generated_ts").collect()))


def test_stored_totals_serve_recent_orders(spark, folder):
    plain, stored = (RetailModel(raw_tables(spark, folder)) for _ in range(2))
    publish(stored, scratch_dir(spark, "published"), ("order_totals",))
    assert "l_extendedprice" in plan_text(plain.last_12m_orders) and "l_extendedprice" not in plan_text(stored.last_12m_orders)
    assert rows_of(stored.last_12m_orders) == rows_of(plain.last_12m_orders) != []


def test_the_summary_reads_the_stored_category_mart(spark, folder):
    plain, stored = (RetailModel(raw_tables(spark, folder)) for _ in range(2))
    publish(stored, scratch_dir(spark, "published"), ("revenue_by_category_month",))
    assert "l_partkey" in plan_text(plain.revenue_exec_summary) and "l_partkey" not in plan_text(stored.revenue_exec_summary)
    assert rows_of(stored.revenue_exec_summary) == rows_of(plain.revenue_exec_summary)


def test_marts_read_shared_facts(spark, folder):
    from martloom.plans.catalog import _SHARED_FACTS

    plain = RetailModel(raw_tables(spark, folder))
    shared = sharing(plain, _SHARED_FACTS)
    for name in ("revenue_monthly", "revenue_by_state_month", "revenue_by_payment_type_month", "customer_segmentation"):
        assert "l_extendedprice" not in plan_text(getattr(shared, name))
        assert rows_of(getattr(shared, name)) == rows_of(getattr(plain, name)) != []
