"""Percent rank, tiers and personas."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from martloom.operators.ranking import with_percent_rank
from martloom.plans import segments


def ranks(spark, values, bits=21):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, x double")
    built_in = F.percent_rank().over(Window.orderBy(F.col("x").asc_nulls_first()))
    want = {r.id: r.p for r in df.withColumn("p", built_in).collect()}
    got = {r.id: r.p for r in with_percent_rank(df, "x", "p", bits=bits).collect()}
    assert got == want


def test_percent_rank_edges(spark):
    ranks(spark, [5.0])
    ranks(spark, [None])
    ranks(spark, [None, None, 1.0])
    ranks(spark, [1.0, 1.0, 1.0, 2.0])
    assert with_percent_rank(spark.createDataFrame([], "x double"), "x", "p").count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5000, 5000).map(lambda c: c / 100)), min_size=1, max_size=60))
def test_percent_rank_equals_the_built_in(spark, values):
    ranks(spark, values, bits=3)


def test_percent_rank_with_a_hot_value(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 9.99).otherwise(F.col("id") / 7).alias("x"))
    df = df.withColumn("x", F.round("x", 2))
    built_in = df.withColumn("p", F.percent_rank().over(Window.orderBy("x"))).groupBy("x").agg(F.max("p").alias("p"))
    mine = with_percent_rank(df, "x", "q", bits=8).groupBy("x").agg(F.max("q").alias("q"), F.count("q").alias("n"))
    assert built_in.join(mine, "x").filter("p <> q").count() == 0
    assert mine.agg(F.sum("n")).first()[0] == 20_000


def cells(spark, *pairs):
    return spark.createDataFrame(pairs, "value_segment string, volume_segment string")


def test_base_personas(spark):
    expected = {
        ("High", "High"): "VIP",
        ("High", "Medium"): "VIP",
        ("High", "Low"): "VIP",
        ("Medium", "High"): "Core Customer",
        ("Medium", "Medium"): "Core Customer",
        ("Medium", "Low"): "Casual Buyer",
        ("Low", "High"): "Core Customer",
        ("Low", "Medium"): "Casual Buyer",
        ("Low", "Low"): "Casual Buyer",
    }
    got = cells(spark, *expected).withColumn("p", segments.base_persona()).collect()
    assert {(r[0], r[1]): r.p for r in got} == expected


def test_persona_matrix_default(spark):
    persona = segments.matrix_persona(segments.SIX_PERSONAS, "Unassigned")
    got = cells(spark, ("High", "Low"), ("Medium", "Medium")).withColumn("p", persona).collect()
    assert [r.p for r in got] == ["Premium One-Offs", "Unassigned"]


@pytest.mark.parametrize("n, segment", [(1, "Low"), (2, "Medium"), (6, "Medium"), (7, "High")])
def test_volume_tiers(spark, n, segment):
    recent = spark.createDataFrame([("u", str(i)) for i in range(n)], "customer_unique_id string, order_id string")
    (row,) = segments.customer_volume(recent).collect()
    assert (row.order_volume, row.volume_segment) == (n, segment)


def raw(spark):
    when = dt.datetime
    orders = spark.createDataFrame(
        [
            ("o1", "c1", " Delivered", when(2022, 6, 30, 12)),
            ("o2", "c1", "delivered", when(2021, 6, 30, 0)),
            ("o3", "c2", "delivered", when(2021, 6, 29, 23)),
            ("o4", "c2", "shipped", when(2023, 1, 1)),
            ("o5", "c9", "delivered", when(2022, 6, 1)),
        ],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz",
    )
    items = spark.createDataFrame(
        [("o1", "10.10", "1.00"), ("o1", "5", "0.05"), ("o3", "7", "1")], "order_id string, price string, freight_value string"
    )
    customers = spark.createDataFrame(
        [("c1", "u1"), ("c2", "u2")], "customer_id string, customer_unique_id string"
    )
    return orders, items, customers


def test_trailing_window_is_relative_to_delivered_orders(spark):
    rows = {r.order_id: r for r in segments.last_12m_orders(*raw(spark)).collect()}
    assert set(rows) == {"o1", "o2", "o5"}
    assert rows["o1"].total_price == 16.15
    assert rows["o2"].total_price is None
    assert rows["o5"].customer_unique_id is None
    assert rows["o1"].anchor_date == dt.datetime(2022, 6, 30, 12)


def test_unknown_customers_rank_but_do_not_stay(spark):
    got = segments.customer_segmentation(segments.last_12m_orders(*raw(spark))).collect()
    (row,) = got
    assert (row.customer_unique_id, row.spend_percentile, row.order_volume, row.customer_persona) == ("u1", 1.0, 2, "VIP")


def test_segmentation_equals_joined_segments(spark):
    recent = segments.last_12m_orders(*raw(spark))
    joined = segments.customer_value(recent).join(segments.customer_volume(recent), "customer_unique_id")
    both = segments.customer_segmentation(recent).drop("customer_persona")
    assert [r.asDict() for r in joined.collect()] == [r.asDict() for r in both.select(*joined.columns).collect()]


def test_activity(spark):
    orders, items, customers = raw(spark)
    got = segments.customer_activity(customers, segments.last_12m_orders(orders, items, customers)).collect()
    assert {r.customer_unique_id: (r.activity, r.order_volume) for r in got} == {
        "u1": ("Active", 2),
        "u2": ("Inactive/Historical", 0),
    }


def test_payment_preference_breaks_ties_by_latest_use(spark):
    orders, _, customers = raw(spark)
    paid = spark.createDataFrame(
        [("o1", "boleto", 5.0), ("o2", "voucher", 2.0), ("o2", "voucher", 3.0), ("o3", "boleto", 1.0), ("o4", "voucher", 9.0)],
        "order_id string, payment_type string, payment_value double",
    )
    got = {r.customer_unique_id: r for r in segments.payment_preference(orders, paid, customers).collect()}
    assert (got["u1"].preferred_payment_type, got["u1"].total_paid) == ("boleto", 10.0)
    assert got["u2"].preferred_payment_type == "voucher"
