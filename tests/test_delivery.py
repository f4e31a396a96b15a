"""Behaviour of the delivery facts and marts on small inputs."""

import datetime as dt

from pyspark.sql import Window, functions as F

from martloom.plans import conform, delivery

ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, "
    "order_estimated_delivery_date string"
)


def raw_orders(spark, *rows):
    """(order, status, delivered day or None, estimated day or None), all bought on 2022-01-01."""
    full = [
        (o, "c1", status, "2022-01-01 23:59:00", None, "2022-01-02", done and f"2022-01-{done:02d} 01:00:00", due and f"2022-01-{due:02d}")
        for o, status, done, due in rows
    ]
    return spark.createDataFrame(full, ORDERS)


def customers(spark):
    raw = spark.createDataFrame(
        [("c1", "u1", 5, " Rio ", "rj"), ("c2", "u2", 5, "Rio", "sp")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string",
    )
    return raw


def geo(spark):
    raw = spark.createDataFrame(
        [("5", "10.0", "-1.0", "Rio", "RJ"), ("5", "20.0", "bad", " alpha", "rj"), (None, "1", "1", "x", "RJ")],
        "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string, geolocation_city string, geolocation_state string",
    )
    return conform.geo_zip_prefix(raw)


def test_places_need_zip_and_state(spark):
    (spot,) = geo(spark).collect()
    assert (spot.zip_code_prefix, spot.geo_state, spot.avg_lat, spot.avg_lng, spot.geo_city) == (5, "RJ", 15.0, -1.0, "alpha")
    got = {r.customer_id: r for r in conform.customer_geo(customers(spark), geo(spark)).collect()}
    assert (got["c1"].customer_city_std, got["c1"].customer_state, got["c1"].customer_lat) == ("rio", "RJ", 15.0)
    assert got["c2"].customer_lat is None


def test_buckets_and_deltas(spark):
    cases = {
        "early": ("delivered", 5, 8, -3),
        "on_time": ("delivered", 8, 8, 0),
        "late_1_3_days": ("delivered", 11, 8, 3),
        "late_4_7_days": ("delivered", 12, 8, 4),
        "late_8_plus_days": ("delivered", 16, 8, 8),
        "not_delivered": ("shipped", 9, 8, None),
        "delivery_timestamp_missing": ("delivered", None, 8, None),
        "estimated_timestamp_missing": ("delivered", 9, None, None),
        None: (None, 9, 8, None),
    }
    rows = [(str(k), *v[:3]) for k, v in cases.items()]
    fact = conform.delivery_orders(raw_orders(spark, *rows), conform.customer_geo(customers(spark), geo(spark)))
    got = {r.order_id: r for r in fact.collect()}
    for bucket, (status, done, due, delta) in cases.items():
        row = got[str(bucket)]
        assert row.delivery_status_bucket == bucket
        assert row.delivery_delta_days == delta
        assert row.is_late == (None if delta is None else int(delta > 0))
        assert row.purchase_to_delivery_days == (done and done - 1)
        assert row.carrier_to_customer_days == (done and done - 2)
        assert row.estimated_lead_time_days == (due and due - 1)
        assert row.is_delivered == int(status == "delivered")
    assert got["early"].order_purchase_month == dt.date(2022, 1, 1)


def facts(spark, seed=7, n=3000, hot=0.4):
    """Random order and seller rows where one order, state and seller holds many rows."""
    base = spark.range(n).select(
        F.when(F.rand(seed) < hot, 0).otherwise((F.rand(seed + 1) * n / 3).cast("int")).cast("string").alias("order_id"),
        F.concat(F.lit("s"), (F.rand(seed + 2) * 40).cast("int")).alias("seller_id"),
        (F.rand(seed + 3) * 100).alias("item"),
        (F.rand(seed + 4) * 9).alias("freight"),
    )
    rollup = base.groupBy("order_id", "seller_id").agg(
        F.round(F.sum("item"), 2).alias("order_seller_item_value"),
        F.round(F.sum("freight"), 2).alias("order_seller_freight_value"),
    )
    number = F.col("order_id").cast("int")
    frame = rollup.select(
        "*",
        F.concat(F.lit("Z"), F.expr("cast(substr(seller_id, 2) AS int) % 3")).alias("seller_state"),
        F.when(number % 11 == 0, None).otherwise(F.concat(F.lit("C"), number % 4)).alias("customer_state"),
        F.when(number % 13 == 1, None).otherwise((number * 7) % 23 - 9).alias("delivery_delta_days"),
        F.when(number % 5 == 1, None).otherwise(number % 9).alias("purchase_to_delivery_days"),
        F.add_months(F.lit(dt.date(2022, 1, 1)), number % 3).alias("order_purchase_month"),
    )
    return spark.createDataFrame(frame.collect(), frame.schema)


def plain_corridors(rows, keys):
    known = rows.filter("delivery_delta_days IS NOT NULL")
    for k in keys[1:]:
        known = known.filter(F.col(k).isNotNull())
    return known.groupBy(*keys).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("seller_id").alias("active_sellers"),
        F.avg("delivery_delta_days").alias("avg_delivery_delta_days"),
        F.percentile_approx("delivery_delta_days", 0.5).alias("median_delivery_delta_days"),
        F.round(F.avg("purchase_to_delivery_days"), 9).alias("p2d"),
        F.round(F.avg("order_seller_freight_value"), 9).alias("freight"),
        F.avg(F.when(F.col("delivery_delta_days") > 0, 1.0).otherwise(0.0)).alias("late_delivery_rate"),
        F.avg(F.when(F.col("delivery_delta_days") > 7, 1.0).otherwise(0.0)).alias("severe_delay_rate"),
    )


def test_seller_side_equals_the_plain_distinct_form(spark):
    rows = facts(spark)
    keys = ["order_purchase_month", "seller_state", "customer_state"]
    mart = delivery.delivery_corridor_month(rows)
    mine = mart.select(
        *keys,
        "total_orders",
        "active_sellers",
        "avg_delivery_delta_days",
        "median_delivery_delta_days",
        F.round("avg_purchase_to_delivery_days", 9),
        F.round("avg_freight_value", 9),
        "late_delivery_rate",
        "severe_delay_rate",
    )
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, plain_corridors(rows, keys).collect()))
    rank = F.dense_rank().over(Window.partitionBy("order_purchase_month").orderBy(F.desc("avg_delivery_delta_days")))
    ranked = mart.withColumn("again", rank)
    assert ranked.filter("again <> corridor_delay_rank_in_month").count() == 0


def test_seller_states_roll_up_from_corridors(spark):
    rows = facts(spark).filter("customer_state IS NOT NULL")
    states = {
        (r.order_purchase_month, r.seller_state): r.total_orders for r in delivery.delivery_seller_state_month(rows).collect()
    }
    rolled = delivery.delivery_corridor_month(rows).groupBy("order_purchase_month", "seller_state").sum("total_orders")
    assert states == {(r[0], r[1]): r[2] for r in rolled.collect()}


def test_order_marts_equal_the_plain_form(spark):
    orders = facts(spark).dropDuplicates(["order_id"]).select(
        "order_id",
        "customer_state",
        "order_purchase_month",
        "delivery_delta_days",
        "purchase_to_delivery_days",
        F.col("purchase_to_delivery_days").alias("carrier_to_customer_days"),
        F.col("purchase_to_delivery_days").alias("estimated_lead_time_days"),
    )
    known = orders.filter("delivery_delta_days IS NOT NULL AND customer_state IS NOT NULL")
    plain = known.groupBy("customer_state").agg(
        F.count("order_id"), F.avg("delivery_delta_days"), F.percentile_approx("delivery_delta_days", 0.5)
    )
    spots = delivery.delivery_hotspots(orders).select(
        "customer_state", "total_delivered_orders", "avg_delivery_delta_days", "median_delivery_delta_days"
    )
    assert sorted(map(tuple, spots.collect())) == sorted(map(tuple, plain.collect()))
    (total,) = delivery.delivery_exec_summary(orders).collect()
    assert total.total_delivered_orders == orders.filter("delivery_delta_days IS NOT NULL").count()
    assert total.late_delivery_rate + total.on_time_or_early_rate == 1.0


def test_summary_of_nothing_is_one_row(spark):
    empty = facts(spark, n=30).limit(0).selectExpr(
        "*", "purchase_to_delivery_days AS carrier_to_customer_days", "purchase_to_delivery_days AS estimated_lead_time_days"
    )
    (row,) = delivery.delivery_exec_summary(empty).collect()
    assert (row.total_delivered_orders, row.avg_delivery_delta_days, row.median_delivery_delta_days) == (0, None, None)
