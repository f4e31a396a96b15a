"""Behaviour of the revenue tables and marts on small inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom.plans import conform, revenue

PAYMENTS = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"
ORDERS = "order_id string, customer_id string, order_status string, order_purchase_timestamp string"


def payments(spark, *rows):
    return spark.createDataFrame(rows, PAYMENTS)


def orders(spark, *rows):
    return spark.createDataFrame(rows, ORDERS)


def items(spark, *rows):
    schema = "order_id string, order_item_id string, product_id string, seller_id string, price double, freight_value double"
    return spark.createDataFrame(rows, schema)


def order_fact(spark, *rows):
    """(order, month or None, revenue, recognised, state, customer, payment type, installments)."""
    schema = (
        "order_id string, order_purchase_date date, order_purchase_month date, revenue_total double, "
        "is_revenue_recognised int, customer_state string, customer_unique_id string, "
        "primary_payment_type string, installments_max int"
    )
    full = []
    for order, day, amount, *rest in rows:
        flag, state, customer, kind, inst = (list(rest) + [1, "SP", "c1", "credit_card", 1][len(rest) :])[:5]
        full.append((order, day, day and day.replace(day=1), amount, flag, state, customer, kind, inst))
    return spark.createDataFrame(full, schema)


def by(df, key):
    return {row[key]: row for row in df.collect()}


def test_payment_cleaning(spark):
    """Only payments of an order with a number of at least 0 stay; types are trimmed and lower-cased."""
    given = [("a7", 4, "\tVoucher", 0, 0.0), ("a7", 5, "debit_CARD", 2, -0.01), ("b2", 1, "Boleto ", 9, 12.34), (None, 1, "voucher", 1, 7.5)]
    raw = payments(spark, *given, ("c1", 1, "voucher", 1, None), ("c2", 1, "voucher", 1, float("nan")))
    kept = {(r.order_id, r.payment_sequential): r for r in conform.payments_clean(raw).collect()}
    assert set(kept) == {("a7", 4), ("b2", 1)}
    assert kept["b2", 1].payment_type == "boleto" and kept["b2", 1].payment_value == 12.34


def test_malformed_values_become_null_and_drop(spark):
    raw = spark.createDataFrame(
        [("o1", "1", "boleto", "x", "12.5"), ("o2", "1", "boleto", "1", "abc")],
        "order_id string, payment_sequential string, payment_type string, payment_installments string, payment_value string",
    )
    (row,) = conform.payments_clean(raw).collect()
    assert (row.order_id, row.payment_installments, row.payment_value) == ("o1", None, 12.5)


def test_payment_rollup(spark):
    """Per order: total, number, most installments, types in order, and the type of the largest payment."""
    given = [("x", n, kind, inst, paid) for n, kind, inst, paid in ((1, "voucher", 2, 11.11), (2, "debit_card", 7, 0.5), (3, "voucher", 1, 3.39))]
    lone = ("y", 1, "not_defined", 4, 0.0)
    middle = [("z", n, kind, 1, paid) for n, kind, paid in ((1, "boleto", 6.25), (2, "debit_card", 19.0), (3, "credit_card", 18.99))]
    got = by(conform.payments_per_order(conform.payments_clean(payments(spark, *given, lone, *middle))), "order_id")
    x = got["x"]
    assert (x.total_payment_value, x.n_payments, x.installments_max) == (15.0, 3, 7)
    assert (x.payment_type_mix, x.primary_payment_type) == ("debit_card,voucher", "voucher")
    assert (got["y"].total_payment_value, got["y"].payment_type_mix) == (0.0, "not_defined")
    assert got["z"].primary_payment_type == "debit_card" and got["z"].total_payment_value == 44.24


def test_primary_payment_is_largest_row_not_largest_type(spark):
    rows = [("o", 1, "voucher", 1, 60.0), ("o", 2, "boleto", 1, 40.0), ("o", 3, "boleto", 1, 40.0)]
    (row,) = conform.payments_per_order(payments(spark, *rows)).collect()
    assert row.primary_payment_type == "voucher"


@pytest.mark.parametrize("flip", [False, True])
def test_equal_payments_take_the_lower_sequence(spark, flip):
    rows = [("o", 2, "voucher", 1, 40.0), ("o", 1, "boleto", 1, 40.0)]
    (row,) = conform.payments_per_order(payments(spark, *(rows[::-1] if flip else rows))).collect()
    assert row.primary_payment_type == "boleto"


def test_sums_are_exact(spark):
    rows = [("o", i, "boleto", 1, 0.1) for i in range(1000)]
    (row,) = conform.payments_per_order(payments(spark, *rows)).collect()
    assert row.total_payment_value == 100.0


def test_catalog_translates_falls_back_and_defaults(spark):
    sizes = "product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int"
    products = spark.createDataFrame(
        [("p1", "beleza", 1, 1, 1, 1), ("p2", "raro", 1, 1, 1, 1), ("p3", None, 1, 1, 1, 1), (None, "raro", 1, 1, 1, 1)],
        f"product_id string, product_category_name string, {sizes}",
    )
    names = spark.createDataFrame(
        [("beleza", "beauty")], "product_category_name string, product_category_name_english string"
    )
    got = by(conform.product_catalog(products, names), "product_id")
    assert {k: v.product_category_en for k, v in got.items()} == {"p1": "beauty", "p2": "raro", "p3": "unknown"}


def test_items_and_order_sums(spark):
    """Items without a known, non-negative price and freight go; an unknown product has no category."""
    sold = [("q", str(n), product, "s3", price, freight) for n, product, price, freight in ((3, "lamp", 7.77, 0.0), (4, "none", 0.23, 1.5), (5, "lamp", 31.0, 2.25))]
    broken = [("q", "6", "lamp", "s3", 4.0, -0.5), ("r", "1", "lamp", "s3", None, 1.0)]
    catalog = spark.createDataFrame([("lamp", "lighting")], "product_id string, product_category_en string")
    priced = conform.order_items_revenue(items(spark, *sold, *broken), catalog)
    got = {k: (v.item_total_revenue, v.product_category_en) for k, v in by(priced, "order_item_id").items()}
    assert got == {3: (7.77, "lighting"), 4: (1.73, "unknown"), 5: (33.25, "lighting")}
    (row,) = conform.items_per_order(priced).collect()
    assert (row.order_id, row.n_items, row.gross_revenue, row.freight_total, row.revenue_total) == ("q", 3, 39.0, 3.75, 42.75)


def _fact(spark, *order_rows, paid=()):
    sold = [(r[0], "1", "p", "s", 100.0, 10.0) for r in order_rows if r[0] != "itemless"]
    return conform.orders_revenue(
        orders(spark, *order_rows),
        conform.items_per_order(conform.priced_items(items(spark, *sold))),
        conform.payments_per_order(payments(spark, *paid)),
        None,
    )


def test_order_fact_drops_ghost_payments_and_itemless_orders(spark):
    fact = _fact(
        spark,
        ("o1", "c1", "delivered", "2022-01-05 10:00:00"),
        ("itemless", "c1", "delivered", "2022-01-05 10:00:00"),
        paid=[("o1", 1, "boleto", 1, 105.0), ("ghost", 1, "boleto", 1, 9.0)],
    )
    (row,) = fact.collect()
    assert (row.order_id, row.payment_reconciliation_delta, row.order_purchase_month) == ("o1", 5.0, dt.date(2022, 1, 1))
    assert row.customer_state is None


def test_recognised_flag(spark):
    states = {"o1": " Delivered ", "o2": "canceled", "o3": "UNAVAILABLE", "o4": None, "o5": "odd"}
    fact = _fact(spark, *[(k, "c", v, "2022-01-05 10:00:00") for k, v in states.items()])
    got = by(fact, "order_id")
    assert {k: v.is_revenue_recognised for k, v in got.items()} == {"o1": 1, "o2": 0, "o3": 0, "o4": 1, "o5": 1}
    assert got["o1"].payment_reconciliation_delta == 110.0


def _month(year, month):
    return dt.date(year, month, 15)


def test_growth_survives_gap_months(spark):
    fact = order_fact(
        spark,
        ("a", _month(2022, 1), 100.0),
        ("b", _month(2022, 2), 200.0),
        ("c", _month(2023, 1), 150.0),
        ("d", _month(2023, 2), 400.0),
        ("e", None, 999.0),
        ("f", _month(2023, 2), 5000.0, 0),
    )
    got = by(revenue.revenue_monthly(fact), "order_purchase_month")
    jan22, feb22, jan23, feb23 = (got[dt.date(y, m, 1)] for y in (2022, 2023) for m in (1, 2))
    assert len(got) == 4
    assert (jan22.revenue_mom_pct, feb22.revenue_mom_pct) == (None, 100.0)
    assert (jan23.revenue_mom_pct, jan23.revenue_yoy_pct, feb23.revenue_yoy_pct) == (None, 50.0, 100.0)


def test_rolling_sums_by_row_and_by_calendar(spark):
    from martloom.operators.periods import with_rolling_sum

    fact = order_fact(spark, *[(str(i), _month(2022, m), 100.0 * i) for i, m in enumerate((1, 2, 3, 4), 1)])
    rows = sorted(revenue.revenue_monthly(fact).collect())
    assert [r.revenue_rolling_3m for r in rows] == [100.0, 300.0, 600.0, 900.0]
    gap = spark.createDataFrame([(dt.date(2022, 1, 1), 1.0), (dt.date(2022, 6, 1), 2.0)], "m date, x double")
    by_row = with_rolling_sum(gap, "m", "x", {"r": 3}).orderBy("m").collect()
    by_month = with_rolling_sum(gap, "m", "x", {"r": 3}, calendar=True).orderBy("m").collect()
    assert [r.r for r in by_row] == [1.0, 3.0]
    assert [r.r for r in by_month] == [1.0, 2.0]


def test_category_shares_and_ranks(spark):
    fact = order_fact(spark, ("a", _month(2022, 1), 100.0), ("b", _month(2022, 1), 50.0), ("x", _month(2022, 1), 50.0, 0))
    sold = spark.createDataFrame(
        [("a", "toys", 60.0), ("a", "toys", 10.0), ("a", "books", 30.0), ("b", "books", 50.0), ("x", "toys", 50.0)],
        "order_id string, product_category_en string, item_total_revenue double",
    )
    got = by(revenue.revenue_by_category_month(fact, conform.category_per_order(sold)), "product_category_en")
    toys, books = got["toys"], got["books"]
    assert (toys.total_orders, toys.total_revenue, toys.category_rank_in_month) == (1, 70.0, 2)
    assert (books.total_orders, books.total_revenue, books.category_rank_in_month) == (2, 80.0, 1)
    assert toys.revenue_share_of_month + books.revenue_share_of_month == pytest.approx(1.0)


def test_state_mart(spark):
    fact = order_fact(
        spark,
        ("a", _month(2022, 1), 400.0, 1, "SP", "u1"),
        ("b", _month(2022, 1), 200.0, 1, "SP", "u1"),
        ("c", _month(2022, 1), 400.0, 1, "RJ", None),
        ("d", _month(2022, 1), 999.0, 1, None, "u2"),
    )
    got = by(revenue.revenue_by_state_month(fact), "customer_state")
    sp, rj = got["SP"], got["RJ"]
    assert (sp.total_orders, sp.total_customers, sp.aov, sp.revenue_share_of_month, sp.state_rank_in_month) == (2, 1, 300.0, 0.6, 1)
    assert (rj.total_orders, rj.total_customers, rj.revenue_share_of_month, rj.state_rank_in_month) == (1, 0, 0.4, 2)
    assert set(got) == {"SP", "RJ"}


def test_payment_type_mart(spark):
    fact = order_fact(
        spark,
        ("a", _month(2022, 1), 750.0, 1, "SP", "u", "credit_card", 4),
        ("b", _month(2022, 1), 250.0, 1, "SP", "u", "boleto", 1),
        ("c", _month(2022, 1), 250.0, 1, "SP", "u", None, 1),
    )
    got = by(revenue.revenue_by_payment_type_month(fact), "primary_payment_type")
    assert {k: (v.share_of_month_revenue, v.avg_installments) for k, v in got.items()} == {
        "credit_card": (0.75, 4.0),
        "boleto": (0.25, 1.0),
    }


def _summary(fact, *sold):
    spark = fact.sparkSession
    categories = spark.createDataFrame(
        list(sold), "order_id string, product_category_en string, item_total_revenue double"
    )
    return revenue.revenue_exec_summary(fact, fact, conform.category_per_order(categories))


def test_exec_summary(spark):
    fact = order_fact(
        spark,
        ("a", dt.date(2022, 5, 1), 700.0, 1, "SP", "u", "credit_card"),
        ("b", dt.date(2022, 5, 2), 300.0, 1, "RJ", "v", "boleto"),
    )
    (row,) = _summary(fact, ("a", "electronics", 700.0), ("b", "beauty", 300.0)).collect()
    assert (row.total_orders, row.total_revenue, row.aov) == (2, 1000.0, 500.0)
    assert (row.top_category, row.top_customer_state, row.top_payment_type) == ("electronics", "SP", "credit_card")
    assert row.kpi_generated_ts is not None


def test_exec_summary_periods_are_365_days(spark):
    newest = dt.date(2022, 12, 31)
    ages = {0: 1.0, 364: 2.0, 365: 4.0, 729: 8.0, 730: 16.0}
    fact = order_fact(spark, *[(str(a), newest - dt.timedelta(days=a), v) for a, v in ages.items()], ("n", None, 32.0))
    (row,) = _summary(fact).collect()
    assert (row.total_revenue, row.last_12m_revenue, row.prior_12m_revenue) == (63.0, 3.0, 12.0)
    assert row.yoy_growth_pct == -75.0


def test_exec_summary_on_empty_input(spark):
    (row,) = _summary(order_fact(spark)).collect()
    assert (row.total_orders, row.total_revenue, row.last_12m_revenue, row.prior_12m_revenue) == (0, None, 0.0, 0.0)
    assert (row.aov, row.yoy_growth_pct, row.top_category, row.top_customer_state) == (None, None, None, None)


def test_peak_month_prefers_the_later_of_equals(spark):
    fact = order_fact(spark, ("a", _month(2022, 1), 10.0), ("b", _month(2022, 3), 10.0), ("c", _month(2022, 2), 5.0))
    (row,) = revenue.peak_month(revenue.revenue_monthly(fact)).collect()
    assert (row.peak_month, row.peak_month_revenue) == (dt.date(2022, 3, 1), 10.0)


def test_types_that_are_not_on_the_list(spark):
    """Against the plain aggregates, with unknown, missing and known types in every order of value and sequence."""
    import itertools
    import random

    from martloom.operators.rollup import distinct_list, heaviest

    draw = random.Random(2)
    types = ["credit_card", "boleto", "voucher", "debit_card", "not_defined", "pix", "aaa", "cash", "zzz", None, ""]
    rows = [
        (str(order), draw.choice([1, 2, 2, 3, None, -4, 2**31 - 1, -(2**31)]), draw.choice(types), draw.choice([1, 3]), draw.choice([0.0, 1.5, 1.5, 99999999.25]))
        for order, _ in itertools.product(range(400), range(5))
    ]
    df = spark.createDataFrame(rows, "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    plain = df.groupBy("order_id").agg(
        distinct_list("payment_type").alias("payment_type_mix"),
        heaviest("payment_type", "payment_value", -F.col("payment_sequential").cast("bigint")).alias("primary_payment_type"),
    )
    columns = ["order_id", "payment_type_mix", "primary_payment_type"]
    got = conform.payments_per_order(df).select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.select(*columns).collect()))
