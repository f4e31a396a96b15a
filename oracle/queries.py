"""The SQL each named query must agree with."""

from __future__ import annotations

from oracle.tables import with_tables

_AS_DOUBLE = {
    "payments_clean": "payment_value",
    "payments_order_agg": "total_payment_value",
    "order_items_revenue": "price, freight_value, item_total_revenue",
    "items_per_order": "gross_revenue, freight_total, revenue_total",
    "orders_revenue": "gross_revenue, freight_total, revenue_total, total_payment_value, payment_reconciliation_delta",
    "rollup": "order_seller_item_value, order_seller_freight_value",
    "totals": "total_price",
    "segment": "total_price_unique_cust",
}


def _doubles(table: str, columns: str, extra: str = "") -> str:
    """All columns of a table with the listed money columns as DOUBLE."""
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns.split(", "))
    return f"SELECT * REPLACE ({casts}) FROM {table} {extra}"


def _count(name: str, table: str, where: str = "TRUE") -> str:
    return f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {table} WHERE {where}"


def _counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(_count(name, table) for name, table in tables.items())


def _rule(table: str, source: str, name: str, action: str, predicate: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS rule_name, '{action}' AS action, "
        f"CAST(COUNT(*) FILTER (WHERE {predicate}) AS BIGINT) AS passed, "
        f"CAST(COUNT(*) - COUNT(*) FILTER (WHERE {predicate}) AS BIGINT) AS violations FROM {source}"
    )


def _grain(name: str, table: str, keys: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, CAST(SUM(n) AS BIGINT) AS row_count, CAST(COUNT(*) AS BIGINT) AS unique_keys, "
        f"CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS repeated_keys "
        f"FROM (SELECT {keys}, COUNT(*) AS n FROM {table} GROUP BY {keys})"
    )


_SOURCES = [
    "raw_orders",
    "raw_order_items",
    "raw_order_payments",
    "raw_products",
    "raw_product_names_translation",
    "raw_customers",
    "raw_sellers",
    "raw_geolocation",
    "raw_order_reviews",
]
_STATUSES = "('created','approved','invoiced','processing','shipped','delivered','unavailable','canceled')"
_TYPES = "('credit_card','boleto','voucher','debit_card','not_defined')"

# columns of the sources that are no text; decimals are DOUBLE in files
_FILE_TYPES = {
    "raw_order_items": "shipping_limit_date, price, freight_value",
    "raw_order_payments": "payment_sequential, payment_installments, payment_value",
    "raw_products": "product_weight_g, product_length_cm, product_height_cm, product_width_cm",
    "raw_customers": "customer_zip_code_prefix",
    "raw_orders": "order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, "
    "order_delivered_customer_date, order_estimated_delivery_date",
    "raw_order_reviews": "review_score, review_creation_date, review_answer_timestamp",
}
_AMOUNTS = ("price", "freight_value", "payment_value")


def _as_text(name: str) -> str:
    """A source as the text its file holds."""
    names = [c for c in _FILE_TYPES.get(name, "").split(", ") if c]
    casts = [f"CAST({f'CAST({c} AS DOUBLE)' if c in _AMOUNTS else c} AS VARCHAR) AS {c}" for c in names]
    replaced = f"REPLACE ({', '.join(casts)})" if casts else ""
    return f"SELECT * {replaced} FROM {'landed_customers' if name == 'raw_customers' else name}"


def _step(step: str, where: str = "TRUE") -> str:
    return f"""SELECT '{step}' AS step, CAST(COUNT(*) AS BIGINT) AS row_count, CAST(SUM(payment_value) AS DOUBLE) AS total_value
FROM pay_clean WHERE {where}"""


# the two refused writes leave what the first one wrote
_STEPS = " UNION ALL ".join(
    [*[_step(s) for s in ("first", "stopped_by_rule", "refused_by_audit")], _step("from_itself", "payment_sequential = 1")]
)

_PAY_TYPED = """(SELECT order_id, lower(trim(payment_type)) AS payment_type, payment_installments, payment_value
                 FROM raw_order_payments)"""
_ITEM_TYPED = """(SELECT i.*, c.product_category_en FROM raw_order_items i
                  LEFT JOIN catalog c ON i.product_id = c.product_id)"""
_GEO_TYPED = """(SELECT TRY_CAST(geolocation_zip_code_prefix AS INTEGER) AS zip_code_prefix,
                        upper(trim(geolocation_state)) AS geo_state FROM raw_geolocation)"""
_ORDER_SELLER = "(SELECT order_id, seller_id FROM raw_order_items GROUP BY order_id, seller_id)"
_DELIVERED = "(SELECT * FROM raw_orders WHERE lower(trim(order_status)) = 'delivered')"
_RULES = [
    ("payments_clean", _PAY_TYPED, "order_id_not_null", "fail", "order_id IS NOT NULL"),
    ("payments_clean", _PAY_TYPED, "payment_value_not_negative", "drop", "payment_value >= 0"),
    ("payments_clean", _PAY_TYPED, "valid_payment_type", "warn", f"payment_type IN {_TYPES}"),
    ("payments_clean", _PAY_TYPED, "payment_installments_not_negative", "warn", "payment_installments >= 0"),
    ("product_catalog", "catalog", "product_id_not_null", "drop", "product_id IS NOT NULL"),
    ("product_catalog", "catalog", "product_category_en_not_null", "warn", "product_category_en IS NOT NULL"),
    ("order_items_revenue", _ITEM_TYPED, "order_id_not_null", "fail", "order_id IS NOT NULL"),
    ("order_items_revenue", _ITEM_TYPED, "price_not_negative", "drop", "price >= 0"),
    ("order_items_revenue", _ITEM_TYPED, "freight_value_not_negative", "drop", "freight_value >= 0"),
    (
        "order_items_revenue",
        _ITEM_TYPED,
        "product_category_en_not_null",
        "warn",
        "product_category_en IS NOT NULL",
    ),
    ("orders_revenue", "ord_rev", "order_id_not_null", "fail", "order_id IS NOT NULL"),
    ("orders_revenue", "ord_rev", "revenue_total_not_negative", "drop", "revenue_total >= 0"),
    (
        "orders_revenue",
        "ord_rev",
        "payment_reconciles",
        "warn",
        "abs(payment_reconciliation_delta) / greatest(revenue_total, 1) < 0.05",
    ),
    ("orders_revenue", "ord_rev", "valid_order_status", "warn", f"order_status IN {_STATUSES}"),
    ("payments_order_agg", "pay_order", "order_id_not_null", "fail", "order_id IS NOT NULL"),
    ("payments_order_agg", "pay_order", "total_payment_value_not_negative", "fail", "total_payment_value >= 0"),
    ("customer_geo", "raw_customers", "customer_id_not_null", "drop", "customer_id IS NOT NULL"),
    ("seller_geo", "raw_sellers", "seller_id_not_null", "drop", "seller_id IS NOT NULL"),
    ("order_seller_rollup", _ORDER_SELLER, "order_id_not_null", "drop", "order_id IS NOT NULL"),
    ("order_seller_rollup", _ORDER_SELLER, "seller_id_not_null", "drop", "seller_id IS NOT NULL"),
    ("delivery_order_item", "deliv_item", "order_id_not_null", "drop", "order_id IS NOT NULL"),
    ("delivery_order_item", "deliv_item", "seller_id_not_null", "warn", "seller_id IS NOT NULL"),
    ("order_totals", "ord_total", "order_id_not_null", "fail", "order_id IS NOT NULL"),
    ("last_12m_orders", _DELIVERED, "order_purchase_timestamp_not_null", "fail", "order_purchase_timestamp IS NOT NULL"),
    ("customer_volume_segment", "cust_volume", "customer_unique_id_not_null", "fail", "customer_unique_id IS NOT NULL"),
    ("revenue_monthly", "mart_monthly", "total_revenue_not_negative", "warn", "total_revenue >= 0"),
    ("revenue_by_category_month", "mart_category", "product_category_en_not_null", "warn", "product_category_en IS NOT NULL"),
    ("revenue_by_state_month", "mart_state", "customer_state_not_null", "warn", "customer_state IS NOT NULL"),
    ("revenue_by_payment_type_month", "mart_payment", "primary_payment_type_not_null", "warn", "primary_payment_type IS NOT NULL"),
    (
        "customer_segmentation",
        "cust_seg",
        "valid_persona",
        "fail",
        "customer_persona IN ('VIP', 'Core Customer', 'Casual Buyer')",
    ),
    ("geo_zip_prefix", _GEO_TYPED, "zip_code_prefix_not_null", "drop", "zip_code_prefix IS NOT NULL"),
    ("geo_zip_prefix", _GEO_TYPED, "valid_state", "warn", "length(geo_state) = 2"),
    ("delivery_order", "std_ord", "order_id_not_null", "drop", "order_id IS NOT NULL"),
    ("delivery_order", "std_ord", "customer_id_not_null", "warn", "customer_id IS NOT NULL"),
    ("delivery_order", "std_ord", "valid_order_status", "warn", f"order_status IN {_STATUSES}"),
]

_RAW_VIOLATIONS = {
    "raw_customers": "(CASE WHEN customer_zip_code_prefix > 0 THEN 0 ELSE 1 END + CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END)"
}


def _landed(name: str) -> str:
    """The table as delivered."""
    return "landed_customers" if name == "raw_customers" else name


_ALL_LANDED = {name: _landed(name) for name in _SOURCES}


def _loaded(name: str) -> str:
    bad = _RAW_VIOLATIONS.get(name, "0")
    return (
        f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows_read, "
        f"CAST(COUNT(*) FILTER (WHERE {bad} = 0) AS BIGINT) AS rows_kept, CAST(SUM({bad}) AS BIGINT) AS violations FROM {_landed(name)}"
    )


def _digest_below(fraction: float) -> str:
    return f"CAST('0x' || substr(md5(order_id), 1, 15) AS BIGINT) < {int(fraction * 16**15)}"


def _sampled_monthly(fraction: float) -> str:
    """The monthly mart over the orders whose digest falls into the first part of its range."""
    kept = f"(SELECT * FROM ord_rev WHERE {_digest_below(fraction)} AND is_revenue_recognised = 1)"
    base = f"""(SELECT order_purchase_month, CAST(COUNT(*) AS BIGINT) AS total_orders, SUM(revenue_total) AS revenue
                FROM {kept} WHERE order_purchase_month IS NOT NULL GROUP BY order_purchase_month)"""
    rolling = "CAST(SUM(b.revenue) OVER (ORDER BY b.order_purchase_month ROWS BETWEEN {} PRECEDING AND CURRENT ROW) AS DOUBLE)"

    def change(alias: str) -> str:
        before = f"CAST({alias}.revenue AS DOUBLE)"
        return f"CASE WHEN {alias}.revenue > 0 THEN (CAST(b.revenue AS DOUBLE) - {before}) / {before} * 100.0 END"

    return f"""
SELECT b.order_purchase_month, b.total_orders, CAST(b.revenue AS DOUBLE) AS total_revenue,
       CAST(b.revenue AS DOUBLE) / b.total_orders AS aov,
       {change("m")} AS revenue_mom_pct, {change("y")} AS revenue_yoy_pct,
       {rolling.format(2)} AS revenue_rolling_3m, {rolling.format(5)} AS revenue_rolling_6m
FROM {base} b
LEFT JOIN {base} m ON b.order_purchase_month = CAST(m.order_purchase_month + INTERVAL 1 MONTH AS DATE)
LEFT JOIN {base} y ON b.order_purchase_month = CAST(y.order_purchase_month + INTERVAL 12 MONTH AS DATE)"""


def _top(table: str, label: str) -> str:
    return f"(SELECT {label} FROM {table} GROUP BY {label} ORDER BY SUM(revenue) DESC, {label} DESC LIMIT 1)"


_LISTED = """SELECT order_purchase_month, total_orders, ROUND(total_revenue, 2) AS total_revenue, ROUND(aov, 2) AS aov,
       ROUND(revenue_mom_pct, 2) AS revenue_mom_pct, ROUND(revenue_yoy_pct, 2) AS revenue_yoy_pct,
       ROUND(revenue_rolling_3m, 2) AS revenue_rolling_3m, ROUND(revenue_rolling_6m, 2) AS revenue_rolling_6m
FROM mart_monthly"""

def _mean(value: str) -> str:
    """A mean in whole millionths, rounded half up to two digits."""
    total = f"SUM(CAST(round_even({value} * 1000000, 0) AS HUGEINT))"
    return f"CAST((CAST({total} AS HUGEINT) * 2 + COUNT({value}) * 10000) // (COUNT({value}) * 20000) AS DOUBLE) / 100.0"


_STATE_TOTALS = f"""SELECT customer_state, ROUND(SUM(total_revenue), 2) AS total_revenue,
       CAST(SUM(total_orders) AS BIGINT) AS total_orders, {_mean("aov")} AS avg_aov
FROM mart_state GROUP BY customer_state"""


def _segments(persona: str, medium_cut: float = 0.40) -> str:
    value = (
        f"CASE WHEN spend_percentile >= 0.85 THEN 'High' WHEN spend_percentile >= {medium_cut} THEN 'Medium' ELSE 'Low' END"
    )
    return f"""SELECT *, CASE {persona} ELSE 'Unassigned' END AS customer_persona
FROM (SELECT v.customer_unique_id, CAST(v.total_price_unique_cust AS DOUBLE) AS total_price_unique_cust,
             v.spend_percentile, v.spend_percentile_100, {value} AS value_segment, q.order_volume, q.volume_segment
      FROM cust_value v JOIN cust_volume q ON v.customer_unique_id = q.customer_unique_id)"""


_SIX = """
 WHEN value_segment = 'High' AND volume_segment = 'High' THEN 'VIP Loyalists'
 WHEN value_segment = 'High' THEN 'Premium One-Offs'
 WHEN value_segment = 'Medium' AND volume_segment = 'High' THEN 'Frequent Core Shoppers'
 WHEN value_segment = 'Medium' AND volume_segment = 'Low' THEN 'Casual Core Shoppers'
 WHEN value_segment = 'Low' AND volume_segment = 'High' THEN 'Bargain Hunters'
 WHEN value_segment = 'Low' AND volume_segment = 'Low' THEN 'Occasional Low-Value'"""
_TIERS = """
 WHEN value_segment = 'High' AND volume_segment IN ('High', 'Low') THEN 'High Value Customer'
 WHEN value_segment = 'Medium' THEN 'Medium Value Customer'
 WHEN value_segment = 'Low' AND volume_segment IN ('High', 'Low') THEN 'Low Value Customer'"""

_MARTS = {
    "payments_clean": "pay_clean",
    "payments_order_agg": "pay_order",
    "product_catalog": "catalog",
    "order_items_revenue": "item_rev",
    "items_per_order": "item_order",
    "orders_revenue": "ord_rev",
    "geo_zip_prefix": "geo",
    "customer_geo": "cust_geo",
    "seller_geo": "sell_geo",
    "delivery_order": "deliv",
    "order_seller_rollup": "seller_rollup",
    "delivery_order_item": "deliv_item",
    "order_totals": "ord_total",
    "last_12m_orders": "recent",
    "customer_value_segment": "cust_value",
    "customer_volume_segment": "cust_volume",
    "revenue_monthly": "mart_monthly",
    "revenue_by_category_month": "mart_category",
    "revenue_by_state_month": "mart_state",
    "revenue_by_payment_type_month": "mart_payment",
    "delivery_state_month": "mart_delivery_state",
    "delivery_seller_state_month": "mart_delivery_seller",
    "delivery_corridor_month": "mart_corridor",
    "delivery_hotspots": "mart_hotspots",
    "customer_segmentation": "cust_seg",
}
_SHARES = {
    "revenue_by_category_month": ("mart_category", "revenue_share_of_month"),
    "revenue_by_state_month": ("mart_state", "revenue_share_of_month"),
    "revenue_by_payment_type_month": ("mart_payment", "share_of_month_revenue"),
}


def _share_sums(table: str, share: str) -> str:
    return f"""(SELECT order_purchase_month, ROUND(SUM({share}), 2) AS s FROM {table} GROUP BY order_purchase_month)"""


def _check(name: str, test: str, expected: float, actual: str) -> str:
    sql_test = "=" if test == "==" else test
    return f"""SELECT check_name, test, expected, actual,
       CASE WHEN actual {sql_test} expected THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT '{name}' AS check_name, '{test}' AS test, CAST({expected} AS DOUBLE) AS expected,
             CAST(({actual}) AS DOUBLE) AS actual)"""


_UNKNOWN_PCT = "ROUND(100.0 * COUNT(*) FILTER (WHERE product_category_en = 'unknown') / COUNT(*), 2)"

_CHECKS = [
    ("no_negative_payments", "==", 0, "SELECT COUNT(*) FROM pay_clean WHERE payment_value < 0"),
    ("payments_rollup_is_order_grain", "==", 0, "SELECT COUNT(*) - COUNT(DISTINCT order_id) FROM pay_order"),
    (
        "no_ghost_orders_in_fact",
        "==",
        0,
        "SELECT COUNT(*) FROM ord_rev WHERE order_id NOT IN (SELECT order_id FROM raw_orders)",
    ),
    ("unknown_category_under_5pct", "<", 5.0, f"SELECT {_UNKNOWN_PCT} FROM item_rev"),
    *[
        (
            f"{label}_share_sums_to_one",
            "==",
            0,
            f"SELECT COUNT(*) FROM {_share_sums(table, share)} WHERE s <> 1.0",
        )
        for label, (table, share) in zip(("category", "state", "payment_type"), _SHARES.values())
    ],
    ("exec_summary_is_single_row", "==", 1, "SELECT COUNT(*) FROM summary_totals"),
]

_NO_CUSTOMER = (
    _doubles("ord_rev", _AS_DOUBLE["orders_revenue"])
    .replace(
        "REPLACE (",
        "REPLACE (CAST(NULL AS VARCHAR) AS customer_unique_id, CAST(NULL AS VARCHAR) AS customer_state, "
        "CAST(NULL AS VARCHAR) AS customer_city_std, ",
    )
)

_EXEC_SUMMARY = f"""
SELECT *, CASE WHEN total_orders > 0 THEN total_revenue / total_orders END AS aov,
       CASE WHEN prior_12m_revenue > 0
            THEN (last_12m_revenue - prior_12m_revenue) / prior_12m_revenue * 100.0 END AS yoy_growth_pct,
       {_top("m_category", "product_category_en")} AS top_category,
       {_top("m_state", "customer_state")} AS top_customer_state,
       {_top("m_payment", "primary_payment_type")} AS top_payment_type
FROM summary_totals"""
_STAMP = ", TIMESTAMP '2024-01-01 00:00:00' AS kpi_generated_ts"

QUERIES: dict[str, str] = {
    "ingest_csv_roundtrip": " UNION ALL ".join(_loaded(name) for name in _SOURCES),
    "ingest_orders_csv": "SELECT * FROM raw_orders",
    "ingest_payments_csv": _doubles("raw_order_payments", "payment_value"),
    "ingest_multiline_csv": "SELECT * FROM raw_order_reviews",
    "ingest_lineage": " UNION ALL ".join(
        f"SELECT '{t}' AS landed_as, CAST(COUNT(*) AS BIGINT) AS row_count FROM {_landed(t)}"
        for t in (
            "raw_customers",
            "raw_geolocation",
            "raw_order_items",
            "raw_order_payments",
            "raw_order_reviews",
            "raw_orders",
            "raw_products",
            "raw_product_names_translation",
            "raw_sellers",
        )
    ),
    "ingest_folder_csv": " UNION ALL BY NAME ".join(_as_text(name) for name in _SOURCES),
    "overwrite_keeps_old": _STEPS,
    "sample_scaling": " UNION ALL ".join(
        f"SELECT CAST({f} AS DOUBLE) AS fraction, CAST(COUNT(*) AS BIGINT) AS row_count FROM raw_orders WHERE {_digest_below(f)}"
        for f in (0.5, 0.1)
    ),
    "customers_by_state_year": """SELECT customer_state, order_purchase_year,
       CAST(COUNT(DISTINCT customer_unique_id) AS BIGINT) AS customers, TRUE AS sketch_within_bound
FROM ord_rev WHERE is_revenue_recognised = 1 AND customer_state IS NOT NULL GROUP BY customer_state, order_purchase_year""",
    "freight_median_by_state": """SELECT seller_state, CAST(COUNT(*) AS BIGINT) AS order_sellers, TRUE AS sketch_within_bound
FROM deliv_item WHERE seller_state IS NOT NULL AND order_seller_freight_value IS NOT NULL GROUP BY seller_state""",
    "sample_by_key_half": _sampled_monthly(0.5),
    "sample_by_key_tenth": _sampled_monthly(0.1),
    "dq_warn_counts": " UNION ALL ".join(_rule(*r) for r in _RULES if r[3] == "warn"),
    "dq_report": " UNION ALL ".join(_rule(*r) for r in _RULES),
    "publish_report": " UNION ALL ".join(_rule(*r) for r in _RULES),
    "dq_drop": """SELECT order_id, payment_sequential, lower(trim(payment_type)) AS payment_type,
       payment_installments, CAST(payment_value AS DOUBLE) AS payment_value
FROM raw_order_payments WHERE payment_value >= 0""",
    "dq_all_or_drop": """SELECT * FROM landed_customers
WHERE customer_id IS NOT NULL AND customer_zip_code_prefix > 0""",
    "dq_fail": _doubles("pay_order", _AS_DOUBLE["payments_order_agg"]),
    "std_orders": "SELECT *, CAST(year(order_purchase_ts) AS INTEGER) AS order_purchase_year FROM std_ord",
    "payments_clean": _doubles("pay_clean", _AS_DOUBLE["payments_clean"]),
    "payments_order_agg": _doubles("pay_order", _AS_DOUBLE["payments_order_agg"]),
    "product_catalog": "SELECT * FROM catalog",
    "order_items_revenue": _doubles("item_rev", _AS_DOUBLE["order_items_revenue"]),
    "order_items_revenue_broadcast": _doubles("item_rev", _AS_DOUBLE["order_items_revenue"]),
    "items_per_order": _doubles("item_order", _AS_DOUBLE["items_per_order"]),
    "orders_revenue": _doubles("ord_rev", _AS_DOUBLE["orders_revenue"]),
    "orders_revenue_no_customers": _NO_CUSTOMER,
    "orders_revenue_item_grain": """
SELECT o.customer_id, o.order_id, o.order_status, o.order_purchase_ts,
       i.product_id, i.order_item_id, i.seller_id, CAST(i.price AS DOUBLE) AS price,
       CAST(i.freight_value AS DOUBLE) AS freight_value, i.product_category_en,
       CAST(i.item_total_revenue AS DOUBLE) AS item_total_revenue,
       CAST(p.total_payment_value AS DOUBLE) AS total_payment_value, p.n_payments, p.installments_max,
       p.payment_type_mix, p.primary_payment_type,
       c.customer_unique_id, c.customer_state, c.customer_city_std, o.order_purchase_date, o.order_purchase_month,
       CAST(year(o.order_purchase_ts) AS INTEGER) AS order_purchase_year,
       CAST(i.item_total_revenue - COALESCE(p.total_payment_value, 0) AS DOUBLE) AS payment_reconciliation_delta,
       CAST(CASE WHEN o.order_status IN ('canceled', 'unavailable') THEN 0 ELSE 1 END AS INTEGER)
         AS is_revenue_recognised
FROM std_ord o JOIN item_rev i ON o.order_id = i.order_id
LEFT JOIN pay_order p ON o.order_id = p.order_id
LEFT JOIN cust_geo c ON o.customer_id = c.customer_id""",
    "geo_zip_prefix": "SELECT * FROM geo",
    "customer_geo": "SELECT * FROM cust_geo",
    "seller_geo": "SELECT * FROM sell_geo",
    "delivery_order": "SELECT * FROM deliv",
    "order_seller_rollup": _doubles("seller_rollup", _AS_DOUBLE["rollup"]),
    "delivery_order_item": _doubles("deliv_item", _AS_DOUBLE["rollup"]),
    "order_totals": _doubles("ord_total", _AS_DOUBLE["totals"]),
    "last_12m_orders": _doubles("recent", _AS_DOUBLE["totals"]),
    "customer_value_segment": _doubles("cust_value", _AS_DOUBLE["segment"]),
    "customer_volume_segment": "SELECT * FROM cust_volume",
    "revenue_monthly": "SELECT * FROM mart_monthly",
    "revenue_by_category_month": "SELECT * FROM mart_category",
    "revenue_by_state_month": "SELECT * FROM mart_state",
    "revenue_by_payment_type_month": "SELECT * FROM mart_payment",
    "revenue_exec_summary": _EXEC_SUMMARY,
    "revenue_exec_summary_as_of": f"{_EXEC_SUMMARY.replace('FROM summary_totals', _STAMP + ' FROM summary_totals')}",
    "delivery_exec_summary_as_of": f"SELECT * {_STAMP} FROM mart_delivery_summary",
    "delivery_state_month": "SELECT * FROM mart_delivery_state",
    "delivery_seller_state_month": "SELECT * FROM mart_delivery_seller",
    "delivery_corridor_month": "SELECT * FROM mart_corridor",
    "delivery_hotspots": "SELECT * FROM mart_hotspots",
    "delivery_exec_summary": "SELECT * FROM mart_delivery_summary",
    "customer_segmentation": _doubles("cust_seg", _AS_DOUBLE["segment"]),
    "customer_payment_preference": """
SELECT customer_unique_id, MAX(CASE WHEN rn = 1 THEN payment_type END) AS preferred_payment_type,
       CAST(SUM(paid) AS DOUBLE) AS total_paid
FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id
               ORDER BY paid DESC, last_used DESC, payment_type DESC) AS rn
      FROM (SELECT c.customer_unique_id, p.payment_type, SUM(p.payment_value) AS paid,
                   MAX(o.order_purchase_timestamp) AS last_used
            FROM pay_clean p JOIN raw_orders o ON p.order_id = o.order_id
            JOIN raw_customers c ON o.customer_id = c.customer_id
            WHERE lower(trim(o.order_status)) NOT IN ('canceled', 'unavailable')
            GROUP BY c.customer_unique_id, p.payment_type))
GROUP BY customer_unique_id""",
    "customer_six_personas": _segments(_SIX, 0.30),
    "customer_tiers": _segments(_TIERS),
    "customer_activity": """
SELECT DISTINCT c.customer_unique_id, COALESCE(v.order_volume, 0) AS order_volume,
       CASE WHEN v.order_volume IS NULL THEN 'Inactive/Historical' ELSE 'Active' END AS activity
FROM raw_customers c LEFT JOIN cust_volume v ON c.customer_unique_id = v.customer_unique_id""",
    "peak_month": """
SELECT order_purchase_month AS peak_month, total_revenue AS peak_month_revenue
FROM mart_monthly ORDER BY total_revenue DESC, order_purchase_month DESC LIMIT 1""",
    "monthly_listing": _LISTED,
    "top_categories": """
SELECT product_category_en, ROUND(SUM(total_revenue), 2) AS total_revenue,
       CAST(SUM(total_orders) AS BIGINT) AS order_category_pairs
FROM mart_category GROUP BY product_category_en
ORDER BY total_revenue DESC, product_category_en LIMIT 10""",
    "top_states": f"SELECT * FROM ({_STATE_TOTALS}) ORDER BY total_revenue DESC, customer_state LIMIT 10",
    "state_totals": _STATE_TOTALS,
    "payment_totals": f"""
SELECT primary_payment_type, ROUND(SUM(total_revenue), 2) AS total_revenue,
       CAST(SUM(total_orders) AS BIGINT) AS total_orders, {_mean("avg_installments")} AS avg_installments,
       {_mean("share_of_month_revenue * 100")} AS avg_share_of_month_pct
FROM mart_payment GROUP BY primary_payment_type""",
    "delivery_buckets": """
SELECT delivery_status_bucket, CAST(COUNT(*) AS BIGINT) AS orders FROM deliv GROUP BY delivery_status_bucket""",
    "delivery_delta_range": """
SELECT MIN(delivery_delta_days) AS min_delta, MAX(delivery_delta_days) AS max_delta,
       CAST(SUM(delivery_delta_days) AS DOUBLE) / COUNT(*) AS avg_delta
FROM deliv WHERE delivery_delta_days IS NOT NULL""",
    "delivery_profile": """
SELECT customer_state, CAST(COUNT(*) AS BIGINT) AS orders,
       CAST(SUM(delivery_delta_days) AS DOUBLE) / COUNT(*) AS avg_delta_days,
       CAST(SUM(is_late) AS DOUBLE) / COUNT(*) AS late_rate
FROM deliv WHERE delivery_delta_days IS NOT NULL GROUP BY customer_state""",
    "worst_hotspots": "SELECT * FROM mart_hotspots ORDER BY hotspot_rank, customer_state LIMIT 10",
    "worst_states": """
SELECT * FROM mart_delivery_state
ORDER BY order_purchase_month DESC NULLS LAST, state_delay_rank_in_month, customer_state LIMIT 20""",
    "worst_corridors": """
SELECT * FROM mart_corridor
ORDER BY order_purchase_month DESC NULLS LAST, corridor_delay_rank_in_month, seller_state, customer_state LIMIT 20""",
    "customer_id_multiplicity": """
SELECT customer_unique_id, CAST(COUNT(customer_id) AS BIGINT) AS customer_ids
FROM raw_customers GROUP BY customer_unique_id""",
    "volume_histogram": """
SELECT volume_segment, CAST(COUNT(*) AS BIGINT) AS customers FROM cust_volume GROUP BY volume_segment""",
    "percentile_band": _doubles(
        "cust_value", _AS_DOUBLE["segment"], "WHERE spend_percentile BETWEEN 0.6 AND 0.7"
    ),
    "purchase_range": """
SELECT MAX(order_purchase_timestamp) AS newest_purchase, MIN(order_purchase_timestamp) AS oldest_purchase,
       CAST(COUNT(DISTINCT customer_unique_id) AS BIGINT) AS customers FROM recent""",
    "null_state_orders": _doubles("ord_rev", _AS_DOUBLE["orders_revenue"], "WHERE customer_state IS NULL"),
    "row_counts": _counts(_ALL_LANDED),
    "mart_row_counts": _counts(_MARTS),
    "stored_row_counts": _counts({name: table for name, table in _MARTS.items() if name != "items_per_order"}),
    "row_count_audit": f"""
SELECT e.table_name, e.row_count AS expected_count, a.row_count AS actual_count,
       a.row_count - e.row_count AS difference,
       CASE WHEN a.row_count = e.row_count THEN 'PASS' ELSE 'FAIL' END AS status
FROM ({_counts(_ALL_LANDED)}) e
JOIN (SELECT table_name, rows_kept AS row_count FROM ({" UNION ALL ".join(_loaded(n) for n in _SOURCES)})) a
  ON e.table_name = a.table_name""",
    "payment_profile": """
SELECT CAST(COUNT(*) FILTER (WHERE payment_value < 0) AS BIGINT) AS negative_payments,
       CAST(COUNT(*) FILTER (WHERE payment_value IS NULL) AS BIGINT) AS null_payments,
       CAST(MIN(payment_value) AS DOUBLE) AS min_value, CAST(MAX(payment_value) AS DOUBLE) AS max_value
FROM raw_order_payments""",
    "ghost_payments": """
SELECT CAST(COUNT(*) AS BIGINT) AS ghost_payment_rows FROM raw_order_payments p
WHERE NOT EXISTS (SELECT 1 FROM raw_orders o WHERE o.order_id = p.order_id)""",
    "grain_check": " UNION ALL ".join(
        _grain(*g)
        for g in (
            ("payments_order_agg", "pay_order", "order_id"),
            ("product_catalog", "catalog", "product_id"),
            ("orders_revenue", "ord_rev", "order_id"),
            ("geo_zip_prefix", "geo", "zip_code_prefix, geo_state"),
            ("customer_geo", "cust_geo", "customer_id"),
            ("seller_geo", "sell_geo", "seller_id"),
            ("order_seller_rollup", "seller_rollup", "order_id, seller_id"),
            ("raw_order_items", "raw_order_items", "order_id, order_item_id"),
        )
    ),
    "payment_mix": """
SELECT primary_payment_type, CAST(COUNT(*) AS BIGINT) AS orders,
       CAST(ROUND(SUM(total_payment_value), 2) AS DOUBLE) AS total_value
FROM pay_order GROUP BY primary_payment_type""",
    "reconciliation_summary": """
SELECT CAST(COUNT(*) AS BIGINT) AS orders, CAST(SUM(is_revenue_recognised) AS BIGINT) AS recognised_orders,
       CAST(SUM(revenue_total) AS DOUBLE) AS revenue_total,
       CAST(SUM(total_payment_value) AS DOUBLE) AS payments_total,
       ROUND(CAST(SUM(ABS(payment_reconciliation_delta)) AS DOUBLE) / COUNT(*), 2) AS avg_abs_recon_delta,
       ROUND(AVG(CASE WHEN CAST(ABS(payment_reconciliation_delta) AS DOUBLE)
                           / GREATEST(CAST(revenue_total AS DOUBLE), 1.0) < 0.05 THEN 1.0 ELSE 0.0 END) * 100, 2)
         AS pct_reconciled_within_5pct
FROM ord_rev""",
    "unknown_category_rate": f"""
SELECT CAST(COUNT(*) FILTER (WHERE product_category_en = 'unknown') AS BIGINT) AS unknown_items,
       CAST(COUNT(*) AS BIGINT) AS total_items, CAST({_UNKNOWN_PCT} AS DOUBLE) AS unknown_pct
FROM item_rev""",
    "share_sum_check": " UNION ALL ".join(
        f"SELECT '{name}' AS mart, CAST(COUNT(*) AS BIGINT) AS months, "
        f"CAST(COUNT(*) FILTER (WHERE s <> 1.0) AS BIGINT) AS months_off FROM {_share_sums(table, share)}"
        for name, (table, share) in _SHARES.items()
    ),
    "invariant_gate_enforced": " UNION ALL ".join(_check(*c) for c in _CHECKS),
    "invariant_gate": " UNION ALL ".join(_check(*c) for c in _CHECKS),
}


def oracle_queries() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in QUERIES.items()}
