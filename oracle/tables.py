"""Source and conformed tables as plain SQL, written apart from the Spark code they check.

Each entry is the body of a common table expression; `with_tables` puts the ones a query names in
front of it.
"""

from __future__ import annotations

import re

TABLES: dict[str, str] = {}

# --- source tables ------------------------------------------------------------------------------

TABLES["raw_orders"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       CASE WHEN o_orderstatus = 'F' THEN ' Delivered'
            WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'delivered'
            WHEN o_orderstatus = 'O' THEN 'shipped'
            WHEN o_orderkey % 4 = 0 THEN 'canceled'
            WHEN o_orderkey % 4 = 1 THEN 'unavailable'
            WHEN o_orderkey % 4 = 2 THEN 'processing'
            ELSE 'invoiced' END AS order_status,
       o_orderdate AS order_purchase_timestamp,
       o_orderdate AS order_approved_at,
       CASE WHEN o_orderkey % 29 <> 0 THEN
         CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS TIMESTAMP) END
         AS order_delivered_carrier_date,
       CASE WHEN o_orderkey % 31 <> 0 THEN
         CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 + (o_orderkey * 7) % 23 AS INTEGER) AS TIMESTAMP) END
         AS order_delivered_customer_date,
       CASE WHEN o_orderkey % 37 <> 0 THEN
         CAST(CAST(o_orderdate AS DATE) + CAST(8 + o_custkey % 12 AS INTEGER) AS TIMESTAMP) END
         AS order_estimated_delivery_date
FROM orders"""

TABLES["raw_order_items"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(l_linenumber AS VARCHAR) AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey AS VARCHAR) AS seller_id,
       l_shipdate AS shipping_limit_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
       CAST(l_quantity AS DECIMAL(18,2)) AS freight_value
FROM lineitem"""

TABLES["raw_order_payments"] = """
SELECT CAST(CASE WHEN l_orderkey % 101 = 0 THEN l_orderkey + 1000000000 ELSE l_orderkey END AS VARCHAR) AS order_id,
       CAST(l_linenumber AS INTEGER) AS payment_sequential,
       CASE l_returnflag || l_linestatus
            WHEN 'AF' THEN ' Credit_Card ' WHEN 'AO' THEN 'boleto' WHEN 'NF' THEN 'voucher'
            WHEN 'NO' THEN 'debit_card' WHEN 'RF' THEN 'not_defined' WHEN 'RO' THEN 'credit_card' END
         AS payment_type,
       CAST(CAST(l_quantity AS INTEGER) % 12 + 1 AS INTEGER) AS payment_installments,
       CAST(CASE WHEN l_quantity = 50 THEN -CAST(l_extendedprice AS DECIMAL(18,2))
                 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS payment_value
FROM lineitem"""

TABLES["raw_products"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       CASE WHEN p_partkey % 50 <> 0 THEN lower(p_type) END AS product_category_name,
       CAST(p_size * 10 AS INTEGER) AS product_weight_g,
       CAST(p_size AS INTEGER) AS product_length_cm,
       CAST(p_size AS INTEGER) AS product_height_cm,
       CAST(p_size AS INTEGER) AS product_width_cm
FROM part"""

TABLES["raw_product_names_translation"] = """
SELECT DISTINCT lower(p_type) AS product_category_name,
       'en_' || lower(p_type) AS product_category_name_english
FROM part WHERE p_type NOT LIKE '%PROMO%' AND p_type NOT LIKE '%SMALL%'"""

# as delivered: some rows come again with no id or no zip code
TABLES["landed_customers"] = """
SELECT CASE WHEN again = 0 THEN CAST(c_custkey AS VARCHAR)
            WHEN c_custkey % 2 = 0 THEN 'x' || CAST(c_custkey AS VARCHAR) END AS customer_id,
       'u' || CAST(c_custkey // 4 AS VARCHAR) AS customer_unique_id,
       CASE WHEN again = 0 THEN CAST(c_custkey % 97 + 1 AS INTEGER) ELSE 0 END AS customer_zip_code_prefix,
       ' City ' || CAST(c_nationkey AS VARCHAR) AS customer_city,
       lower('N' || chr(CAST(65 + c_nationkey AS INTEGER))) AS customer_state
FROM customer, (SELECT 0 AS again UNION ALL SELECT 1)
WHERE again = 0 OR c_custkey % 97 = 0"""

TABLES["raw_customers"] = """
SELECT * FROM landed_customers WHERE customer_id IS NOT NULL AND customer_zip_code_prefix > 0"""

TABLES["raw_sellers"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
       CAST(s_suppkey % 97 AS VARCHAR) AS seller_zip_code_prefix,
       ' City ' || CAST(s_nationkey AS VARCHAR) AS seller_city,
       'N' || chr(CAST(65 + s_nationkey AS INTEGER)) AS seller_state
FROM supplier"""

TABLES["raw_geolocation"] = """
SELECT CASE WHEN k % 5 <> 0 THEN CAST(k % 97 + first AS VARCHAR) END AS geolocation_zip_code_prefix,
       CAST(CAST(bal AS DECIMAL(18,2)) AS VARCHAR) AS geolocation_lat,
       CAST(-CAST(bal AS DECIMAL(18,2)) AS VARCHAR) AS geolocation_lng,
       ' City ' || CAST(nk AS VARCHAR) AS geolocation_city,
       'N' || chr(CAST(65 + nk AS INTEGER)) AS geolocation_state
FROM (SELECT c_custkey AS k, c_nationkey AS nk, c_acctbal AS bal, 1 AS first FROM customer
      UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal, 0 FROM supplier)"""

TABLES["raw_order_reviews"] = """
SELECT 'r' || CAST(doc_id AS VARCHAR) AS review_id,
       CAST(doc_id AS VARCHAR) AS order_id,
       CAST(n_chars % 5 + 1 AS INTEGER) AS review_score,
       lang || ' "quoted", ' || source AS review_comment_title,
       text AS review_comment_message,
       CAST(DATE '2020-01-01' + CAST(n_chars % 365 AS INTEGER) AS TIMESTAMP) AS review_creation_date,
       CAST(DATE '2020-01-01' + CAST(n_chars % 365 + 2 AS INTEGER) AS TIMESTAMP) AS review_answer_timestamp
FROM documents"""

# --- conformed tables ---------------------------------------------------------------------------

TABLES["pay_clean"] = """
SELECT order_id, payment_sequential, lower(trim(payment_type)) AS payment_type, payment_installments, payment_value
FROM raw_order_payments WHERE order_id IS NOT NULL AND payment_value >= 0"""

TABLES["pay_ranked"] = """
SELECT *, row_number() OVER (PARTITION BY order_id
         ORDER BY payment_value DESC, payment_sequential ASC, payment_type DESC) AS rn
FROM pay_clean"""

TABLES["pay_order"] = """
SELECT order_id,
       SUM(payment_value) AS total_payment_value,
       CAST(COUNT(*) AS BIGINT) AS n_payments,
       CAST(MAX(payment_installments) AS INTEGER) AS installments_max,
       string_agg(DISTINCT payment_type, ',' ORDER BY payment_type) AS payment_type_mix,
       MAX(CASE WHEN rn = 1 THEN payment_type END) AS primary_payment_type
FROM pay_ranked GROUP BY order_id"""

TABLES["catalog"] = """
SELECT p.product_id, p.product_category_name, p.product_weight_g, p.product_length_cm,
       p.product_height_cm, p.product_width_cm,
       COALESCE(t.product_category_name_english, p.product_category_name, 'unknown') AS product_category_en
FROM raw_products p LEFT JOIN raw_product_names_translation t
  ON p.product_category_name = t.product_category_name
WHERE p.product_id IS NOT NULL"""

TABLES["item_rev"] = """
SELECT i.product_id, i.order_id, CAST(i.order_item_id AS INTEGER) AS order_item_id, i.seller_id,
       i.price, i.freight_value,
       COALESCE(c.product_category_en, 'unknown') AS product_category_en,
       CAST(i.price + i.freight_value AS DECIMAL(18,2)) AS item_total_revenue
FROM raw_order_items i LEFT JOIN catalog c ON i.product_id = c.product_id
WHERE i.price >= 0 AND i.freight_value >= 0"""

TABLES["item_order"] = """
SELECT order_id, CAST(COUNT(*) AS BIGINT) AS n_items, SUM(price) AS gross_revenue,
       SUM(freight_value) AS freight_total, SUM(item_total_revenue) AS revenue_total
FROM item_rev GROUP BY order_id"""

TABLES["geo"] = """
SELECT zip_code_prefix, geo_state,
       CAST(SUM(CAST(lat AS DECIMAL(28,15))) AS DOUBLE) / COUNT(lat) AS avg_lat,
       CAST(SUM(CAST(lng AS DECIMAL(28,15))) AS DOUBLE) / COUNT(lng) AS avg_lng,
       MIN(geo_city) AS geo_city
FROM (SELECT TRY_CAST(geolocation_zip_code_prefix AS INTEGER) AS zip_code_prefix,
             upper(trim(geolocation_state)) AS geo_state, lower(trim(geolocation_city)) AS geo_city,
             geolocation_lat AS lat, geolocation_lng AS lng
      FROM raw_geolocation)
WHERE zip_code_prefix IS NOT NULL GROUP BY zip_code_prefix, geo_state"""

TABLES["cust_geo"] = """
SELECT c.customer_id, c.customer_unique_id, c.customer_zip_code_prefix,
       lower(trim(c.customer_city)) AS customer_city_std, upper(trim(c.customer_state)) AS customer_state,
       g.avg_lat AS customer_lat, g.avg_lng AS customer_lng
FROM raw_customers c LEFT JOIN geo g
  ON c.customer_zip_code_prefix = g.zip_code_prefix AND upper(trim(c.customer_state)) = g.geo_state
WHERE c.customer_id IS NOT NULL"""

TABLES["sell_geo"] = """
SELECT s.seller_id, CAST(s.seller_zip_code_prefix AS INTEGER) AS seller_zip_code_prefix,
       lower(trim(s.seller_city)) AS seller_city_std, upper(trim(s.seller_state)) AS seller_state,
       g.avg_lat AS seller_lat, g.avg_lng AS seller_lng
FROM raw_sellers s LEFT JOIN geo g
  ON CAST(s.seller_zip_code_prefix AS INTEGER) = g.zip_code_prefix AND upper(trim(s.seller_state)) = g.geo_state
WHERE s.seller_id IS NOT NULL"""

TABLES["std_ord"] = """
SELECT order_id, customer_id, lower(trim(order_status)) AS order_status,
       order_purchase_timestamp AS order_purchase_ts, order_approved_at AS order_approved_ts,
       order_delivered_carrier_date AS order_delivered_carrier_ts,
       order_delivered_customer_date AS order_delivered_customer_ts,
       order_estimated_delivery_date AS order_estimated_delivery_ts,
       CAST(order_purchase_timestamp AS DATE) AS order_purchase_date,
       CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_purchase_month
FROM raw_orders WHERE order_id IS NOT NULL"""

TABLES["ord_rev"] = """
SELECT o.customer_id, o.order_id, o.order_status, o.order_purchase_ts,
       i.n_items, i.gross_revenue, i.freight_total, i.revenue_total,
       p.total_payment_value, p.n_payments, p.installments_max, p.payment_type_mix, p.primary_payment_type,
       c.customer_unique_id, c.customer_state, c.customer_city_std,
       o.order_purchase_date, o.order_purchase_month,
       CAST(year(o.order_purchase_ts) AS INTEGER) AS order_purchase_year,
       i.revenue_total - COALESCE(p.total_payment_value, 0) AS payment_reconciliation_delta,
       CAST(CASE WHEN o.order_status IN ('canceled', 'unavailable') THEN 0 ELSE 1 END AS INTEGER)
         AS is_revenue_recognised
FROM std_ord o
JOIN item_order i ON o.order_id = i.order_id
LEFT JOIN pay_order p ON o.order_id = p.order_id
LEFT JOIN cust_geo c ON o.customer_id = c.customer_id"""

TABLES["rev_ok"] = "SELECT * FROM ord_rev WHERE is_revenue_recognised = 1"

TABLES["deliv"] = """
SELECT *,
       CAST(CASE WHEN delivery_delta_days > 0 THEN 1 WHEN delivery_delta_days IS NOT NULL THEN 0 END AS INTEGER)
         AS is_late,
       CASE WHEN order_status <> 'delivered' THEN 'not_delivered'
            WHEN order_delivered_customer_ts IS NULL THEN 'delivery_timestamp_missing'
            WHEN order_estimated_delivery_ts IS NULL THEN 'estimated_timestamp_missing'
            WHEN delivery_delta_days < 0 THEN 'early'
            WHEN delivery_delta_days = 0 THEN 'on_time'
            WHEN delivery_delta_days BETWEEN 1 AND 3 THEN 'late_1_3_days'
            WHEN delivery_delta_days BETWEEN 4 AND 7 THEN 'late_4_7_days'
            WHEN delivery_delta_days > 7 THEN 'late_8_plus_days' END AS delivery_status_bucket
FROM (
  SELECT o.*, c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city_std, c.customer_state,
         c.customer_lat, c.customer_lng,
         CAST(CASE WHEN o.order_status = 'delivered' THEN 1 ELSE 0 END AS INTEGER) AS is_delivered,
         CAST(CASE WHEN o.order_delivered_customer_ts IS NOT NULL THEN 1 ELSE 0 END AS INTEGER)
           AS has_actual_delivery_ts,
         CAST(CASE WHEN o.order_estimated_delivery_ts IS NOT NULL THEN 1 ELSE 0 END AS INTEGER)
           AS has_estimated_delivery_ts,
         CAST(CASE WHEN o.order_status = 'delivered' THEN
           date_diff('day', CAST(o.order_estimated_delivery_ts AS DATE), CAST(o.order_delivered_customer_ts AS DATE))
           END AS INTEGER) AS delivery_delta_days,
         CAST(date_diff('day', CAST(o.order_purchase_ts AS DATE), CAST(o.order_delivered_customer_ts AS DATE))
           AS INTEGER) AS purchase_to_delivery_days,
         CAST(date_diff('day', CAST(o.order_delivered_carrier_ts AS DATE), CAST(o.order_delivered_customer_ts AS DATE))
           AS INTEGER) AS carrier_to_customer_days,
         CAST(date_diff('day', CAST(o.order_purchase_ts AS DATE), CAST(o.order_estimated_delivery_ts AS DATE))
           AS INTEGER) AS estimated_lead_time_days
  FROM std_ord o LEFT JOIN cust_geo c ON o.customer_id = c.customer_id)"""

TABLES["seller_rollup"] = """
SELECT r.*, s.seller_zip_code_prefix, s.seller_city_std, s.seller_state, s.seller_lat, s.seller_lng
FROM (SELECT order_id, seller_id, CAST(COUNT(*) AS BIGINT) AS item_count,
             CAST(COUNT(DISTINCT product_id) AS BIGINT) AS distinct_product_count,
             SUM(price) AS order_seller_item_value, SUM(freight_value) AS order_seller_freight_value,
             MAX(shipping_limit_date) AS max_shipping_limit_ts
      FROM raw_order_items WHERE order_id IS NOT NULL AND seller_id IS NOT NULL
      GROUP BY order_id, seller_id) r
LEFT JOIN sell_geo s ON r.seller_id = s.seller_id"""

TABLES["deliv_item"] = """
SELECT d.* EXCLUDE (customer_unique_id), s.* EXCLUDE (order_id)
FROM seller_rollup s JOIN deliv d ON s.order_id = d.order_id"""

TABLES["ord_total"] = """
SELECT order_id, SUM(price + freight_value) AS total_price FROM raw_order_items GROUP BY order_id"""

TABLES["delivered"] = "SELECT * FROM raw_orders WHERE lower(trim(order_status)) = 'delivered'"

TABLES["recent"] = """
SELECT o.*, a.anchor_date, t.total_price, c.customer_unique_id
FROM delivered o
CROSS JOIN (SELECT MAX(order_purchase_timestamp) AS anchor_date FROM delivered) a
LEFT JOIN ord_total t ON o.order_id = t.order_id
LEFT JOIN raw_customers c ON o.customer_id = c.customer_id
WHERE o.order_purchase_timestamp >= CAST(a.anchor_date AS DATE) - INTERVAL 12 MONTH"""

TABLES["cust_value"] = """
SELECT customer_unique_id, total_price_unique_cust, spend_percentile,
       spend_percentile * 100 AS spend_percentile_100,
       CASE WHEN spend_percentile >= 0.85 THEN 'High' WHEN spend_percentile >= 0.40 THEN 'Medium' ELSE 'Low' END
         AS value_segment
FROM (SELECT *, percent_rank() OVER (ORDER BY total_price_unique_cust ASC NULLS FIRST) AS spend_percentile
      FROM (SELECT customer_unique_id, SUM(total_price) AS total_price_unique_cust
            FROM recent GROUP BY customer_unique_id))"""

TABLES["cust_volume"] = """
SELECT customer_unique_id, order_volume,
       CASE WHEN order_volume >= 7 THEN 'High' WHEN order_volume >= 2 THEN 'Medium' ELSE 'Low' END AS volume_segment
FROM (SELECT customer_unique_id, CAST(COUNT(order_id) AS BIGINT) AS order_volume
      FROM recent GROUP BY customer_unique_id)"""

TABLES["cust_seg"] = """
SELECT v.*, q.order_volume, q.volume_segment,
       CASE WHEN value_segment = 'High' THEN 'VIP'
            WHEN (volume_segment = 'Medium' AND value_segment = 'Medium') OR volume_segment = 'High'
              THEN 'Core Customer'
            ELSE 'Casual Buyer' END AS customer_persona
FROM cust_value v JOIN cust_volume q ON v.customer_unique_id = q.customer_unique_id"""

# --- marts --------------------------------------------------------------------------------------

TABLES["m_month"] = """
SELECT order_purchase_month, CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
       SUM(revenue_total) AS revenue
FROM rev_ok WHERE order_purchase_month IS NOT NULL GROUP BY order_purchase_month"""

TABLES["mart_monthly"] = """
SELECT b.order_purchase_month, b.total_orders, CAST(b.revenue AS DOUBLE) AS total_revenue,
       CAST(b.revenue AS DOUBLE) / b.total_orders AS aov,
       CASE WHEN m.revenue > 0 THEN
         (CAST(b.revenue AS DOUBLE) - CAST(m.revenue AS DOUBLE)) / CAST(m.revenue AS DOUBLE) * 100.0 END
         AS revenue_mom_pct,
       CASE WHEN y.revenue > 0 THEN
         (CAST(b.revenue AS DOUBLE) - CAST(y.revenue AS DOUBLE)) / CAST(y.revenue AS DOUBLE) * 100.0 END
         AS revenue_yoy_pct,
       CAST(SUM(b.revenue) OVER (ORDER BY b.order_purchase_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
         AS DOUBLE) AS revenue_rolling_3m,
       CAST(SUM(b.revenue) OVER (ORDER BY b.order_purchase_month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
         AS DOUBLE) AS revenue_rolling_6m
FROM m_month b
LEFT JOIN m_month m ON b.order_purchase_month = CAST(m.order_purchase_month + INTERVAL 1 MONTH AS DATE)
LEFT JOIN m_month y ON b.order_purchase_month = CAST(y.order_purchase_month + INTERVAL 12 MONTH AS DATE)"""

TABLES["m_category"] = """
SELECT o.order_purchase_month, i.product_category_en,
       CAST(COUNT(DISTINCT i.order_id) AS BIGINT) AS total_orders, SUM(i.item_total_revenue) AS revenue
FROM item_rev i JOIN rev_ok o ON i.order_id = o.order_id
GROUP BY o.order_purchase_month, i.product_category_en"""

TABLES["mart_category"] = """
SELECT order_purchase_month, product_category_en, total_orders, CAST(revenue AS DOUBLE) AS total_revenue,
       CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER (PARTITION BY order_purchase_month) AS DOUBLE)
         AS revenue_share_of_month,
       CAST(dense_rank() OVER (PARTITION BY order_purchase_month ORDER BY revenue DESC) AS INTEGER)
         AS category_rank_in_month
FROM m_category"""

TABLES["m_state"] = """
SELECT order_purchase_month, customer_state, CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
       CAST(COUNT(DISTINCT customer_unique_id) AS BIGINT) AS total_customers, SUM(revenue_total) AS revenue
FROM rev_ok WHERE customer_state IS NOT NULL GROUP BY order_purchase_month, customer_state"""

TABLES["mart_state"] = """
SELECT order_purchase_month, customer_state, total_orders, total_customers,
       CAST(revenue AS DOUBLE) AS total_revenue, CAST(revenue AS DOUBLE) / total_orders AS aov,
       CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER (PARTITION BY order_purchase_month) AS DOUBLE)
         AS revenue_share_of_month,
       CAST(dense_rank() OVER (PARTITION BY order_purchase_month ORDER BY revenue DESC) AS INTEGER)
         AS state_rank_in_month
FROM m_state"""

TABLES["m_payment"] = """
SELECT order_purchase_month, primary_payment_type, CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
       SUM(revenue_total) AS revenue, CAST(SUM(installments_max) AS DOUBLE) / COUNT(installments_max)
         AS avg_installments
FROM rev_ok WHERE primary_payment_type IS NOT NULL GROUP BY order_purchase_month, primary_payment_type"""

TABLES["mart_payment"] = """
SELECT order_purchase_month, primary_payment_type, total_orders, CAST(revenue AS DOUBLE) AS total_revenue,
       avg_installments,
       CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER (PARTITION BY order_purchase_month) AS DOUBLE)
         AS share_of_month_revenue
FROM m_payment"""

TABLES["anchored"] = """
SELECT r.*, MAX(order_purchase_date) OVER () AS anchor_date FROM rev_ok r"""

TABLES["summary_totals"] = """
SELECT CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
       CAST(SUM(revenue_total) AS DOUBLE) AS total_revenue,
       COALESCE(CAST(SUM(CASE WHEN order_purchase_date > anchor_date - 365 THEN revenue_total END) AS DOUBLE), 0.0)
         AS last_12m_revenue,
       COALESCE(CAST(SUM(CASE WHEN order_purchase_date <= anchor_date - 365
                               AND order_purchase_date > anchor_date - 730 THEN revenue_total END) AS DOUBLE), 0.0)
         AS prior_12m_revenue
FROM anchored"""

_DELAY_RATES = """
       CAST(SUM(CASE WHEN delivery_delta_days > 0 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS late_delivery_rate,
       CAST(SUM(CASE WHEN delivery_delta_days > 7 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS severe_delay_rate"""
_DELAY = """
       CAST(SUM(delivery_delta_days) AS DOUBLE) / COUNT(*) AS avg_delivery_delta_days,
       CAST(quantile_disc(delivery_delta_days, 0.5) AS INTEGER) AS median_delivery_delta_days"""
_ORDER_DELAY = f"""
       CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_delivered_orders,{_DELAY},
       CAST(SUM(purchase_to_delivery_days) AS DOUBLE) / COUNT(purchase_to_delivery_days)
         AS avg_purchase_to_delivery_days,
       CAST(SUM(carrier_to_customer_days) AS DOUBLE) / COUNT(carrier_to_customer_days)
         AS avg_carrier_to_customer_days,
       CAST(SUM(estimated_lead_time_days) AS DOUBLE) / COUNT(estimated_lead_time_days)
         AS avg_estimated_lead_time_days,{_DELAY_RATES},
       CAST(SUM(CASE WHEN delivery_delta_days <= 0 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS on_time_or_early_rate,
       CAST(SUM(CASE WHEN delivery_delta_days < 0 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS early_delivery_rate"""

TABLES["mart_delivery_state"] = f"""
SELECT *, CAST(dense_rank() OVER (PARTITION BY order_purchase_month ORDER BY avg_delivery_delta_days DESC) AS INTEGER)
         AS state_delay_rank_in_month
FROM (SELECT order_purchase_month, customer_state, {_ORDER_DELAY}
      FROM deliv WHERE delivery_delta_days IS NOT NULL AND customer_state IS NOT NULL
      GROUP BY order_purchase_month, customer_state)"""

TABLES["mart_delivery_seller"] = f"""
SELECT *, CAST(dense_rank() OVER (PARTITION BY order_purchase_month ORDER BY avg_delivery_delta_days DESC) AS INTEGER)
         AS seller_state_delay_rank_in_month
FROM (SELECT order_purchase_month, seller_state, CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
             CAST(COUNT(DISTINCT seller_id) AS BIGINT) AS active_sellers, {_DELAY},
             CAST(SUM(order_seller_item_value) AS DOUBLE) / COUNT(order_seller_item_value)
               AS avg_order_seller_item_value,
             CAST(SUM(order_seller_freight_value) AS DOUBLE) / COUNT(order_seller_freight_value)
               AS avg_order_seller_freight_value, {_DELAY_RATES}
      FROM deliv_item WHERE delivery_delta_days IS NOT NULL AND seller_state IS NOT NULL
      GROUP BY order_purchase_month, seller_state)"""

TABLES["mart_corridor"] = f"""
SELECT *, CAST(dense_rank() OVER (PARTITION BY order_purchase_month ORDER BY avg_delivery_delta_days DESC) AS INTEGER)
         AS corridor_delay_rank_in_month
FROM (SELECT order_purchase_month, seller_state, customer_state,
             CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
             CAST(COUNT(DISTINCT seller_id) AS BIGINT) AS active_sellers, {_DELAY},
             CAST(SUM(purchase_to_delivery_days) AS DOUBLE) / COUNT(purchase_to_delivery_days)
               AS avg_purchase_to_delivery_days,
             CAST(SUM(order_seller_freight_value) AS DOUBLE) / COUNT(order_seller_freight_value)
               AS avg_freight_value, {_DELAY_RATES}
      FROM deliv_item
      WHERE delivery_delta_days IS NOT NULL AND seller_state IS NOT NULL AND customer_state IS NOT NULL
      GROUP BY order_purchase_month, seller_state, customer_state)"""

TABLES["mart_hotspots"] = f"""
SELECT *, CAST(dense_rank() OVER (ORDER BY avg_delivery_delta_days DESC) AS INTEGER) AS hotspot_rank
FROM (SELECT customer_state, CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_delivered_orders, {_DELAY},
             {_DELAY_RATES}
      FROM deliv WHERE delivery_delta_days IS NOT NULL AND customer_state IS NOT NULL GROUP BY customer_state)"""

TABLES["mart_delivery_summary"] = f"""
SELECT {_ORDER_DELAY} FROM deliv WHERE delivery_delta_days IS NOT NULL"""


def with_tables(query: str) -> str:
    """Prefix a query with the tables it names, directly or through other tables, in order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in set(re.findall(r"\w+", sql)) & TABLES.keys() - needed:
            needed.add(name)
            visit(TABLES[name])

    visit(query)
    ordered = [name for name in TABLES if name in needed]
    if not ordered:
        return query.strip()
    return "WITH " + ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in ordered) + "\n" + query.strip()
