"""Quality rules of the conformed tables and marts."""

from __future__ import annotations

from martloom.operators.quality import DROP, FAIL, WARN, Expectation

# Known payment types and order states, tolerance of the payment check.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
ORDER_STATUSES = (
    "created",
    "approved",
    "invoiced",
    "processing",
    "shipped",
    "delivered",
    "unavailable",
    "canceled",
)
RECONCILIATION_TOLERANCE = 0.05


def _one_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def _known(column: str, action: str) -> Expectation:
    return Expectation(f"{column}_not_null", f"{column} IS NOT NULL", action)


def _not_negative(column: str, action: str) -> Expectation:
    return Expectation(f"{column}_not_negative", f"{column} >= 0", action)


_STATUS = Expectation("valid_order_status", _one_of("order_status", ORDER_STATUSES), WARN)

RULES: dict[str, list[Expectation]] = {
    "payments_clean": [
        _known("order_id", FAIL),
        _not_negative("payment_value", DROP),
        Expectation("valid_payment_type", _one_of("payment_type", PAYMENT_TYPES), WARN),
        _not_negative("payment_installments", WARN),
    ],
    "payments_order_agg": [_known("order_id", FAIL), _not_negative("total_payment_value", FAIL)],
    "product_catalog": [_known("product_id", DROP), _known("product_category_en", WARN)],
    "order_items_revenue": [
        _known("order_id", FAIL),
        _not_negative("price", DROP),
        _not_negative("freight_value", DROP),
        _known("product_category_en", WARN),
    ],
    "orders_revenue": [
        _known("order_id", FAIL),
        _not_negative("revenue_total", DROP),
        Expectation(
            "payment_reconciles",
            f"abs(payment_reconciliation_delta) / greatest(revenue_total, 1) < {RECONCILIATION_TOLERANCE}",
            WARN,
        ),
        _STATUS,
    ],
    "geo_zip_prefix": [
        _known("zip_code_prefix", DROP),
        Expectation("valid_state", "length(geo_state) = 2", WARN),
    ],
    "customer_geo": [_known("customer_id", DROP)],
    "seller_geo": [_known("seller_id", DROP)],
    "delivery_order": [_known("order_id", DROP), _known("customer_id", WARN), _STATUS],
    "order_seller_rollup": [_known("order_id", DROP), _known("seller_id", DROP)],
    "delivery_order_item": [_known("order_id", DROP), _known("seller_id", WARN)],
    "order_totals": [_known("order_id", FAIL)],
    "last_12m_orders": [_known("order_purchase_timestamp", FAIL)],
    "customer_volume_segment": [_known("customer_unique_id", FAIL)],
    "revenue_monthly": [_not_negative("total_revenue", WARN)],
    "revenue_by_category_month": [_known("product_category_en", WARN)],
    "revenue_by_state_month": [_known("customer_state", WARN)],
    "revenue_by_payment_type_month": [_known("primary_payment_type", WARN)],
    "customer_segmentation": [
        Expectation(
            "valid_persona", _one_of("customer_persona", ("VIP", "Core Customer", "Casual Buyer")), FAIL
        )
    ],
}
