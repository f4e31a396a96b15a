"""Layouts and quality rules of the nine source tables."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names and types, file options and rules of the nine source files.
RAW_SCHEMAS = {
    "raw_customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
    "customer_city string, customer_state string",
    "raw_product_names_translation": "product_category_name string, product_category_name_english string",
    "raw_sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "raw_products": "product_id string, product_category_name string, product_name_lenght string, "
    "product_description_lenght string, product_photos_qty string, product_weight_g int, "
    "product_length_cm int, product_height_cm int, product_width_cm int",
    "raw_orders": "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp, order_approved_at timestamp, "
    "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
    "order_estimated_delivery_date timestamp",
    "raw_order_payments": "order_id string, payment_sequential int, payment_type string, "
    "payment_installments int, payment_value double",
    "raw_order_items": "order_id string, order_item_id string, product_id string, seller_id string, "
    "shipping_limit_date timestamp, price double, freight_value double",
    "raw_geolocation": "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string, "
    "geolocation_city string, geolocation_state string",
    "raw_order_reviews": "review_id string, order_id string, review_score int, "
    "review_comment_title string, review_comment_message string, review_creation_date timestamp, "
    "review_answer_timestamp timestamp",
}
RAW_RULES = {
    "raw_customers": {
        "valid_customer_id": "customer_id IS NOT NULL",
        "valid_zip_code": "customer_zip_code_prefix > 0",
    },
    "raw_product_names_translation": {},
    "raw_sellers": {"valid_seller_id": "seller_id IS NOT NULL"},
    "raw_products": {"valid_product_id": "product_id IS NOT NULL"},
    "raw_orders": {"valid_order_id": "order_id IS NOT NULL"},
    "raw_order_payments": {"valid_order_id": "order_id IS NOT NULL"},
    "raw_order_items": {"valid_order_id": "order_id IS NOT NULL"},
    "raw_geolocation": {},
    "raw_order_reviews": {"valid_review_id": "review_id IS NOT NULL"},
}
MULTILINE_TABLES = {"raw_order_reviews"}
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class FileSource:
    """One configured file (or folder of files) and the table it lands in."""

    path: str
    table_name: str
    schema: str
    file_format: str = "csv"
    header: bool = True
    delimiter: str = ","
    multiLine: bool = False
    quote: str | None = None
    escape: str | None = None
    timestamp_format: str | None = None
    load_mode: str = "overwrite"
    dq_rules: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        """Options that were set; unset ones keep Spark's defaults."""
        options = {
            "header": self.header,
            "delimiter": self.delimiter,
            "multiLine": self.multiLine,
            "quote": self.quote,
            "escape": self.escape,
            "timestampFormat": self.timestamp_format,
        }
        return {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if v is not None}


def sources_from_config(config: dict) -> list[FileSource]:
    """Read the `{"base_path": ..., "files": {file: {...}}}` layout."""
    base = config["base_path"].rstrip("/")
    return [FileSource(path=f"{base}/{name}", **entry) for name, entry in config["files"].items()]


def default_config(base_path: str) -> dict:
    """Configuration for the nine tables, one folder of CSV files each."""
    files = {}
    for table, schema in RAW_SCHEMAS.items():
        entry = {"table_name": table, "schema": schema, "dq_rules": RAW_RULES[table]}
        if "timestamp" in schema:
            entry["timestamp_format"] = TIMESTAMP_FORMAT
        if table in MULTILINE_TABLES:
            entry.update(multiLine=True, quote='"', escape='"')
        files[f"{table}.csv"] = entry
    return {"base_path": base_path, "files": files}
