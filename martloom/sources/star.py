"""Retail source tables derived from an orders / line items / parts star schema.

A deterministic projection per table: no shuffle except the distinct list of part types. The files'
layout is declared, so no job runs to infer it, and a table is opened only when something reads it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Layout of the star tables.
STAR_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
# Payment type by return flag and line status (untrimmed and mixed case on purpose).
PAYMENT_TYPES = {
    "AF": " Credit_Card ",
    "AO": "boleto",
    "NF": "voucher",
    "NO": "debit_card",
    "RF": "not_defined",
    "RO": "credit_card",
}

_STATUS = """CASE WHEN o_orderstatus = 'F' THEN ' Delivered'
    WHEN o_orderstatus = 'O' THEN if(o_orderkey % 2 = 0, 'delivered', 'shipped')
    ELSE element_at(array('canceled', 'unavailable', 'processing', 'invoiced'), cast(o_orderkey % 4 + 1 AS int)) END"""
_KIND = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in PAYMENT_TYPES.items())


def _later(days: str, unless: str) -> str:
    return f"CASE WHEN NOT {unless} THEN cast(date_add(cast(o_orderdate AS date), cast({days} AS int)) AS timestamp_ntz) END"


def _state(nation: str) -> str:
    return f"concat('N', char(65 + {nation}))"


_PROJECTIONS = {
    "raw_orders": (
        "orders",
        "cast(o_orderkey AS string) AS order_id",
        "cast(o_custkey AS string) AS customer_id",
        f"{_STATUS} AS order_status",
        "o_orderdate AS order_purchase_timestamp",
        "o_orderdate AS order_approved_at",
        f"{_later('o_orderkey % 5', 'o_orderkey % 29 = 0')} AS order_delivered_carrier_date",
        f"{_later('o_orderkey % 5 + o_orderkey * 7 % 23', 'o_orderkey % 31 = 0')} AS order_delivered_customer_date",
        f"{_later('8 + o_custkey % 12', 'o_orderkey % 37 = 0')} AS order_estimated_delivery_date",
    ),
    "raw_order_items": (
        "lineitem",
        "cast(l_orderkey AS string) AS order_id",
        "cast(l_linenumber AS string) AS order_item_id",
        "cast(l_partkey AS string) AS product_id",
        "cast(l_suppkey AS string) AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "l_extendedprice AS price",
        "l_quantity AS freight_value",
    ),
    "raw_order_payments": (
        "lineitem",
        "cast(if(l_orderkey % 101 = 0, l_orderkey + 1000000000, l_orderkey) AS string) AS order_id",
        "l_linenumber AS payment_sequential",
        f"CASE concat(l_returnflag, l_linestatus) {_KIND} END AS payment_type",
        "cast(l_quantity AS int) % 12 + 1 AS payment_installments",
        "if(l_quantity = 50, -l_extendedprice, l_extendedprice) AS payment_value",
    ),
    "raw_products": (
        "part",
        "cast(p_partkey AS string) AS product_id",
        "CASE WHEN p_partkey % 50 <> 0 THEN lower(p_type) END AS product_category_name",
        "p_size * 10 AS product_weight_g",
        "p_size AS product_length_cm",
        "p_size AS product_height_cm",
        "p_size AS product_width_cm",
    ),
    "raw_customers": (
        "customer",
        "cast(c_custkey AS string) AS customer_id",
        "concat('u', cast(c_custkey div 4 AS string)) AS customer_unique_id",
        "cast(c_custkey % 97 + 1 AS int) AS customer_zip_code_prefix",
        "concat(' City ', c_nationkey) AS customer_city",
        f"lower({_state('c_nationkey')}) AS customer_state",
    ),
    "raw_sellers": (
        "supplier",
        "cast(s_suppkey AS string) AS seller_id",
        "cast(s_suppkey % 97 AS string) AS seller_zip_code_prefix",
        "concat(' City ', s_nationkey) AS seller_city",
        f"{_state('s_nationkey')} AS seller_state",
    ),
    "raw_order_reviews": (
        "documents",
        "concat('r', doc_id) AS review_id",
        "cast(doc_id AS string) AS order_id",
        "cast(n_chars % 5 + 1 AS int) AS review_score",
        """concat(lang, ' "quoted", ', source) AS review_comment_title""",
        "text AS review_comment_message",
        "cast(date_add(date'2020-01-01', cast(n_chars % 365 AS int)) AS timestamp_ntz) AS review_creation_date",
        "cast(date_add(date'2020-01-01', cast(n_chars % 365 + 2 AS int)) AS timestamp_ntz) AS review_answer_timestamp",
    ),
}


class RawTables(Mapping):
    """The source tables every mart starts from, by name. A table is opened on first use."""

    def __init__(self, openers: Mapping[str, Callable[[], DataFrame]]):
        self._openers = dict(openers)
        self._opened: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, **tables: DataFrame) -> RawTables:
        return cls({name: (lambda df=df: df) for name, df in tables.items()})

    def replacing(self, **tables: DataFrame) -> RawTables:
        """The same tables with some of them exchanged."""
        return RawTables({**self._openers, **{name: (lambda df=df: df) for name, df in tables.items()}})

    def mapped(self, change: Callable[[str, DataFrame], DataFrame]) -> RawTables:
        """Every table changed by a function of its name and rows, still opened on first use."""
        return RawTables({name: (lambda name=name: change(name, self[name])) for name in self})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._openers[name]()
        return self._opened[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._openers:
            raise AttributeError(name)
        return self[name]

    def __iter__(self):
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)


def _translation(part: DataFrame) -> DataFrame:
    known = part.filter("NOT (p_type LIKE '%PROMO%' OR p_type LIKE '%SMALL%')")
    names = known.selectExpr("lower(p_type) AS product_category_name").distinct()
    return names.selectExpr("*", "concat('en_', product_category_name) AS product_category_name_english")


def _geolocation(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Every customer and supplier place; the zip code is missing for keys divisible by five."""

    def places(df: DataFrame, key: str, nation: str, balance: str, first: int) -> DataFrame:
        return df.selectExpr(
            f"CASE WHEN {key} % 5 <> 0 THEN cast({key} % 97 + {first} AS string) END AS geolocation_zip_code_prefix",
            f"cast(cast({balance} AS decimal(18,2)) AS string) AS geolocation_lat",
            f"cast(-cast({balance} AS decimal(18,2)) AS string) AS geolocation_lng",
            f"concat(' City ', {nation}) AS geolocation_city",
            f"{_state(nation)} AS geolocation_state",
        )

    return places(customer, "c_custkey", "c_nationkey", "c_acctbal", 1).unionByName(
        places(supplier, "s_suppkey", "s_nationkey", "s_acctbal", 0)
    )


def _with_broken_customers(customers: DataFrame) -> DataFrame:
    """One row in 97 comes a second time, broken: without an id, or with a zip code that no place has."""
    twice = customers.selectExpr("*", "explode(if(customer_zip_code_prefix = 1, array(0, 1), array(0))) AS again")
    return twice.selectExpr(
        "CASE WHEN again = 0 THEN customer_id WHEN cast(customer_id AS bigint) % 2 = 0 THEN concat('x', customer_id) END AS customer_id",
        "customer_unique_id",
        "if(again = 0, customer_zip_code_prefix, 0) AS customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    def table(name: str) -> DataFrame:
        return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    openers = {
        name: (lambda source=source, columns=columns: table(source).selectExpr(*columns))
        for name, (source, *columns) in _PROJECTIONS.items()
    }
    whole = openers["raw_customers"]
    openers["raw_customers"] = lambda: _with_broken_customers(whole())
    openers["raw_product_names_translation"] = lambda: _translation(table("part"))
    openers["raw_geolocation"] = lambda: _geolocation(table("customer"), table("supplier"))
    return RawTables(openers)
