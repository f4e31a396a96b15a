"""Time the headline marts. Prints one JSON line.

Each query is composed anew and written to the `noop` sink, which computes every column. One warm-up
round over all headline queries, then the median of three runs each. `value` is the sum over the headline queries; `variants` holds the comparisons: gold marts
plain, on samples of the orders and from stored tables, and the item lookup.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from martloom.plans.model import RetailModel
from martloom.plans.publish import publish
from martloom.session import build_session
from martloom.sources.star import raw_tables

HEADLINE = (
    "revenue_monthly",
    "revenue_by_category_month",
    "revenue_by_state_month",
    "revenue_by_payment_type_month",
    "revenue_exec_summary",
    "delivery_state_month",
    "delivery_corridor_month",
    "customer_segmentation",
)
GOLD = HEADLINE[:4]
FACTS = ("payments_clean", "payments_order_agg", "product_catalog", "order_items_revenue", "customer_geo", "orders_revenue")
RUNS = 3


def timed(action, warm_up: bool = True) -> float:
    if warm_up:
        action()
    runs = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        runs.append(time.perf_counter() - start)
    return round(statistics.median(runs), 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "martloom-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def fresh() -> RetailModel:
        return RetailModel(raw_tables(spark, sf_dir))

    def gold(model: RetailModel) -> None:
        for name in GOLD:
            run(getattr(model, name))

    for name in HEADLINE:
        run(getattr(fresh(), name))
    queries = {name: timed(lambda: run(getattr(fresh(), name)), warm_up=False) for name in HEADLINE}
    stored = fresh()
    publish(stored, tempfile.mkdtemp(prefix="run-"), FACTS)
    variants = {
        "gold_build": timed(lambda: gold(fresh())),
        "gold_build_half_sample": timed(lambda: gold(fresh().sampled(0.5))),
        "gold_build_tenth_sample": timed(lambda: gold(fresh().sampled(0.1))),
        "gold_build_stored_facts": timed(lambda: gold(stored)),
        "item_lookup": timed(lambda: run(fresh().order_items_revenue)),
    }
    print(
        json.dumps(
            {
                "metric": "headline_marts_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "variants": variants,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
