"""Distribution measures of a whole-number column from a histogram.

Rows are first counted per group and value. That aggregate has plain numeric buffers, combines
map-side and shrinks any number of rows to one row per distinct value, so a group with a third of
all rows costs no more than a small one. Means, rates and the exact median follow from the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.functions import cents, from_cents, ratio


def tallies(counts: list[str] = (), amounts: list[str] = ()) -> list[Column]:
    """Row count, and sum and number of known values for each column that will be averaged."""
    sums = [F.sum(c).alias(f"_sum_{c}") for c in counts]
    sums += [F.sum(cents(c)).alias(f"_sum_{c}") for c in amounts]
    known = [F.count(c).alias(f"_cnt_{c}") for c in (*counts, *amounts)]
    return [F.count(F.lit(1)).alias("_n"), *sums, *known]


def histogram(df: DataFrame, keys: list[str], value: str, counts: list[str] = (), amounts: list[str] = ()) -> DataFrame:
    return df.groupBy(*keys, value).agg(*tallies(counts, amounts))


def with_median_marker(hist: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mark the values at or above the middle of their group; the least of them is the median."""
    group = Window.partitionBy(*keys)
    upto = F.sum("_n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return hist.withColumn("_median", F.when(2 * upto >= F.sum("_n").over(group), F.col(value)))


def median() -> Column:
    return F.min("_median")


def rows_total() -> Column:
    return F.coalesce(F.sum("_n"), F.lit(0))


def mean_value(value: str) -> Column:
    return ratio(F.sum(F.col(value).cast("bigint") * F.col("_n")), F.sum("_n"))


def mean_count(column: str) -> Column:
    return ratio(F.sum(f"_sum_{column}"), F.sum(f"_cnt_{column}"))


def mean_amount(column: str) -> Column:
    return ratio(from_cents(F.sum(f"_sum_{column}")), F.sum(f"_cnt_{column}"))


def rate(condition: Column) -> Column:
    """Fraction of counted rows whose value meets a condition."""
    return ratio(F.sum(F.when(condition, F.col("_n")).otherwise(0)), F.sum("_n"))
