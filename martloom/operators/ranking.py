"""Shares, ranks and an exact global percent rank that never sorts everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from martloom.functions import cents, from_cents, ratio


def with_share(df: DataFrame, within: str, value: str, output: str) -> DataFrame:
    """Amount as a fraction of its group total; NULL when the total is not positive."""
    total = from_cents(F.sum(cents(value)).over(Window.partitionBy(within)))
    return df.withColumn(output, ratio(value, total))


def with_dense_rank(df: DataFrame, within: str | None, by: str, output: str) -> DataFrame:
    """Dense rank by a descending value. The frame is an aggregate: one row per group member."""
    window = Window.partitionBy(within) if within else Window
    return df.withColumn(output, F.dense_rank().over(window.orderBy(F.desc(by))))


_BEFORE_ALL = -(2**63)


def _counts_below(values: DataFrame, bits: int) -> DataFrame:
    """For each distinct integer `v` with its count `n`, the number of rows with a smaller value, and
    the number of all rows.

    Running counts over three nested value ranges. A range of `2**bits` integers holds at most that
    many distinct values however many rows share them, so every window group has a fixed bound.
    """
    ranges = values.withColumns({"_mid": F.shiftright("v", bits), "_top": F.shiftright("v", 2 * bits)})
    mids = ranges.groupBy("_top", "_mid").agg(F.sum("n").alias("_mid_n"))
    tops = mids.groupBy("_top").agg(F.sum("_mid_n").alias("_top_n"))

    def before(total: str, group: list[str], order: str):
        window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(total).over(window), F.lit(0))

    tops = tops.select(
        "_top",
        before("_top_n", [], "_top").alias("_top_below"),
        F.sum("_top_n").over(Window.partitionBy()).alias("_rows"),
    )
    mids = mids.join(tops, "_top").select(
        "_mid", "_rows", (F.col("_top_below") + before("_mid_n", ["_top"], "_mid")).alias("_mid_below")
    )
    ranges = ranges.select("v", "_mid", before("n", ["_mid"], "v").alias("_below"))
    return ranges.join(mids, "_mid").select("v", "_rows", (F.col("_mid_below") + F.col("_below")).alias("_below"))


def with_percent_rank(df: DataFrame, value: str, output: str, scale: int = 2, bits: int = 21) -> DataFrame:
    """Global `percent_rank` over an ascending number with `scale` decimal digits, NULLs first.

    The built-in form needs a window without partitions, which puts every row in one task. Here the
    rows are counted per distinct value, running counts are taken over value ranges of bounded
    size, and the result joins back on the value. Value ranges come from the data alone, so a
    recomputed partition gives the same answer. A value many rows share makes a hot join key, which
    adaptive execution splits.

    `df` is read twice, by readers that need the same columns of it: where it ends in a shuffle, Spark reuses that.
    """
    whole = F.rint(F.col(value) * 10**scale).cast("bigint")
    keyed = df.withColumn("v", F.coalesce(whole, F.lit(_BEFORE_ALL)))
    every_row = F.xxhash64(*df.columns) % 1 == 0  # true, and names all columns, so that none is pruned below
    counted = keyed.groupBy("v").agg(F.count_if(every_row).alias("n"))
    others = (F.col("_rows") - 1).cast("double")
    return (
        keyed.join(_counts_below(counted, bits), "v")
        .withColumn(output, F.when(others > 0, F.col("_below").cast("double") / others).otherwise(0.0))
        .drop("v", "_below", "_rows")
    )
