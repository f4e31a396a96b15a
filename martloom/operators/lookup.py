"""Enrichment and key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def enrich(
    facts: DataFrame,
    dimension: DataFrame,
    on: list[str],
    columns: list[str],
    broadcast_below: int | None = None,
) -> DataFrame:
    """Left join picked columns of a dimension that has one row per key.

    Catalyst broadcasts a side whose measured bytes are below its threshold. Otherwise both sides are
    shuffled on the key, and adaptive execution splits a fact partition that one hot key overfills.
    With `broadcast_below` the dimension gets a broadcast hint if the plan knows it to be smaller than that
    many bytes, whatever the session's threshold.
    """
    picked = dimension.select(*on, *columns)
    if broadcast_below is not None:
        picked = broadcast_if_below(picked, broadcast_below)
    return facts.join(picked, on=on, how="left")


# A hash table of rows takes more room than the same rows in compressed files.
GROWTH_IN_MEMORY = 4


def planned_bytes(df: DataFrame) -> int:
    """Bytes of a frame as the optimizer estimates them from file sizes and statistics. No job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_below(df: DataFrame, limit: int) -> DataFrame:
    """The frame with a broadcast hint if its estimate, grown to what it takes in memory, is below `limit` bytes.

    Estimates of joins and of data without statistics are far above the truth, never far below, so
    what is hinted is small; what is not hinted is joined as Catalyst sees fit, by shuffles if need be.
    """
    return F.broadcast(df) if planned_bytes(df) * GROWTH_IN_MEMORY < limit else df


def translate(
    df: DataFrame,
    dictionary: DataFrame,
    term: str,
    source: str,
    target: str,
    output: str,
    default: str,
) -> DataFrame:
    """Replace `term` by its dictionary entry, else keep it, else use the default."""
    entries = dictionary.select(F.col(source).alias(term), F.col(target).alias("_translated"))
    return (
        df.join(entries, on=term, how="left")
        .withColumn(output, F.coalesce("_translated", term, F.lit(default)))
        .drop("_translated")
    )


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows whose key no parent has; rows without a key are orphans too."""
    return children.join(parents.select(key), on=key, how="left_anti")


def grain(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Row count against distinct keys: equal when the frame has one row per key.

    Groups first, so that the distinct count is a plain count of partially combined groups.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("unique_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
    )


def share_of(condition: Column) -> Column:
    """Fraction of rows that meet a condition; unknown counts as not met."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))
