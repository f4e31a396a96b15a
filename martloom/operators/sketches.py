"""Mergeable summaries: distinct counts and quantiles of any number, stored per fine group and rolled up later.

A sketch has a fixed size and merges with others, so a month's sketch is written once and quarters, years or all
time come from the stored sketches, without the rows. Exact forms stay beside them: distinct counts by
two-level grouping, medians of whole numbers by histogram (`martloom.operators.spread`).

Errors: a distinct count is off by a relative standard error of `distinct_error(lg_k)`, by more than three
times that in under 1 % of cases; a quantile's rank is off by at most `rank_error(k)` of all rows with 99 %.
Merging does not add to either. NULLs are not counted; a group of NULLs only has an empty sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LG_K = 12
K = 400


def distinct_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def rank_error(k: int = K) -> float:
    """The published bound of the sketch for one quantile, at 99 % confidence."""
    return 2.296 / k**0.9021


def distinct_sketches(df: DataFrame, keys: list[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """One sketch of the distinct values per group, as binary column `sketch`."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"))


def distinct_rollup(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Merge stored sketches to coarser groups."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimate(sketch: str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile_sketches(df: DataFrame, keys: list[str], value: str, k: int = K) -> DataFrame:
    """One quantile sketch per group, as binary column `sketch`."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def quantile_rollup(sketches: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantile_estimate(p: float, sketch: str = "sketch") -> Column:
    """The value at rank `p`; NULL for an empty sketch."""
    known = F.kll_sketch_get_n_double(F.col(sketch)) > 0
    return F.when(known, F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(p)))
