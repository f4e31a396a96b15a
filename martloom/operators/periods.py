"""Period comparisons and trailing windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.functions import cents, from_cents, month_index, pct_change


def with_period_change(df: DataFrame, month: str, value: str, outputs: dict[str, int]) -> DataFrame:
    """Percent change against the row `lag` calendar months earlier, NULL when that month is missing.

    `df` holds one row per month. A range frame of width one on the month number finds the earlier
    month in the same pass, where a self-join would read the series again for every lag.
    """
    calendar = Window.orderBy(month_index(month))
    changes = {
        name: pct_change(value, F.max(value).over(calendar.rangeBetween(-lag, -lag)))
        for name, lag in outputs.items()
    }
    return df.withColumns(changes)


def with_rolling_sum(
    df: DataFrame, month: str, value: str, outputs: dict[str, int], calendar: bool = False
) -> DataFrame:
    """Sum of an amount over the last `width` rows, or over the last `width` calendar months."""
    order = Window.orderBy(month_index(month) if calendar else F.col(month))

    def frame(width: int):
        return order.rangeBetween(-(width - 1), 0) if calendar else order.rowsBetween(-(width - 1), 0)

    return df.withColumns({name: from_cents(F.sum(cents(value)).over(frame(width))) for name, width in outputs.items()})


def latest(df: DataFrame, instant: str) -> Column:
    """The newest value of a column, as a one-value subquery usable in any expression on the frame."""
    return df.agg(F.max(instant).alias("anchor")).scalar()


def trailing_months(df: DataFrame, instant: str, months: int) -> DataFrame:
    """Rows of the last `months` months before the newest row, which is kept as `anchor_date`.

    The bound is known before the main scan starts, so the scan filters while it reads.
    """
    anchor = latest(df, instant)
    recent = df.filter(F.col(instant) >= F.add_months(anchor, -months))
    return recent.withColumn("anchor_date", anchor)
