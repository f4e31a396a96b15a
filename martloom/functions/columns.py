"""Column expressions shared by the marts. All are built-in Spark expressions.

Casts of input are `try_cast`: a malformed value becomes NULL instead of failing the job under ANSI mode.

Money is a DOUBLE in tables and whole cents (BIGINT) inside every sum. Long sums stay in primitive
hash-aggregate buffers, are exact, and do not depend on the order rows arrive in; dividing the result
by 100 gives the double nearest to the true amount.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c):
    return _col(c).cast("string")


def as_int(c):
    return _col(c).try_cast("int")


def as_money(c):
    """An amount; what is no finite number is malformed, so NULL, and rules see it as missing."""
    amount = _col(c).try_cast("double")
    return F.when(F.abs(amount) < float("inf"), amount)


def cents(c):
    """Whole cents. Strict: an amount that does not fit stops the job rather than leave a sum without it."""
    return F.rint(_col(c) * 100).cast("bigint")


def from_cents(c):
    return _col(c).cast("double") / 100.0


def money_sum(c):
    """Exact sum of an amount, as an aggregate."""
    return from_cents(F.sum(cents(c)))


def money_add(a, b):
    return from_cents(cents(a) + cents(b))


def money_diff(a, b):
    return from_cents(cents(a) - cents(b))


def exact_mean(c, factor: int = 1):
    """Mean of a number that is not negative, times `factor`, rounded half up to two digits, as an aggregate.

    Values count in whole millionths, so the result does not depend on the order rows arrive in.
    """
    value = F.rint(_col(c) * factor * 1_000_000).cast("decimal(38,0)")
    twice, n = F.sum(value) * 2 + F.count(value) * 10_000, F.count(value)
    unit = n * 20_000
    return F.when(n > 0, ((twice - twice % unit) / unit).cast("double") / 100.0)


def as_instant(c):
    """Zone-free timestamp from text, date or timestamp; NULL when it cannot be read."""
    return _col(c).try_cast("timestamp_ntz")


def snapshot(as_of: str | None = None):
    """When the figures were made: now, or a given zone-free instant, so that two runs can be compared."""
    return as_instant(F.lit(as_of)) if as_of else F.current_timestamp()


def clean_lower(c):
    return F.lower(F.trim(_col(c)))


def clean_upper(c):
    return F.upper(F.trim(_col(c)))


def day(c):
    return F.to_date(_col(c))


def month_start(c):
    """First day of the month as DATE: a stable key, free of time zones."""
    return F.trunc(day(c), "MM")


def month_index(c):
    """Months since year 0, so that arithmetic on it is calendar arithmetic."""
    return F.year(_col(c)) * 12 + F.month(_col(c))


def day_delta(end, start):
    """Whole days from `start` to `end`; NULL when either is missing."""
    return F.datediff(day(end), day(start))


def flag(condition: Column) -> Column:
    """1 where the condition is true, else 0; an unknown condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def ratio(numerator, denominator):
    """Double quotient; NULL unless the denominator is positive."""
    num, den = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(den > 0, num / den)


def pct_change(now, before):
    now, before = _col(now).cast("double"), _col(before).cast("double")
    return F.when(before > 0, (now - before) / before * 100.0)


def first_match(rules: list[tuple[Column, object]], default: object = None) -> Column:
    """CASE over (condition, label) pairs, first true one wins."""
    head, *tail = rules
    chain = reduce(lambda acc, rule: acc.when(rule[0], F.lit(rule[1])), tail, F.when(head[0], F.lit(head[1])))
    return chain if default is None else chain.otherwise(F.lit(default))


def absent(*names: str, kind: str = "string") -> list[Column]:
    """Typed NULL columns for a dimension that is not available."""
    return [F.lit(None).cast(kind).alias(n) for n in names]


def published(df: DataFrame) -> DataFrame:
    """Table form for readers: decimals become DOUBLE, zoned timestamps become zone-free."""

    def outward(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select(*[outward(f) for f in df.schema.fields])
