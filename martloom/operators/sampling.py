"""Repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_DIGITS = 15  # hexadecimal digits of a digest that decide: 60 bits


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Independent draw per row."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_key(df: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """Keep all rows of a fixed fraction of keys.

    Tables sampled on the same key keep their pairing, which independent row samples break. The
    choice depends on the key's digest only: no shuffle, and the same keys in every run. Digests of one
    length compare as text as they do as numbers.
    """
    if fraction >= 1:
        return df.filter(F.col(key).isNotNull())
    digest = F.md5(F.concat(F.lit(salt), F.col(key).cast("string")).cast("binary"))
    return df.filter(F.substring(digest, 1, _DIGITS) < f"{int(fraction * 16**_DIGITS):0{_DIGITS}x}")
