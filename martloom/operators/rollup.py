"""Aggregates that collapse many rows to one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def distinct_list(label: str, separator: str = ",") -> Column:
    """Sorted, separated list of the distinct values in a group."""
    return F.concat_ws(separator, F.array_sort(F.collect_set(label)))


def heaviest(label: str, weight: str | Column, *tiebreak: Column) -> Column:
    """Label of the row with the largest weight, as an aggregate.

    Ties fall to the larger tie-break and at last to the larger label, so the pick never depends
    on row order. It combines map-side, unlike a ranking window that gathers each group's rows.
    """
    weight = F.col(weight) if isinstance(weight, str) else weight
    return F.max_by(F.col(label), F.struct(weight, *tiebreak, F.col(label)))


class Labels:
    """Aggregates over a label whose usual values are known, in primitive buffers.

    A set of known labels is a bit set, the heaviest row a packed number that sorts as (weight, tie-break, label)
    does. Both are plain hash aggregates of fixed size. Labels that are not on the list are rare: they have
    a place in the packed order too, and `others` treats them exactly, reading only their rows.
    """

    _SLOTS = 128  # places for labels in the packed order
    _TIES = 1 << 33  # places for the tie-break, a 32-bit whole number or NULL

    def __init__(self, column: str, known: tuple[str, ...]):
        self.column, self.known = column, tuple(sorted(known))
        if len(self.known) > 62:
            raise ValueError("a bit set holds 62 labels")

    def is_other(self) -> Column:
        label = F.col(self.column)
        return label.isNotNull() & ~label.isin(*self.known)

    def bits(self) -> Column:
        """The known labels of a group, as an aggregate."""
        chain = F.when(F.lit(False), F.lit(0).cast("bigint"))
        for i, name in enumerate(self.known):
            chain = chain.when(F.col(self.column) == name, F.lit(1 << i).cast("bigint"))
        return F.coalesce(F.bit_or(chain), F.lit(0).cast("bigint"))

    def listed(self, bits: str) -> Column:
        """The known labels in a bit set, sorted."""
        given = [F.when(F.col(bits).bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.lit(name)) for i, name in enumerate(self.known)]
        return F.array_compact(F.array(*given))

    def _slot(self) -> Column:
        """Even for known labels, odd for the gaps between them, 0 for none; larger for larger labels."""
        label = F.col(self.column)
        chain = F.when(label.isNull(), F.lit(0))
        for i, name in enumerate(self.known):
            chain = chain.when(label == name, F.lit(2 * i + 2))
        below = reduce(lambda a, b: a + b, [F.when(label > name, 2).otherwise(0) for name in self.known])
        return chain.otherwise(below + 1)

    def packed(self, weight: str, lower_first: str) -> Column:
        """A number in the order of (weight, smaller `lower_first`, label), to be aggregated with `max`.

        The weight counts in millionths, a missing `lower_first` comes after all others.
        """
        ties = F.coalesce(F.lit((1 << 31) - 1) - F.col(lower_first).cast("bigint") + 1, F.lit(0).cast("bigint"))
        low = (ties * self._SLOTS + self._slot()).cast("decimal(14,0)")
        whole = F.rint(F.col(weight) * 1_000_000).cast("decimal(24,0)")
        return (whole * F.lit(self._TIES * self._SLOTS).cast("decimal(13,0)") + low).cast("decimal(38,0)")

    def winner(self, key: str, of_others: Column) -> Column:
        """The label in a packed number; that of `of_others` if the heaviest row's label is not on the list."""
        slot = F.pmod(F.col(key), F.lit(self._SLOTS).cast("decimal(38,0)")).cast("int")
        names = F.array(*[F.lit(n) for n in self.known])
        return F.when(slot % 2 == 1, of_others).when(slot > 0, F.get(names, F.floor(slot / 2).cast("int") - 1))

    def others(self, rows: DataFrame, by: str, weight: str, lower_first: str) -> DataFrame:
        """Per group with labels not on the list: those labels (`other_labels`) and the heaviest one (`other_winner`)."""
        found = rows.filter(self.is_other()).groupBy(by, self.column).agg(F.max(self.packed(weight, lower_first)).alias("_key"))
        listed = found.groupBy(by).agg(F.collect_list(F.struct("_key", self.column)).alias("_rows"))
        return listed.select(
            by,
            F.transform("_rows", lambda r: r[self.column]).alias("other_labels"),
            F.array_max("_rows")[self.column].alias("other_winner"),
        )
