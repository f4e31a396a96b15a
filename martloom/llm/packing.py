"""Best-fit packing of documents into sequences, after Martello and Toth's reduction.

Only lengths matter for packing, and there are at most `capacity` of them. Spark counts pieces per length; the
instance is that histogram, bounded by the capacity whatever the corpus. The driver reduces and packs it into
patterns with multiplicities; Spark numbers the pieces of each length and every piece finds its place by its
number. No row passes through the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm.support import Workspace, ring_hash, running_total, text_of
from martloom.llm.tokens import encoder

PIECE_ROW = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Encode whole texts, append `end_id`, cut what is longer than `capacity`.

    A null text is empty; null ids stay null; repeated rows are packed each. Other columns are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(batch.column(1).to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text")).mapInArrow(cut, PIECE_ROW)


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[tuple[int, int], ...], int]], dict[int, int]]:
    """Martello-Toth reduction: fix sets that dominate every other set with the same largest piece.

    Returns the fixed patterns, as ((length, copies), ...) with how many sequences take it, and what is left.
    For the longest piece `j` and the room `r` beside it, a set is fixed when
    * nothing fits beside it: {j};
    * a piece fills the room exactly: {j, i};
    * no two pieces fit together: {j, i}, i the longest that fits;
    * no three fit together: {j, i, s}, s the longest that fits with j and i, if s is at least as long as any
      piece that can be the shorter one of two in the room.
    Each of them can replace, piece by piece, any other set with `j` without using more sequences.
    """
    left = {k: n for k, n in counts.items() if n}
    sizes = sorted(left)
    fixed: list[tuple[tuple[tuple[int, int], ...], int]] = []

    def take(*lengths: int) -> None:
        need = Counter(lengths)
        times = min(left[k] // n for k, n in need.items())
        fixed.append((tuple(need.items()), times))
        for k, n in need.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
                sizes.pop(bisect_left(sizes, k))

    def longest(room: int, used: tuple[int, ...]) -> int | None:
        """The longest length up to `room` of which more are left than `used` takes."""
        at = bisect_right(sizes, room) - 1
        while at >= 0 and left[sizes[at]] <= used.count(sizes[at]):
            at -= 1
        return sizes[at] if at >= 0 else None

    def shortest(used: tuple[int, ...], n: int) -> int:
        """The sum of the `n` shortest pieces besides `used`."""
        total, got = 0, 0
        for k in sizes:
            more = min(left[k] - used.count(k), n - got)
            total, got = total + k * more, got + more
            if got == n:
                return total
        return capacity + 1

    for j in sorted(left, reverse=True):
        while left.get(j):
            room = capacity - j
            i = longest(room, (j,))
            if i is None:
                take(j)
            elif i == room or shortest((j,), 2) > room:
                take(j, i)
            elif shortest((j,), 3) > room and (s := longest(room - i, (j, i))) and s >= (longest(room // 2, (j,)) or 0):
                take(j, i, s)
            else:
                break
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best-fit decreasing over a histogram: equal sequences are kept as one pattern with a number."""
    open_by_room: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: tuple, n: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append([pattern, n])

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                full, rest = divmod(n, each)
                if full:
                    put(capacity - each * size, ((size, each),), full)
                if rest:
                    put(capacity - rest * size, ((size, rest),), 1)
                break
            room = rooms[at]
            pattern, m = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(at)
            # pieces of one length go on filling the sequence they went into: it is the tightest
            each = room // size
            full = min(m, n // each)
            if full:
                put(room - each * size, (*pattern, (size, each)), full)
                n -= full * each
            elif n:
                put(room - n * size, (*pattern, (size, n)), 1)
                full, n = 1, 0
            if m > full:
                put(room, pattern, m - full)
    return [(pattern, n) for groups in open_by_room.values() for pattern, n in groups]


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Places by length: (length, from number, to number, copies a sequence, first sequence, offset), and
    the number of sequences."""
    fixed, left = reduce_instance(counts, capacity)
    places, used, base = [], Counter(), 0
    for pattern, times in fixed + best_fit(left, capacity):
        offset = 0
        for length, copies in pattern:
            lo = used[length]
            used[length] = hi = lo + copies * times
            places.append((length, lo, hi, copies, base, offset))
            offset += length * copies
        base += times
    return places, base


def pack(spark: SparkSession, cut: DataFrame, capacity: int = 4096) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces. Their `length` lies in 1..capacity.

    The histogram has at most `capacity` rows, and the places a few times as many: both are bounded by the
    capacity, so they may pass the driver and be broadcast.
    """
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places, _ = plan(counts, capacity)
    where = spark.createDataFrame(places, "place_length bigint, lo bigint, hi bigint, copies bigint, base bigint, first bigint")
    keyed = cut.withColumn("spot", ring_hash(F.col("doc_id"), F.col("piece")))
    ties = ["doc_id", "piece", "ids_crc32", "start"]
    numbered = running_total(keyed.withColumn("one", F.lit(1)), "length", "spot", ties, "one", "number")
    inside = (F.col("length") == F.col("place_length")) & (F.col("number") >= F.col("lo")) & (F.col("number") < F.col("hi"))
    nth = F.col("number") - F.col("lo")
    return numbered.join(F.broadcast(where), inside).select(
        *cut.columns,
        (F.col("base") + F.floor(nth / F.col("copies"))).cast("bigint").alias("sequence_id"),
        (F.col("first") + (nth % F.col("copies")) * F.col("length")).cast("bigint").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Encode, cut and pack all documents; pieces are written once, as they are read three times."""
    spark = docs.sparkSession
    cut = Workspace(spark, "packing").table(pieces(docs, tokenizer, end_id, capacity), "pieces")
    return pack(spark, cut, capacity)
