"""Near-duplicate vectors by spherical-cap filters.

Filters are directions built from a random product code: a vector is cut into `BLOCKS` blocks, each block has
a codebook of random unit vectors, and a direction is one word of each codebook, so few random numbers make
very many directions. A vector falls into every filter whose direction it exceeds a threshold for; the list
decoder finds them without trying all, as it extends a choice of words only while the best the remaining
blocks can add still reaches the threshold. Vectors meet in a join on filters, and each pair that meets is
verified by its cosine in double precision.

The number of directions grows with the number of vectors, so filters stay as full as they are on small
tables. The threshold comes from the exact tail of a coordinate on the sphere, and the filters of a vector grow
in number as the chance to share one falls, so a pair at the wanted cosine shares as many on any table. Vectors
are turned by a random rotation first, so that no block holds most of a vector. Equal vectors are one class and
are counted, not paired.

Null vectors, zero vectors, and vectors with null or non-finite components are linked with nothing. So are
vectors of another length than most: a pair must have equal lengths. Labels and other columns are ignored.
Vectors close to each other are counted pair by pair, since the number of links is asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martloom.llm.support import Workspace, components

BLOCKS = 3
CODES = 8  # independent codes: a vector that one code serves badly meets its neighbours in another
SHARED_EACH = 8  # filters of a code that a pair at the wanted cosine shares, on average
FILLED = 2.0  # vectors in a filter, on average, where the length of vectors allows it
LEAST_SHARED = 0.25  # share of a vector's filters that such a pair has in common, at least
SHORT, SHORT_SHARED = 12, 0.4  # vectors up to this length need wider caps: their blocks differ much in length
STEPS = 4096  # of the numeric integrals
PATHS = 1 << 22  # choices of words that are extended at once
SEED = 11
POSTING_ROW = "node bigint, filter bigint"


class ProductCode:
    """Codebooks for one length of vectors."""

    def __init__(self, size: int, words: int, threshold: float, seed: int):
        blocks = blocks_of(size)
        draw = np.random.default_rng(seed)
        self.turn = np.linalg.qr(draw.standard_normal((size, size)))[0]
        self.cuts = np.array_split(np.arange(size), blocks)
        self.books = []
        for cut in self.cuts:
            book = draw.standard_normal((words, len(cut)))
            self.books.append(book / np.linalg.norm(book, axis=1, keepdims=True) / math.sqrt(blocks))
        self.words, self.threshold = words, threshold

    def decode(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, filter) of all directions that the unit vectors exceed the threshold for, in parts."""
        part = max(1, PATHS // self.words)
        for start in range(0, len(vectors), part):
            turned = vectors[start : start + part] @ self.turn
            gains = [turned[:, cut] @ book.T for cut, book in zip(self.cuts, self.books)]
            best = [g.max(1) for g in gains]
            rooms = [sum(best[k + 1 :], np.zeros(len(turned))) for k in range(len(gains))]
            none = np.zeros(len(turned))
            for row, chosen in self._extend(gains, rooms, 0, np.arange(len(turned)), none.astype(np.int64), none):
                yield row + start, chosen

    def _extend(self, gains: list, rooms: list, k: int, row: np.ndarray, chosen: np.ndarray, total: np.ndarray) -> Iterator:
        """Extend choices by the words of block `k`; a bounded number at once, so that memory is."""
        if k == len(gains):
            yield row, chosen
            return
        part = max(1, PATHS // self.words)
        for start in range(0, len(row), part):
            here = slice(start, start + part)
            least = self.threshold - total[here] - rooms[k][row[here]]
            at, word = np.nonzero(gains[k][row[here]] >= least[:, None])
            yield from self._extend(gains, rooms, k + 1, row[here][at], chosen[here][at] * self.words + word, total[here][at] + gains[k][row[here][at], word])


def blocks_of(size: int) -> int:
    """Short vectors are cut into fewer blocks, as blocks of few components differ much in length."""
    return 1 if size <= SHORT // 2 else min(2, BLOCKS) if size <= SHORT else BLOCKS


def tail(size: int, least: np.ndarray | float) -> np.ndarray:
    """Share of the unit vectors of a length whose first component is `least` or more."""
    if size < 2:
        return np.select([np.less_equal(least, -1), np.less_equal(least, 1)], [1.0, 0.5], 0.0)
    angles = (np.arange(STEPS) + 0.5) * math.pi / STEPS
    weights = np.sin(angles) ** (size - 2)
    edges = np.linspace(0, math.pi, STEPS + 1)
    below = np.concatenate([[0.0], np.cumsum(weights)])
    return np.interp(np.arccos(np.clip(least, -1, 1)), edges, below / below[-1])


def common(size: int, threshold: float, cosine: float) -> float:
    """How often a direction that exceeds the threshold for a vector does so for another at that cosine."""
    widest = math.acos(threshold)
    angles = (np.arange(STEPS) + 0.5) * widest / STEPS
    weights = np.sin(angles) ** (size - 2)
    along, across = np.cos(angles), np.sin(angles)
    rest = (threshold - cosine * along) / (math.sqrt(1 - cosine * cosine) * across)
    return float(weights @ tail(size - 1, rest) / weights.sum())


def product_codes(size: int, vectors: int, cosine: float = 0.95) -> list[ProductCode]:
    """As many directions as keep filters at `FILLED` vectors and let a pair at `cosine` share `SHARED_EACH` of a code.

    Caps hold `FILLED` of the vectors. Where such caps are so narrow that the pair would hardly ever share one
    (short vectors, very large tables), they are as wide as `LEAST_SHARED` needs, and hold more.
    """
    cosine = min(cosine, 1 - 1e-9)
    if size < 2 or cosine <= -1:
        return [ProductCode(size, 2, -1.0, SEED)]  # all vectors meet
    shared = SHORT_SHARED if size <= SHORT else LEAST_SHARED
    low, high = -1.0 + 1e-9, 1.0 - 1e-9
    for _ in range(60):
        threshold = (low + high) / 2
        narrow = tail(size, threshold) < min(0.5, FILLED / max(vectors, 1)) or common(size, threshold, cosine) < shared
        low, high = (low, threshold) if narrow else (threshold, high)
    each = SHARED_EACH / common(size, low, cosine)
    words = max(8, math.ceil((each / float(tail(size, low))) ** (1 / blocks_of(size))))
    return [ProductCode(size, words, low, SEED + k) for k in range(CODES)]


def usable(vectors: DataFrame) -> DataFrame:
    """Rows with a finite vector other than zero, as doubles in binary form, of length 1."""

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(1).to_pylist():
                v = None
                if x and None not in x:
                    v = np.array(x, float)
                    largest = np.abs(v).max()
                    v = v / largest if 0 < largest < math.inf else None
                out.append(None if v is None else (v / np.linalg.norm(v)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "unit"])

    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(normal, "vec_id bigint, unit binary")


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """Per vector: vec_id, n_links, component_id (the smallest id that links lead to) and kept."""
    work = Workspace(vectors.sparkSession, "cap-filters")
    rows = work.table(usable(vectors).withColumn("name", F.sha2("unit", 256)), "vectors")
    groups = rows.where("unit is not null").groupBy("name").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    firsts = work.table(groups.withColumn("node", F.xxhash64("name")), "classes")
    units = rows.where("unit is not null").select("name", "unit").dropDuplicates(["name"])
    classes = work.table(firsts.join(units, "name"), "units")
    sizes = {r["size"]: r["n"] for r in classes.groupBy(F.octet_length("unit").alias("size")).agg(F.count("*").alias("n")).collect()}
    codes = {size: product_codes(size // 8, n, cosine) for size, n in sizes.items()}

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            raw = batch.column(1).to_pylist()
            for size in {len(x) for x in raw}:
                at = np.flatnonzero([len(x) == size for x in raw])
                vectors = np.stack([np.frombuffer(raw[k]) for k in at])
                for k, code in enumerate(codes[size]):
                    for row, chosen in code.decode(vectors):
                        # codes and lengths have filters of their own
                        number = ((chosen * CODES + k) << 16) + size // 8 % 65536
                        yield pa.RecordBatch.from_arrays([pa.array(nodes[at][row]), pa.array(number)], names=["node", "filter"])

    postings = work.table(classes.select("node", "unit").mapInArrow(decode, POSTING_ROW), "postings")
    met = postings.select("filter", F.col("node").alias("a")).join(postings.select("filter", F.col("node").alias("b")), "filter")
    pairs = met.where("a < b").select("a", "b").distinct()
    left = classes.select(F.col("node").alias("a"), F.col("unit").alias("ua"))
    right = classes.select(F.col("node").alias("b"), F.col("unit").alias("ub"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [len(x) == len(y) and float(np.frombuffer(x) @ np.frombuffer(y)) >= cosine for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ua", "ub")
    links = work.table(joined.mapInArrow(verify, "a bigint, b bigint"), "links")
    counts = classes.select("node", "copies")
    towards = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    linked = towards.join(counts.select(F.col("node").alias("other"), "copies"), "other").groupBy("node").agg(F.sum("copies").alias("others"))
    rooted = classes.select("name", "node", "copies", "least").join(components(work, links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    known = (
        rooted.join(least, "root")
        .join(linked, "node", "left")
        .select("name", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component")
    )
    component = F.when(F.col("unit").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return (
        rows.join(known, "name", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
