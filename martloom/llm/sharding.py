"""Shards by consistent hashing with virtual nodes and bounded loads.

Every shard owns `nodes` places on a ring. A row goes to the next place clockwise of its own; what a full
shard cannot take continues clockwise. With `slack` 0 every shard gets its exact share, so counts are at most
one apart; with more slack fewer rows move when a shard is added.

Loads are added up per arc of the ring (shards x nodes arcs, whatever the number of rows) and the overflow
is settled on those sums: each arc is cut into runs, and a run goes to one shard. A row finds its run by the
load before it in its arc, which is a prefix sum over slices of the arc. No row passes through the driver.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from martloom.llm.support import Workspace, ring_hash, running_total, text_of

RUN = "run_arc int, lo bigint, hi bigint, shard int, slot_base bigint"


def ring(shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Places on the ring in ascending order, and the shard that owns each."""
    owned = sorted((int(md5(f"shard {s} node {v}".encode()).hexdigest()[:15], 16), s) for s in range(shards) for v in range(nodes))
    return np.array([p for p, _ in owned]), np.array([s for _, s in owned])


def settle(loads: np.ndarray, owners: np.ndarray, capacities: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Runs (arc, from, to, shard, load of the shard before): where the load of each arc goes.

    Step by step: in step k every arc offers what it still has to the k-th place clockwise, and the shard there
    takes what it has room for. What is left goes on.
    """
    room, taken = capacities.astype("i8").copy(), np.zeros(len(loads), "i8")
    filled = np.zeros(len(capacities), "i8")
    runs = []
    for step in range(len(loads)):
        open_arcs = np.flatnonzero(taken < loads)
        if not len(open_arcs):
            break
        for arc in open_arcs.tolist():
            shard = int(owners[(arc + step) % len(loads)])
            part = int(min(loads[arc] - taken[arc], room[shard]))
            if part:
                runs.append((arc, int(taken[arc]), int(taken[arc]) + part, shard, int(filled[shard])))
                taken[arc] += part
                room[shard] -= part
                filled[shard] += part
    return runs


def shard_rows(docs: DataFrame, shards: int = 40, nodes: int = 64, slack: float = 0.0, load: str = "rows") -> DataFrame:
    """Add `shard` and `slot`, its gapless place there, to the sizes of all documents.

    `load` is what is kept in bounds: `rows`, exactly, or `bytes`, to within a document for each run. Returns
    doc_id, size, text_crc32, shard, slot. A null text counts as empty; a row without an id has its place by its
    text; rows with one id share a place on the ring and are told apart by their texts.
    """
    places, owners = ring(shards, nodes)

    @F.pandas_udf("int")
    def arc_of(spot: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(places, spot.to_numpy(), side="left") % len(places)).astype("int32")

    sized = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text_of()) + 16).cast("bigint").alias("size"),
        F.crc32(F.encode(text_of(), "UTF-8")).alias("text_crc32"),
    ).withColumn("spot", F.when(F.col("doc_id").isNull(), ring_hash(F.col("text_crc32"), F.lit("text"))).otherwise(ring_hash(F.col("doc_id"))))
    work = Workspace(docs.sparkSession, "sharding")
    rows = work.table(sized.withColumn("arc", arc_of("spot")).withColumn("load", F.lit(1) if load == "rows" else F.col("size")), "sizes")
    loads = np.zeros(len(places), "i8")
    for r in rows.groupBy("arc").agg(F.sum("load").alias("load")).collect():  # a row for each arc at most
        loads[r["arc"]] = r["load"]
    total = int(loads.sum())
    share = np.full(shards, total // shards) + (np.arange(shards) < total % shards)
    capacities = np.maximum(share, np.floor(share * (1 + slack)).astype("i8"))
    runs = settle(loads, owners, capacities)
    where = F.broadcast(docs.sparkSession.createDataFrame(runs, RUN))  # runs are bounded by arcs and shards
    ties = ["doc_id", "text_crc32", "size"]
    before = running_total(rows, "arc", "spot", ties, "load", "before")
    inside = (F.col("arc") == F.col("run_arc")) & (F.col("before") >= F.col("lo")) & (F.col("before") < F.col("hi"))
    placed = before.join(where, inside)
    if load == "rows":
        placed = placed.withColumn("slot", F.col("slot_base") + F.col("before") - F.col("lo"))
    else:
        placed = running_total(placed.withColumn("one", F.lit(1)), "shard", "spot", ties, "one", "slot")
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot")
