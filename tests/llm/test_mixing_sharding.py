"""Mixing against SQL, shards against their law."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from martloom.llm import mixing, sharding
from martloom.llm.sql import FAIR_MIX
from tests.llm.conftest import TEXTS


def test_mix_equals_sql(edge_docs, sized_docs):
    for docs in (edge_docs.dropDuplicates(["doc_id", "text"]), sized_docs):
        con = duckdb.connect()
        documents = docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})
        con.register("documents", documents)
        expected = con.execute(FAIR_MIX).fetchall()
        got = mixing.fair_queue(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
        assert Counter(map(tuple, got)) == Counter(expected)


def test_sources_come_near_their_targets(sized_docs):
    rows = mixing.fair_queue(sized_docs).select("source_size", "target", "size", "taken").collect()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    assert abs(sum(r["taken"] for r in rows) - 1.5 * total) < 40
    again = mixing.fair_queue(sized_docs.repartition(5)).select("source_size", "target", "size", "taken").collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_mixed_rows_come_as_often_as_taken(edge_docs, empty_docs):
    mixed = mixing.mixed(edge_docs)
    assert mixed.columns == edge_docs.columns
    most = Counter(d for d, t, _ in TEXTS if t and t.split())
    for doc_id, n in Counter(r["doc_id"] for r in mixed.collect()).items():
        assert n <= 2 * most[doc_id]
    assert mixing.mixed(empty_docs).collect() == [] and mixing.fair_queue(empty_docs).collect() == []


@pytest.mark.parametrize("load", ["rows", "bytes"])
def test_shards_and_slots(edge_docs, sized_docs, empty_docs, load):
    for docs in (edge_docs, sized_docs):
        rows = sharding.shard_rows(docs, shards=7, load=load).collect()
        by_shard = Counter(r["shard"] for r in rows)
        assert len(rows) == docs.count()
        for shard, n in by_shard.items():
            assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
        if load == "rows":
            counts = [by_shard.get(s, 0) for s in range(7)]
            assert max(counts) - min(counts) <= 1
    if load == "bytes":
        held = Counter()
        for r in rows:
            held[r["shard"]] += r["size"]
        assert max(held.values()) - min(held.values()) < 0.2 * sum(held.values()) / 7
    assert sharding.shard_rows(empty_docs, load=load).collect() == []


def test_sizes_and_checksums(edge_docs):
    got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in sharding.shard_rows(edge_docs).collect())
    assert got == Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _ in TEXTS)


def test_placement_equals_a_walk_round_the_ring(sized_docs, edge_docs):
    """Row by row: in step k the shard of the k-th place clockwise takes the next rows of each arc while it has room."""
    from hashlib import md5

    def spot(r):
        text = f"{r.text_crc32}:text" if r.doc_id is None else f"{r.doc_id}"
        return int(md5(text.encode()).hexdigest()[:15], 16)

    for docs, slack in ((sized_docs, 0.0), (sized_docs, 0.2), (edge_docs, 0.0)):
        rows = sharding.shard_rows(docs, shards=9, nodes=8, slack=slack).collect()
        places, owners = sharding.ring(9, 8)
        arcs = [[] for _ in places]
        for r in sorted(rows, key=lambda r: (spot(r), r.doc_id or 0, r.text_crc32, r.size)):
            arcs[int(np.searchsorted(places, spot(r), side="left")) % len(places)].append(r)
        share = [len(rows) // 9 + (s < len(rows) % 9) for s in range(9)]
        room = [max(n, int(n * (1 + slack))) for n in share]
        slots, shard_of = Counter(), Counter()
        for step in range(len(places)):
            for a, arc in enumerate(arcs):
                shard = int(owners[(a + step) % len(places)])
                while arc and room[shard]:
                    r = arc.pop(0)
                    shard_of[r.doc_id, r.size, r.text_crc32, shard, slots[shard]] += 1
                    room[shard] -= 1
                    slots[shard] += 1
        assert shard_of == Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in rows)


def test_overflow_goes_clockwise():
    loads, owners = np.array([5, 1, 0, 2]), np.array([0, 1, 2, 0])
    runs = sharding.settle(loads, owners, np.array([3, 3, 2]))
    assert runs[0] == (0, 0, 3, 0, 0)  # the first arc fills its own shard
    assert sum(b - a for _, a, b, _, _ in runs) == 8
    assert [(arc, s) for arc, _, _, s, _ in runs[1:]] == [(1, 1), (0, 1), (3, 2)]


def test_few_rows_move_with_slack(sized_docs):
    docs = sized_docs.select("doc_id", "text")
    before = {r["doc_id"]: r["shard"] for r in sharding.shard_rows(docs, shards=10, slack=0.25).collect()}
    after = {r["doc_id"]: r["shard"] for r in sharding.shard_rows(docs, shards=11, slack=0.25).collect()}
    assert sum(before[d] != after[d] for d in before) < 0.25 * len(before)
