"""Token ids as flat binary files.

A folder holds, for each shard, three flat little-endian files and one manifest for all:

* `tokens-*.bin`: ids one after another, unsigned 16-bit where the vocabulary fits, else 32-bit;
* `offsets-*.idx`: unsigned 64-bit offsets into the shard's ids, one more than it has documents;
* `docs-*.ids`: signed 64-bit document ids;
* `manifest.json`: width, and for each shard its files, counts and base, the ids in all shards before it.

A document's place in the corpus is the base of its shard plus its offset there. Bases are prefix sums over
one row per shard. Files can be memory-mapped; nothing has to be parsed.

Nulls: a null text is an empty document (only the end id). Rows with a null id come first; the manifest counts
them per shard. Rows with the same id follow each other in the order of a hash of their texts. An empty table
gives a manifest without shards. Other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm.support import text_of
from martloom.llm.tokens import encoder

SHARD_ROW = "shard int, name string, n_docs bigint, n_null bigint, n_tokens bigint"
DIGEST_ROW = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
IDS_ROW = "doc_id bigint, start bigint, ids array<bigint>"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> dict:
    """Encode all texts and write them in ascending order of `doc_id`; returns the manifest.

    Texts move once, range-partitioned by id. Each task writes a shard under names of its own, so a repeated
    attempt never touches the files of another; the manifest lists the attempts that counted.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(F.asc_nulls_first("doc_id"), "tie")
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = uuid.uuid4().hex
        files, width = _Shard(folder, name), _width(tokenizer)
        n_docs = n_null = n_tokens = 0
        for batch in batches:
            ids = batch.column(0)
            end = np.array([end_id], "<u4").tobytes()
            encoded = [x + end for x in encoder(tokenizer).encode(batch.column(1).to_pylist())]
            lengths = np.array([len(x) // 4 for x in encoded], "<u8")
            files.add(
                np.frombuffer(b"".join(encoded), "<u4").astype(width).tobytes(),
                (np.cumsum(lengths, dtype="<u8") + np.uint64(n_tokens)).astype("<u8").tobytes(),
                ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
            )
            n_docs += len(ids)
            n_null += ids.null_count
            n_tokens += int(lengths.sum())
        files.close()
        if n_docs:
            row = [[TaskContext.get().partitionId()], [name], [n_docs], [n_null], [n_tokens]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.string(), *[pa.int64()] * 3))], names=["shard", "name", "n_docs", "n_null", "n_tokens"])

    # one row for each task: as many as there are partitions, whatever the number of documents
    shards = sorted(ordered.mapInArrow(write, SHARD_ROW).collect(), key=lambda r: r["shard"])
    bases = np.cumsum([0, *(r["n_tokens"] for r in shards)]).tolist()
    manifest = {
        "dtype": _width(tokenizer),
        "shards": [{"name": r["name"], "n_docs": r["n_docs"], "n_null": r["n_null"], "n_tokens": r["n_tokens"], "base": b} for r, b in zip(shards, bases)],
    }
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path)
    with system.open_output_stream(f"{path}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document its id, place, number of ids and the CRC-32 of its ids as 32-bit integers."""

    def digest(doc_ids, starts, ids, offsets):
        crcs = [zlib.crc32(np.ascontiguousarray(ids[a:b], "<u4")) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        return [doc_ids, pa.array(starts), pa.array(np.diff(offsets)), pa.array(crcs, pa.int64())]

    return _read(spark, folder, digest, DIGEST_ROW)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document its id, place and ids."""

    def whole(doc_ids, starts, ids, offsets):
        lists = pa.ListArray.from_arrays(pa.array((offsets - offsets[0]).astype("i4")), pa.array(ids[offsets[0] : offsets[-1]].astype("i8")))
        return [doc_ids, pa.array(starts), lists]

    return _read(spark, folder, whole, IDS_ROW)


def _read(spark: SparkSession, folder: str, columns, row: str) -> DataFrame:
    """Each task maps the files of its shards and hands out some hundred documents at a time."""
    system, path = fs.FileSystem.from_uri(folder)
    with system.open_input_stream(f"{path}/manifest.json") as file:
        manifest = json.loads(file.read())
    names = [x.split()[0] for x in row.split(", ")]
    dtype = manifest["dtype"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                ids = _mapped(f"{folder}/tokens-{shard['name']}.bin", dtype)
                offsets = np.concatenate([[0], _mapped(f"{folder}/offsets-{shard['name']}.idx", "<u8").astype("i8")])
                docs = _mapped(f"{folder}/docs-{shard['name']}.ids", "<i8")
                for a in range(0, len(docs), 500):
                    b = min(a + 500, len(docs))
                    null = np.arange(a, b) < shard["n_null"]
                    doc_ids = pa.array(np.asarray(docs[a:b]), pa.int64(), mask=null)
                    yield pa.RecordBatch.from_arrays(columns(doc_ids, offsets[a:b] + shard["base"], ids, offsets[a : b + 1]), names=names)

    shards = manifest["shards"]
    listed = spark.createDataFrame(
        [(s["name"], s["n_null"], s["base"]) for s in shards], "name string, n_null bigint, base bigint"
    )
    return listed.repartition(max(1, len(shards))).mapInArrow(read, row)


def _width(tokenizer: str) -> str:
    return "<u2" if encoder(tokenizer).vocabulary <= 1 << 16 else "<u4"


def _mapped(uri: str, dtype: str) -> np.ndarray:
    """A flat file as an array: mapped where the file system is local, else read."""
    system, path = fs.FileSystem.from_uri(uri)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype)


class _Shard:
    """The three files of one task, opened with the first documents."""

    def __init__(self, folder: str, name: str):
        self.folder, self.name, self.streams = folder, name, None

    def add(self, tokens: bytes, offsets: bytes, docs: bytes) -> None:
        if self.streams is None:
            system, path = fs.FileSystem.from_uri(self.folder)
            system.create_dir(path)
            self.streams = [
                system.open_output_stream(f"{path}/{kind}-{self.name}.{end}")
                for kind, end in (("tokens", "bin"), ("offsets", "idx"), ("docs", "ids"))
            ]
        for stream, data in zip(self.streams, (tokens, offsets, docs)):
            stream.write(data)

    def close(self) -> None:
        for stream in self.streams or ():
            stream.close()
