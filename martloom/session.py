"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every plan here relies on. Adaptive execution coalesces small shuffle partitions,
# turns a shuffled join into a broadcast one when the measured side is small, and splits the
# partitions that a hot join key overfills, also where that costs one more shuffle behind the join.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # counts of stored tables come from file footers where a query asks for them that way
    "spark.sql.parquet.aggregatePushdown": "true",
}
# For the retail queries. Partitions of this size as compressed bytes take some hundred megabytes in the tables of an
# aggregate. A join's smaller side is hashed where all its partitions are small; larger ones are sorted.
PARTITION_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
}
# UTC for zoned text; room for the compiled code of many marts, so that a session that builds them in
# turn does not compile each stage again; no call-site capture, which costs several driver round trips
# per column.
SESSION_SETTINGS = {
    **ADAPTIVE_SETTINGS,
    **PARTITION_SETTINGS,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switch the adaptive settings on in a session made elsewhere."""
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def bound_partitions(spark: SparkSession) -> SparkSession:
    """Bound what a task holds in a session made elsewhere, unless that names sizes of its own."""
    for key, value in PARTITION_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "martloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_scratch: list[str] = []


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder the session names in `spark.checkpoint.dir`.

    Every executor must see it. Only a local master, where driver and executors are one
    machine, falls back to a temporary folder when nothing is set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _local_scratch:
            _local_scratch.append(tempfile.mkdtemp(prefix="run-"))
        shared = _local_scratch[0]
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
