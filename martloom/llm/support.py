"""Shared pieces of the corpus operators: written intermediate tables, prefix sums, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martloom.session import scratch_dir, tune

# Fixed value: what separates words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = b" \t\n\r\x0b\x0c"
# Fixed table: A-Z to a-z on bytes, all else as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def prepared(spark: SparkSession) -> SparkSession:
    """Adaptive execution on, and small Arrow batches, so that very long texts cannot fill a worker."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


class Workspace:
    """A fresh folder in the shared scratch space. Tables written here cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = scratch_dir(spark, name)
        self._steps = 0

    def folder(self, name: str) -> str:
        self._steps += 1
        return f"{self.path}/{self._steps:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` and read it back."""
        path = self.folder(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables of this workspace that nothing reads any more."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for table in tables:
            for file in {f.rpartition("/")[0] for f in table.inputFiles()}:
                if self.path.rpartition("/")[2] in file:
                    path = jvm.org.apache.hadoop.fs.Path(file)
                    path.getFileSystem(conf).delete(path, True)


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ring_hash(*columns: Column) -> Column:
    """A 60-bit position from MD5, the same in every engine."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def running_total(df: DataFrame, group: str, position: str, ties: list[str], value: str, out: str, slices: int = 1024) -> DataFrame:
    """Add `out`: the sum of `value` over the earlier rows of the same group, ordered by `position` and `ties`.

    `position` is an evenly spread 60-bit number. Each group is cut into slices of that range; sums per
    slice are added up first (at most `slices` rows a group), then rows only meet the rows of their own
    slice, so no task orders a whole group. `group` must not be null.
    """
    width = (1 << 60) // slices
    sliced = df.withColumn("__slice", F.floor(F.col(position) / F.lit(width)))
    bases = (
        sliced.groupBy(group, "__slice")
        .agg(F.sum(value).alias("__slice_sum"))
        .select(
            F.col(group).alias("__group"),
            F.col("__slice").alias("__slice_of"),
            F.coalesce(
                F.sum("__slice_sum").over(Window.partitionBy(group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ).alias("__base"),
        )
    )
    own = Window.partitionBy(group, "__slice").orderBy(position, *ties).rowsBetween(Window.unboundedPreceding, -1)
    inside = sliced.withColumn("__inside", F.coalesce(F.sum(value).over(own), F.lit(0)))
    joined = inside.join(bases, (F.col(group) == F.col("__group")) & (F.col("__slice") == F.col("__slice_of")))
    return joined.withColumn(out, (F.col("__base") + F.col("__inside")).cast("bigint")).drop(
        "__slice", "__group", "__slice_of", "__base", "__inside"
    )


def components(work: Workspace, edges: DataFrame) -> DataFrame:
    """Connected components of `edges` (a, b), as rows (node, root) with the smallest node of each component.

    Alternating star contraction: every node points its larger neighbours, then all its neighbours, to the
    smallest one it knows. Rounds grow with the logarithm of the number of nodes; hubs are only ever
    aggregated with `min`, which combines before the shuffle. Each round is a written table.
    """
    current = work.table(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    seen = _sum(current)
    while True:
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: neighbours above a node move to the lowest node it knows
        large = both.where("b > a").join(lowest, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: a node and its lower neighbours move to the lowest of them
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(down, "b")
            .select("m", F.explode(F.array("a", "b")).alias("n"))
            .where("m <> n")
            .select(F.least("m", "n").alias("a"), F.greatest("m", "n").alias("b"))
            .distinct()
        )
        after = work.table(small, "stars")
        now = _sum(after)
        work.drop(current)
        current = after
        if now == seen:
            break
        seen = now
    return current.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _sum(edges: DataFrame) -> tuple:
    """Number and checksums of distinct edges: the same for the same set."""
    pair = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(pair), F.bit_xor(F.xxhash64(pair))).first())
