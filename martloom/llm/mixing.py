"""Mixing sources to target weights by weighted fair queueing.

The documents of a source queue in a fixed shuffled order, the whole queue once for each pass. A document's
virtual finish time is the words of its source up to its end divided by the source's target, so all sources
reach time 1 with their targets met, and the sum of targets is the budget. The mix is the queue of all
sources in order of virtual finish time, range-partitioned and sorted on narrow rows, cut where prefix sums reach the
budget, which is at time 1: a document that is being served then is taken in part.

Sources: by code point, null last. A null text has no words. Rows with one id are ordered by their texts' hash, then by
a hash of their columns; rows that are equal in all stand for each other.
Documents without words are taken zero times. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.llm.support import WORD, Workspace, ring_hash, running_total, text_of


def word_count() -> Column:
    return F.regexp_count(text_of(), F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2) -> DataFrame:
    """Per source: its size and target. Sources weigh `weights` in turn; they share `share` times all words;
    none takes more than `repeats` times its size, and what it leaves goes to the others by weight.

    The level is found in closed form: with sources ordered by how soon they are full, the first that is not
    full when all before it are gives the words a unit of weight gets. One row for each source is ordered
    in one task; there are as many as there are sources, not documents.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    by_fill = Window.orderBy("full_at", F.asc_nulls_last("source"))
    everything = Window.partitionBy(F.lit(0))
    filled = (
        per_source.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * repeats)
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("filled", F.coalesce(F.sum("most").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("waiting", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("level", (F.col("budget") - F.col("filled")) / F.col("waiting"))
        .withColumn("order", F.row_number().over(by_fill))
        .withColumn("first_open", F.min(F.when(F.col("level") < F.col("full_at"), F.col("order"))).over(everything))
        .withColumn("final", F.max(F.when(F.col("order") == F.col("first_open"), F.col("level"))).over(everything))
    )
    capped = F.col("first_open").isNull() | (F.col("order") < F.col("first_open"))
    target = F.when(capped, F.col("most").cast("double")).otherwise(F.col("final") * F.col("weight"))
    return filled.select("source", "source_size", target.alias("target"))


def _row_hash(docs: DataFrame) -> Column:
    """A hash of all columns, which is also aware of where nulls are."""
    parts = []
    for field in docs.schema.fields:
        column = F.col(f"`{field.name}`")
        plain = "map<" not in field.dataType.simpleString() and field.dataType.simpleString() not in ("void", "variant")
        parts += [column.isNull(), column if plain else F.to_json(F.struct(column))]
    return F.xxhash64(*parts)


def _queued(docs: DataFrame) -> DataFrame:
    """A narrow row per document. Rows with one id and text are told apart by a hash of their other columns, and then by
    `copy`, which is 0 unless they are equal in all."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source"),
        word_count().alias("size"),
        F.xxhash64(text_of()).alias("text_hash"),
        _row_hash(docs).alias("row_hash"),
    )


_SAME = ["doc_id", "text_hash", "row_hash"]


def _numbered(rows: DataFrame) -> DataFrame:
    """Add `copy`: 0, 1, ... among rows that are equal in everything."""
    return rows.withColumn("copy", F.row_number().over(Window.partitionBy(*_SAME).orderBy(F.lit(0))) - 1)


def _entries(work: Workspace, rows: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """Per document and pass: virtual start and finish, and the words that the mix takes of it in that pass.

    The entries are range-partitioned by virtual finish and sorted, and prefix sums of their words are cut at the
    budget. An entry that finishes by time 1 counts with all its words, one that is being served at time 1 with
    those served by then.
    """
    goals = work.table(targets(rows, weights, share, repeats).withColumnRenamed("source", "goal_of"), "targets")
    # ids spread the documents of a source evenly; rows without one are spread by their texts
    spot = ring_hash(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text"), F.col("text_hash"))))
    placed = rows.withColumn("spot", spot).withColumn("queue", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    ordered = running_total(placed, "queue", "spot", ["doc_id", "text_hash", "row_hash", "copy"], "size", "before")
    joined = ordered.join(goals, F.col("source").eqNullSafe(F.col("goal_of"))).drop("goal_of", "spot", "queue")
    # documents that come after time 1 in a pass have no entry there, but all have one in the first
    passes = joined.withColumn("pass", F.explode(F.array(*[F.lit(n) for n in range(repeats)])))
    ahead = F.col("before") + F.col("source_size") * F.col("pass")
    goal = F.nullif(F.col("target"), F.lit(0.0))
    timed = passes.withColumns({"start": ahead / goal, "finish": (ahead + F.col("size")) / goal}).where("pass = 0 OR start < 1")
    served = F.greatest(F.round("target").cast("bigint") - ahead, F.lit(0))
    worded = timed.withColumn("words", F.when(F.col("finish") <= 1, F.col("size")).otherwise(F.least(served, F.col("size"))).cast("bigint"))
    worded = work.table(worded.withColumn("words", F.coalesce("words", F.lit(0).cast("bigint"))).drop("before"), "entries")
    order = ["finish", "doc_id", "text_hash", "row_hash", "copy", "pass"]
    ranged = worded.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    ranged = work.table(ranged.withColumn("part", F.shiftright("place", 33)), "queue")
    # one row for each range; ranges are as many as tasks, not as entries
    sums = ranged.groupBy("part").agg(F.sum("words").alias("__words"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col("part").alias("of"), F.coalesce(F.sum("__words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0))).join(bases, F.col("part") == F.col("of"))
    budget = goals.agg(F.sum(F.round("target").cast("bigint")).alias("budget")).scalar()
    left = F.greatest(budget - F.col("base") - F.col("inside"), F.lit(0))
    return summed.withColumn("words", F.least(F.col("words"), left).cast("bigint")).drop("part", "of", "base", "inside")


def fair_queue(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2) -> DataFrame:
    """Per document: doc_id, size, source_size, target and taken, the words of it in the mix."""
    work = Workspace(docs.sparkSession, "mixing")
    rows = work.table(_numbered(_queued(docs)), "sizes")
    entries = _entries(work, rows, weights, share, repeats)
    each = entries.groupBy(*_SAME, "copy", "size", "source_size", "target").agg(F.sum("words").alias("taken"))
    return each.select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2, ordered: bool = True) -> DataFrame:
    """The mix itself: rows of `docs` in order of virtual finish time, as often as they are taken.

    Only whole documents go out: one that the cut crosses is in if at least half of its words are. Who is in is decided
    on narrow rows; texts move once to meet the decision, and once more into the order.
    """
    work = Workspace(docs.sparkSession, "mixing")
    rows = work.table(_numbered(_queued(docs)), "sizes")
    entries = _entries(work, rows, weights, share, repeats).where((F.col("size") > 0) & (F.col("words") * 2 >= F.col("size")))
    chosen = work.table(entries.groupBy(*_SAME, "copy").agg(F.sort_array(F.collect_list(F.struct("finish", "pass"))).alias("times")), "chosen")
    carried = docs.select(
        F.col("doc_id").cast("bigint").alias("id"),
        F.xxhash64(text_of()).alias("h"),
        _row_hash(docs).alias("r"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash")) & (F.col("r") == F.col("row_hash"))
    # rows that are equal in everything stand for each other: one of them goes out for all of them
    once = chosen.groupBy(*_SAME).agg(F.flatten(F.collect_list("times")).alias("times"), F.count("*").alias("copies"))
    single = carried.join(once.where("copies = 1"), same)
    several = carried.join(once.where("copies > 1"), same).dropDuplicates(_SAME)
    out = single.unionByName(several).select("row", "doc_id", F.explode("times").alias("entry"))
    if ordered:
        out = out.orderBy("entry.finish", "doc_id", "entry.pass")
    return out.select("row.*")
