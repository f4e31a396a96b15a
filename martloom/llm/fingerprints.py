"""Document fingerprints by consistent weighted sampling. DataFrame functions only.

Each coordinate of a signature draws one weighted term of the text, with draws that are the same in every text:
for a term of weight w, r and c are Gamma(2, 1) and b is uniform, from hashes of the term and the coordinate;
t = floor(ln w / r + b), and the term with the least ln a = ln c - r (t - b + 1) is the sample. Two texts draw the
same (term, t) with the probability of their generalised Jaccard similarity, sum of minima over sum of maxima.
ln a itself identifies the sample: it is a function of the term, t and the coordinate alone.

Terms are words; a word weighs its characters, times its occurrences: so similarity is in shares of the text.

Texts move once, by id and hash; all terms of a text stay in its task, where they are counted and reduced to a
row. Null and empty texts, and texts of white space, have no terms: their fingerprint is that of no terms, alike
only to itself. Other columns are ignored; repeated rows each get a row and have one fingerprint.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martloom.llm.support import Workspace, text_of

COORDINATES = 40
SCALE = 1 << 20
BLANK = r"[\x20\x09-\x0D]+"


def _least(coordinate: int) -> Column:
    """ln a of a term for one coordinate, from its hash `term` and the logarithm of its weight `log_w`."""
    first = f"xxhash64(term, {coordinate})"
    second = f"xxhash64({first})"

    def gamma(bits: str) -> str:
        """Gamma(2, 1): -ln of a product of two uniform numbers of 20 bits each."""
        u, v = (f"((shiftrightunsigned({bits}, {at}) & {SCALE - 1}) + 0.5D)" for at in (0, 20))
        return f"({2 * math.log(SCALE)!r}D - ln({u} * {v}))"

    r, c = gamma(first), gamma(second)
    b = f"((shiftrightunsigned({second}, 40) + 0.5D) / {float(1 << 24)}D)"
    return F.expr(f"ln({c}) - {r} * (floor(log_w / {r} + {b}) - {b} + 1D)")


@contextmanager
def _plain_code(spark: SparkSession):
    """Without subexpression elimination: with dozens of aggregates it costs more than it saves."""
    key = "spark.sql.subexpressionElimination.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


# Which of two texts a part belongs to.
FIRST, SECOND, SHARED = 0, 1, 2


def signatures(parts: DataFrame, keys: list[str], carried: list[str], coordinates: int = COORDINATES) -> DataFrame:
    """Signatures of two texts per key, `a0`, `a1`, ... and `b0`, `b1`, ..., from their parts: rows of keys, `side`,
    `text` and `carried` numbers that are the same in all parts. Keys must be unique, and no word may run from
    one part into another; a text without words has null coordinates.

    What the texts share is split and counted once, and a term that weighs the same in both is drawn once.
    If `parts` is partitioned by some of the keys, nothing moves.
    """
    chars, side = F.char_length("word"), F.col("side")
    terms = (
        parts.select(*keys, *carried, "side", F.explode(F.split("text", BLANK)).alias("word"))
        .groupBy(*keys, F.xxhash64("word").alias("term"))
        .agg(
            F.sum(F.when(side != SECOND, chars).otherwise(0)).alias("first_w"),
            F.sum(F.when(side != FIRST, chars).otherwise(0)).alias("second_w"),
            *[F.max(c).alias(c) for c in carried],
        )
    )

    def entry(where: int, weight: str) -> Column:
        return F.struct(F.lit(where).alias("side"), F.col(weight).alias("weight"))

    each = F.when(F.col("first_w") == F.col("second_w"), F.array(entry(SHARED, "first_w"))).otherwise(F.array(entry(FIRST, "first_w"), entry(SECOND, "second_w")))
    weighted = terms.select(*keys, *carried, "term", F.explode(each).alias("e")).select(*keys, *carried, "term", "e.side", F.ln("e.weight").alias("log_w"))
    drawn = weighted.groupBy(*keys, "side").agg(*[F.min(_least(k)).alias(f"s{k}") for k in range(coordinates)], *[F.max(c).alias(c) for c in carried])
    return drawn.groupBy(*keys).agg(
        *[F.min(F.when(side != SECOND, F.col(f"s{k}"))).alias(f"a{k}") for k in range(coordinates)],
        *[F.min(F.when(side != FIRST, F.col(f"s{k}"))).alias(f"b{k}") for k in range(coordinates)],
        *[F.max(c).alias(c) for c in carried],
    )


def packed(name: str, coordinates: int = COORDINATES) -> Column:
    """A signature as bytes, four for each coordinate; zeros where there is no term."""
    parts = [
        F.when(F.col(f"{name}{k}").isNull(), "0" * 8).otherwise(F.lpad(F.hex(F.xxhash64(f"{name}{k}").bitwiseAND(0xFFFFFFFF)), 8, "0"))
        for k in range(coordinates)
    ]
    return F.unhex(F.concat(*parts))


def likeness(a: str, b: str, coordinates: int = COORDINATES) -> Column:
    """The share of coordinates in which two fingerprints agree, an estimate of generalised Jaccard similarity."""
    same = [(F.substring(a, 4 * k + 1, 4) == F.substring(b, 4 * k + 1, 4)).cast("int") for k in range(coordinates)]
    return sum(same[1:], same[0]) / F.lit(float(coordinates))


KEY = ["id", "text_hash"]


def keyed(docs: DataFrame) -> DataFrame:
    """Texts with a key that is never null, so that rows meet by plain equality: the id and a hash of the text,
    which also tells a missing id from 0."""
    doc_id = F.col("doc_id").cast("bigint")
    text_hash = F.when(doc_id.isNull(), F.xxhash64(text_of(), F.lit("no id"))).otherwise(F.xxhash64(text_of()))
    return docs.select(
        doc_id.isNotNull().alias("known"), F.coalesce(doc_id, F.lit(0)).alias("id"), text_hash.alias("text_hash"), text_of().alias("text")
    )


def neighbours(work: Workspace, keys: DataFrame) -> DataFrame:
    """Each key's successor in ascending order, the first after the last, as `next_*` columns.

    Rows are range-partitioned; inside a partition they are ordered, and between partitions only each one's
    first row counts.
    """
    along = ["known", *KEY]
    placed = work.table(keys.repartitionByRange(*along).withColumn("part", F.spark_partition_id()), "order")
    key = F.struct(*along)
    firsts = placed.groupBy("part").agg(F.min(key).alias("first"))  # one row a partition
    following = firsts.select(
        F.col("part").alias("of_part"),
        F.coalesce(F.lead("first").over(Window.orderBy("part")), F.min("first").over(Window.partitionBy(F.lit(0)))).alias("following"),
    )
    inside = Window.partitionBy("part").orderBy(*along)
    after = placed.withColumn("after", F.lead(key).over(inside)).join(following, F.col("part") == F.col("of_part"))
    nexts = F.coalesce("after", "following")
    return after.select(*keys.columns, *[nexts[c].alias(f"next_{c}") for c in KEY])


def compare_with_edits(docs: DataFrame, coordinates: int = COORDINATES) -> DataFrame:
    """Fingerprint every text and its edited text, the last quarter replaced by the beginning of the next text.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A row without
    an id comes before all others; rows that repeat an id and text have the next other row as successor.
    Texts move once and the beginnings of the next ones, a quarter of them, once more; all joins that
    follow are on the same key.
    """
    work = Workspace(docs.sparkSession, "fingerprints")
    texts = keyed(docs)
    keys = texts.select("known", *KEY, F.char_length("text").alias("n_chars")).groupBy("known", *KEY, "n_chars").agg(F.count("*").alias("copies"))
    texts = texts.select(*KEY, "text")
    order = work.table(neighbours(work, keys), "successors")
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    asked = order.select(*[F.col(f"next_{c}").alias(c) for c in KEY], *[F.col(c).alias(f"to_{c}") for c in KEY], cut.alias("head_chars"))
    heads = (
        texts.join(asked, KEY)
        .select(*[F.col(f"to_{c}").alias(c) for c in KEY], F.substring("text", F.lit(1), F.col("head_chars")).alias("head"))
        .dropDuplicates(KEY)
    )
    stay = F.char_length("text") - F.floor(F.char_length("text") / 4).cast("int")
    edited = (
        texts.join(heads, KEY)
        .select(*KEY, F.substring("text", F.lit(1), stay).alias("kept"), F.substring("text", stay + 1, F.char_length("text")).alias("tail"), "head")
        .dropDuplicates(KEY)
    )
    # the sum goes along as numbers, which aggregate without sorting
    sha = [F.conv(F.substring("sha", 13 * k + 1, 13), 16, 10).cast("bigint").alias(f"sha{k}") for k in range(5)]
    cut_up = (
        edited.select(
            *KEY,
            F.sha2(F.concat("kept", "head").cast("binary"), 256).alias("sha"),
            F.regexp_extract("kept", rf"(?s)^.*{BLANK[:-1]}", 0).alias("shared"),
            "kept",
            "tail",
            "head",
        )
        .select(*KEY, *sha, "shared", F.substring("kept", F.char_length("shared") + 1, F.char_length("kept")).alias("begun"), "tail", "head")
        .select(
            *KEY,
            *[f"sha{k}" for k in range(5)],
            F.explode(
                F.array(
                    F.struct(F.lit(SHARED).alias("side"), F.col("shared").alias("text")),
                    F.struct(F.lit(FIRST).alias("side"), F.concat("begun", "tail").alias("text")),
                    F.struct(F.lit(SECOND).alias("side"), F.concat("begun", "head").alias("text")),
                )
            ).alias("part"),
        )
    )
    numbers = [f"sha{k}" for k in range(5)]
    digits = F.concat(*[F.lpad(F.hex(c), n, "0") for c, n in zip(numbers, (13, 13, 13, 13, 12))])
    with _plain_code(docs.sparkSession):
        signed = signatures(cut_up.select(*KEY, *numbers, "part.side", "part.text"), KEY, numbers, coordinates)
        known = work.table(
            signed.select(*KEY, F.unhex(digits).alias("sha"), packed("a", coordinates).alias("fingerprint"), packed("b", coordinates).alias("edited_fingerprint")),
            "prints",
        )
    others = known.select(*[F.col(c).alias(f"next_{c}") for c in KEY], F.col("fingerprint").alias("next_fingerprint"))
    paired = known.join(order, KEY).join(others, [f"next_{c}" for c in KEY])
    return paired.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.when(F.col("known"), F.col("id")).alias("doc_id"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.lower(F.hex("sha")).alias("edited_sha256"),
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        likeness("fingerprint", "edited_fingerprint", coordinates).alias("near_edited"),
        likeness("fingerprint", "next_fingerprint", coordinates).alias("near_next"),
    )
