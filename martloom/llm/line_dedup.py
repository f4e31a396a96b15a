"""Line deduplication: of every line that several documents hold, only the first document keeps it.

A line's key is the line without white space at its ends and with A-Z in lower case. Keys of `least_chars` code
points or more that two documents hold lose all their lines, except in the smallest document holding them.
DataFrame functions only; texts are read, not moved, to find the lines to drop:

1. Every line with a long enough key becomes a posting: 128 bits of key hash, document, line number.
2. Postings are range-partitioned by hash and sorted by hash, document and line; a running window streams each
   hash's first document past its other postings. A hash is dealt out in up to `SLICES` slices by document,
   so one that a third of all lines share is not one task's work. A posting of another document than its
   slice's first is dropped. The first documents of a hash's slices, one row each, go through the same
   window again; where a slice's first document is not the hash's, its postings are dropped too.
3. Dropped lines become a bitmap per document: words of 64 lines, and the number of words skipped where nothing
   is dropped. Only bitmaps leave this step; whoever wants the texts joins them once (`without_repeats`).

Nulls: a null text is one empty line. Rows without an id are one document that comes last. Rows that repeat an id
are one document as well: they never drop each other's lines, and each row gets the bitmap of its own
text. Lines end at \\n only, so a \\r stays in the line and is white space in its key. An empty table gives no
rows. Other columns are ignored, or kept by `without_repeats`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.llm.support import Workspace, text_of

LEAST_CHARS = 10
SLICES = 256  # at most so many tasks share one hash
# Fixed value: white space that a key has not at its ends.
BLANKS = " \t\n\x0b\x0c\r"
LINES_A_WORD = 64


def line_key(line: Column) -> Column:
    """A line's key, in a form that is equal where keys are equal: bytes of other scripts are recoded alike.

    `lower` knows all scripts, so a line with other letters is read as one character a byte. Then it changes A-Z,
    and the first byte of some longer characters to one that stands before more bytes than follow here, so two
    different keys stay different.
    """
    bare = F.btrim(line, F.lit(BLANKS))
    by_byte = F.decode(bare.cast("binary"), "ISO-8859-1")
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.lower(by_byte))


def _identified(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), *more)


def postings(docs: DataFrame, least_chars: int) -> DataFrame:
    """Rows (high, low, slice, unknown, doc_id, text_hash, line), one for each line with a long enough key."""
    lines = _identified(docs, F.posexplode(F.split(text_of(), "\n", -1)).alias("line", "content"))
    long = lines.where(F.char_length(F.btrim("content", F.lit(BLANKS))) >= least_chars)
    keyed = long.select("doc_id", "text_hash", "line", line_key(F.col("content")).alias("key"))
    return keyed.select(
        F.xxhash64("key").alias("high"),
        F.xxhash64(F.lit(1), "key").alias("low"),
        F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SLICES)).cast("smallint").alias("slice"),
        F.col("doc_id").isNull().alias("unknown"),
        "doc_id",
        "text_hash",
        "line",
    )


def _first_document(rows: DataFrame, keys: list[str], ties: list[str]) -> Column:
    """The first document of a key, streamed past its sorted rows."""
    order = Window.partitionBy(*keys).orderBy("unknown", "doc_id", *ties)
    return F.first("doc_id").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Rows (doc_id, text_hash, n_dropped, words) of the documents that lose lines; `text_hash` is xxhash64 of the text.

    `words` is an array of (skip, drop): after `skip` words that keep all their 64 lines, the set bits of `drop` go.
    """
    work = Workspace(docs.sparkSession, "line-dedup")
    posted = work.table(postings(docs, least_chars), "postings")
    key, sliced = ["high", "low"], ["high", "low", "slice"]
    # ranges of the window's own keys: the window needs no further exchange, only its sort
    ranged = posted.repartitionByRange(*sliced)
    place = Window.partitionBy(*sliced).orderBy("unknown", "doc_id", "text_hash", "line")
    streamed = work.table(
        ranged.withColumn("first", _first_document(ranged, sliced, ["text_hash", "line"]))
        .withColumn("head", F.row_number().over(place) == 1)
        .withColumn("dropped", ~F.col("doc_id").eqNullSafe(F.col("first")))
        .drop("first"),
        "streamed",
    )
    heads = streamed.where("head").select(*sliced, "unknown", "doc_id").repartitionByRange(*key)
    beaten = heads.withColumn("first", _first_document(heads, key, ["slice"])).where(~F.col("doc_id").eqNullSafe(F.col("first")))
    later = streamed.where("not dropped").join(beaten.select(*sliced), sliced, "left_semi")
    own = ["doc_id", "text_hash"]
    dropped = streamed.where("dropped").select(*own, "line").union(later.select(*own, "line"))
    bit = F.expr(f"shiftleft(1L, cast(line % {LINES_A_WORD} as int))")
    words = dropped.groupBy(*own, F.floor(F.col("line") / LINES_A_WORD).cast("int").alias("word")).agg(F.bit_or(bit).alias("drop"))
    listed = words.groupBy(*own).agg(F.sum(F.bit_count("drop")).cast("bigint").alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", "drop"))).alias("set"))
    before = F.concat(F.array(F.lit(-1)), F.transform("set", lambda w: w["word"]))
    packed = F.zip_with("set", F.slice(before, F.lit(1), F.size("set")), lambda w, last: F.struct((w["word"] - last - 1).alias("skip"), w["drop"].alias("drop")))
    return listed.select(*own, "n_dropped", packed.alias("words"))


def kept_text(text: Column, words: Column) -> Column:
    """The lines of `text` that a bitmap keeps, joined by \\n."""
    dense = F.flatten(F.transform(words, lambda w: F.concat(F.array_repeat(F.lit(0).cast("bigint"), w["skip"]), F.array(w["drop"]))))
    drops = F.flatten(F.transform(dense, lambda w: F.transform(F.sequence(F.lit(0), F.lit(LINES_A_WORD - 1)), lambda b: F.getbit(w, b))))
    lines = F.split(text, "\n", -1)
    return F.array_join(F.zip_with(lines, drops, lambda line, drop: F.when(F.coalesce(drop, F.lit(0)) == 0, line)), "\n")


def _met(docs: DataFrame, bitmaps: DataFrame, carried: Column) -> DataFrame:
    found = bitmaps.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "n_dropped", "words")
    rows = _identified(docs, text_of().alias("text"), carried.alias("row"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left")


def line_digests(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and kept_sha256, of the text without its dropped lines."""
    met = _met(docs.select("doc_id", "text"), keep_bitmaps(docs, least_chars), F.lit(None).cast("string"))
    kept = F.when(F.col("words").isNull(), F.col("text")).otherwise(kept_text(F.col("text"), F.col("words")))
    return met.select(
        "doc_id",
        (F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The rows of `docs` with their texts cut to the kept lines; texts that lose none stay as they are, null ones too."""
    met = _met(docs, keep_bitmaps(docs, least_chars), F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    cut = met.select("row", F.when(F.col("words").isNotNull(), kept_text(F.col("text"), F.col("words"))).alias("cut"), F.col("words").isNotNull().alias("changed"))
    fields = {"text": F.when(F.col("changed"), F.col("cut")).otherwise(F.col("row.text"))}
    return cut.select(*[fields[c].alias(c) if c in fields else F.col(f"row.`{c}`") for c in docs.columns])
