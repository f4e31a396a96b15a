"""A hidden Markov language model over words, trained by Baum-Welch on whole corpora.

Symbols are the `state_words` most frequent words, one class for all other words, and the end of a text. A word of
the class has the class's probability times its own share of it, by smoothed counts, where all unseen words
are one type; so every text has an exact, proper likelihood.

Counts of all words stay a distributed table. Only the most frequent words of at most `LONGEST` bytes,
no more than `head_words` of them, go to the workers (a bounded table); rarer words meet their counts in a join on the word.
Where the bound falls among words of one count, a part of them goes, chosen by hash.
Expected counts of an iteration are summed per partition, then by symbol; the driver gets one row for each
symbol. Training cuts texts into segments of `SEGMENT` symbols; every symbol of the training texts counts, every
transition but those between two segments, and starts at the beginnings of texts.
Scoring runs the scaled forward recursion over whole texts, however long.

A null text is empty: just the end. A null id counts as empty text for the choice of held-out rows.
Repeated rows are counted and scored each. Without training texts all words are unknown.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.llm.support import LOWER, Workspace, text_of

HEAD_WORDS = 131_072
STATE_WORDS = 16_384
LONGEST = 64
TIE_SHARES = 4096  # words of one count are let in by so many shares
STATES = 8
ITERATIONS = 4
SEGMENT = 256
TOGETHER = 1_500_000  # symbols worked on at a time

COUNT_ROW = "word binary, n bigint"
SEQUENCE_ROW = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, class_score double, "
    "symbols binary, words array<binary>, times array<int>"
)


@dataclass(frozen=True)
class Vocabulary:
    """What workers know of the words: the frequent ones with their counts, and totals."""

    head: list[bytes]
    counts: np.ndarray
    n_tokens: int
    n_types: int
    n_ends: int
    state_words: int

    @property
    def n_states_words(self) -> int:
        return min(self.state_words, len(self.head))

    @property
    def in_class(self) -> tuple[int, int]:
        """Tokens and types of the class of other words."""
        k = self.n_states_words
        return self.n_tokens - self.n_ends - int(self.counts[:k].sum()), self.n_types - k - (self.n_ends > 0)

    @property
    def other(self) -> int:
        return self.n_states_words

    @property
    def end(self) -> int:
        return self.n_states_words + 1

    def base_log(self, counts):
        return np.log10((counts + 1) / (self.n_tokens + self.n_types + 1))

    def class_log(self, counts):
        tokens, types = self.in_class
        return np.log10((counts + 1) / (tokens + types + 1))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def count_words(docs: DataFrame) -> DataFrame:
    """How often each word occurs; counts are combined in the task before they move."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counter.update(words_of(text))
            if len(counter) > 300_000:
                yield flushed()
                counter.clear()
        yield flushed()

    return docs.select(text_of().cast("binary").alias("text")).mapInArrow(count, COUNT_ROW).groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, n_ends: int, head_words: int = HEAD_WORDS, state_words: int = STATE_WORDS) -> Vocabulary:
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    short = counts.where(F.octet_length("word") <= LONGEST)
    # the least count that leaves no more than `head_words` words, from the number of words of each count
    ranked = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    frequencies = short.groupBy("n").agg(F.count("*").alias("words")).withColumn("so_far", F.sum("words").over(ranked))
    fits = frequencies.where(F.col("so_far") <= head_words).agg(F.min("n").alias("least"), F.max("so_far").alias("words")).first()
    tie = frequencies.where(F.col("so_far") > head_words).agg(F.max("n")).first()[0]
    chosen = F.col("n") >= fits["least"] if fits["least"] is not None else F.lit(False)
    if tie is not None:  # of the words of the next count, as many shares as there is room for
        share = F.pmod(F.xxhash64("word"), F.lit(TIE_SHARES))
        shares = short.where(F.col("n") == tie).groupBy(share.alias("share")).agg(F.count("*").alias("words"))
        upto = F.sum("words").over(Window.orderBy("share").rowsBetween(Window.unboundedPreceding, 0))
        room = head_words - (fits["words"] or 0)
        last = shares.withColumn("upto", upto).where(F.col("upto") <= room).agg(F.max("share")).first()[0]
        if last is not None:
            chosen = chosen | ((F.col("n") == tie) & (share <= last))
    head = sorted(short.where(chosen).collect(), key=lambda r: (-r["n"], bytes(r["word"])))
    return Vocabulary(
        [bytes(r["word"]) for r in head],
        np.array([r["n"] for r in head], "i8"),
        totals["n"] + n_ends,
        totals["v"] + (n_ends > 0),
        n_ends,
        state_words,
    )


def sequences(docs: DataFrame, held_out: Column, words: Vocabulary) -> DataFrame:
    """Per text its symbols as unsigned 16-bit integers, sums over its frequent words, and its other words."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        rank = {w: k for k, w in enumerate(known.head)}.get
        base, inside = known.base_log(known.counts), known.class_log(known.counts)
        end = known.base_log(known.n_ends)
        for batch in batches:
            rows = []
            for text in batch.column(2).to_pylist():
                tokens = words_of(text)
                ranks = np.array([rank(w, -1) for w in tokens], "i4")
                frequent = ranks[ranks >= 0]
                symbols = np.where((ranks >= 0) & (ranks < known.other), ranks, known.other).astype("<u2")
                rare = Counter(w for w, r in zip(tokens, ranks.tolist()) if r < 0) if len(frequent) < len(tokens) else {}
                rows.append(
                    (
                        len(tokens) + 1,
                        len(frequent) + (known.n_ends > 0),
                        float(base[frequent].sum() + end),
                        float(inside[frequent[frequent >= known.other]].sum()),
                        symbols.tobytes() + np.array([known.end], "<u2").tobytes(),
                        list(rare),
                        list(rare.values()),
                    )
                )
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()))
            columns = [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 7, kinds)]
            names = [x.split()[0] for x in SEQUENCE_ROW.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), text_of().cast("binary").alias("text"))
    return chosen.mapInArrow(encode, SEQUENCE_ROW).withColumn("row_key", F.monotonically_increasing_id())


@dataclass(frozen=True)
class HiddenMarkov:
    start: np.ndarray  # states
    moves: np.ndarray  # states x states
    emits: np.ndarray  # symbols x states

    @staticmethod
    def first(words: Vocabulary, states: int) -> "HiddenMarkov":
        """Near the word frequencies, with a fixed disturbance for each state."""
        draw = np.random.default_rng(20)
        emits = unigram(words)[:, None] * draw.uniform(0.5, 1.5, (words.end + 1, states))
        moves = draw.uniform(0.5, 1.5, (states, states)) + states * np.eye(states)
        return HiddenMarkov(np.full(states, 1 / states), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def unigram(words: Vocabulary) -> np.ndarray:
    """Smoothed frequencies of the symbols."""
    seen = np.concatenate([words.counts[: words.other], [words.in_class[0], words.n_ends]]) + 1.0
    return seen / seen.sum()


def _packed(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences by falling length: all symbols in a row, where each starts, and how many last beyond step t."""
    parts = sorted(parts, key=len, reverse=True)
    lengths = np.array([len(p) for p in parts])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    alive = len(parts) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
    return np.concatenate(parts).astype("i4"), starts, alive


def expected_counts(model: HiddenMarkov, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One forward and backward pass: expected starts, moves and emissions."""
    flat, starts, alive = _packed(parts)
    n, steps, states = len(parts), len(alive), len(model.start)
    alpha, scale = np.empty((steps, n, states)), np.empty((steps, n))
    for t in range(steps):
        m = alive[t]
        a = model.emits[flat[starts[:m] + t]]
        a *= alpha[t - 1, :m] @ model.moves if t else model.start
        s = a.sum(1)
        np.divide(a, s[:, None], out=alpha[t, :m])
        scale[t, :m] = s
    moves, emits = np.zeros((states, states)), np.zeros_like(model.emits)
    posterior = np.empty((len(flat), states))
    beta = np.ones((n, states))
    for t in range(steps - 1, -1, -1):
        m = alive[t]
        at = starts[:m] + t
        posterior[at] = alpha[t, :m] * beta[:m]
        if t:
            b = model.emits[flat[at]] * beta[:m]
            b /= scale[t, :m, None]
            moves += alpha[t - 1, :m].T @ b
            beta[:m] = b @ model.moves.T
    for k in range(states):
        emits[:, k] = np.bincount(flat, posterior[:, k], len(emits))
    return posterior[starts].sum(0), moves * model.moves, emits


def log_likelihoods(model: HiddenMarkov, parts: list[np.ndarray]) -> np.ndarray:
    """log10 of the exact probability of each sequence, by the scaled forward recursion."""
    order = np.argsort([-len(p) for p in parts], kind="stable")
    flat, starts, alive = _packed(parts)
    a, logs = np.empty((0, 0)), np.zeros(len(parts))
    for t, m in enumerate(alive.tolist()):
        a = model.emits[flat[starts[:m] + t]] * (a[:m] @ model.moves if t else model.start)
        s = a.sum(1)
        a /= s[:, None]
        logs[:m] += np.log10(s)
    out = np.empty(len(parts))
    out[order] = logs
    return out


def _grouped(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    """Arrow batches together until they hold enough symbols to keep the recursions wide."""
    held, parts, size = [], [], 0
    for batch in batches:
        held.append(batch)
        new = [np.frombuffer(x, "<u2") for x in batch.column(column).to_pylist()]
        parts += new
        size += sum(map(len, new))
        if size >= TOGETHER:
            yield held, parts
            held, parts, size = [], [], 0
    if parts:
        yield held, parts


def train(rows: DataFrame, words: Vocabulary, states: int = STATES, iterations: int = ITERATIONS) -> HiddenMarkov:
    """Baum-Welch over the symbols of `rows`."""
    model = HiddenMarkov.first(words, states)
    context = rows.sparkSession.sparkContext
    sums = [f"s{k}" for k in range(states)]
    schema = "symbol int, " + ", ".join(f"{s} double" for s in sums)
    prior = unigram(words)[:, None]
    for _ in range(iterations):
        shared = context.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now = shared.value
            start, moves, emits = np.zeros_like(now.start), np.zeros_like(now.moves), np.zeros_like(now.emits)
            for _, parts in _grouped(batches, 0):
                # only what begins a text says how texts begin
                begins = sorted((p[:SEGMENT] for p in parts), key=len)
                later = sorted((p[a : a + SEGMENT] for p in parts for a in range(SEGMENT, len(p), SEGMENT)), key=len)
                for cut, totals in ((begins, (start, moves, emits)), (later, (np.zeros_like(start), moves, emits))):
                    for a in range(0, len(cut), 1024):
                        for total, more in zip(totals, expected_counts(now, cut[a : a + 1024])):
                            total += more
            # moves as symbols -1, -2, ..., the start after them
            seen = np.flatnonzero(emits.sum(1))
            symbols = np.concatenate([seen, -1 - np.arange(states + 1)]).astype("i4")
            values = np.concatenate([emits[seen], moves, start[None, :]])
            yield pa.RecordBatch.from_arrays([pa.array(symbols), *(pa.array(values[:, k]) for k in range(states))], names=["symbol", *sums])

        found = rows.select("symbols").mapInArrow(expect, schema).groupBy("symbol").agg(*[F.sum(s).alias(s) for s in sums]).collect()
        emits, rest = np.zeros_like(model.emits), np.zeros((states + 1, states))
        for r in found:
            (emits if r["symbol"] >= 0 else rest)[r["symbol"] if r["symbol"] >= 0 else -1 - r["symbol"]] = r[1:]
        shared.unpersist()
        emits += 50 * prior
        moves, start = rest[:states] + 1, rest[states] + 1
        model = HiddenMarkov(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
    return model


SCORE_ROW = "row_key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, class_score double, chain double"


def score_documents(docs: DataFrame, held_out: Column, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """Learn from the rows that are not held out and score all rows.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).
    """
    work = Workspace(docs.sparkSession, "language-model")
    training = docs.where(~held_out)
    counts = work.table(count_words(training), "counts")
    words = vocabulary(counts, training.count())
    rows = work.table(sequences(docs, held_out, words), "sequences")
    model = train(rows.where("not held_out"), words, states, iterations)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, parts in _grouped(batches, 7):
            logs, at = log_likelihoods(shared.value, parts), 0
            for batch in held:
                columns = batch.columns[:7]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(logs[at : at + len(batch)])], names=[x.split()[0] for x in SCORE_ROW.split(", ")])
                at += len(batch)

    chained = rows.select("row_key", "doc_id", "held_out", "n_tokens", "n_known", "base", "class_score", "symbols").mapInArrow(score, SCORE_ROW)
    tokens, types = words.in_class
    times, n = F.col("pair.times"), F.coalesce(F.col("n"), F.lit(0))
    rare = (
        rows.select("row_key", F.explode(F.arrays_zip("words", "times")).alias("pair"))
        .join(counts, F.col("pair.words") == F.col("word"), "left")
        .groupBy("row_key")
        .agg(
            F.sum(F.when(n > 0, times).otherwise(0)).alias("rare_known"),
            F.sum(times * F.log10((n + 1) / F.lit(words.n_tokens + words.n_types + 1))).alias("rare_base"),
            F.sum(times * F.log10((n + 1) / F.lit(tokens + types + 1))).alias("rare_class"),
        )
    )

    def with_rare(a: str, b: str) -> Column:
        return F.col(a) + F.coalesce(F.col(b), F.lit(0))

    return chained.join(rare, "row_key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        with_rare("n_known", "rare_known").cast("bigint").alias("n_known"),
        F.lit(words.n_tokens).cast("bigint").alias("train_tokens"),
        with_rare("base", "rare_base").alias("base_score"),
        (F.col("chain") + with_rare("class_score", "rare_class")).alias("score"),
    )


def every_seventh() -> Column:
    """The rows the contract holds out: crc32 of the id as text leaves 2 when divided by 7."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
