"""Secrets: fixed patterns, and tokens that look random to character Markov models. DataFrame functions only.

Two first-order Markov chains over letters and digits are compared, one of random strings and one of ordinary identifiers.
Both are trained on labelled samples taken from the corpus itself. Random: what the fixed patterns find. Ordinary:
tokens that are letters only or digits only, as written and in capitals; an unknown secret is hardly ever one, so
unknown secrets do not teach the ordinary chain, however many there are. Each distinct token counts once.

Both chains are mixed with the uniform distribution in fixed shares, so what is unseen has the same weight in small and
large corpora: `RANDOM_MIX` is large, since known secrets use few of the characters that others may use, `ORDINARY_MIX`
is small. Separators start anew in both chains, so parts of a name count like words. A token of `LEAST_CHARS` or more
is a secret if its log-likelihood ratio exceeds the cut, and nothing else decides. The cut is the ratio that only one
ordinary sample in 100 exceeds (a few unknown secrets of letters only may be among them), and no less than `LEAST_CUT`. Shorter tokens hold too little evidence.

Positions are code points, ends exclusive. Spark finds matches but not places, so places come from running sums
over the lengths of the text between matches, in blocks, so that very many matches in one text cost little more
than their number. Null and empty texts have no spans; repeated rows are scanned each; a table without
labelled samples leaves both chains uniform, and nothing is found beyond the fixed patterns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from martloom.llm.support import Workspace, text_of

# The three patterns, and how long a match must be.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

LEAST_CHARS = 12
LONG_TOKEN = rf"[A-Za-z0-9+/_=-]{{{LEAST_CHARS},}}"
ORDINARY = r"(?<![A-Za-z0-9+/_=-])(?:[A-Za-z]{6,}|[0-9]{2,})(?![A-Za-z0-9+/_=-])"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
WIDTH = len(ALPHABET) + 1  # 0: the beginning, and every separator
RANDOM_MIX, ORDINARY_MIX = 0.5, 0.02
LEAST_CUT = math.log(1000)
EXCEEDED_BY = 0.01
BLOCK = 256


def _running(numbers: Column, depth: int = 2) -> Column:
    """Running sums of an array. Blocks are summed apart, so that no long array is copied for each of its entries."""

    def appended(block: Column, base: Column) -> Column:
        start = F.struct(base.cast("int").alias("at"), F.array().cast("array<int>").alias("sums"))
        step = lambda done, x: F.struct((done["at"] + x).alias("at"), F.concat(done["sums"], F.array(done["at"] + x)).alias("sums"))
        return F.aggregate(block, start, step, lambda done: done["sums"])

    if depth == 0:
        return appended(numbers, F.lit(0))
    places = F.sequence(F.lit(0), F.greatest(F.floor((F.size(numbers) - 1) / BLOCK), F.lit(0)).cast("int"))
    # the array travels in the accumulator: a lambda that named it would compute it anew for every block
    start = F.struct(numbers.alias("all"), F.array().cast("array<array<int>>").alias("out"))
    cut = lambda done, b: F.struct(done["all"].alias("all"), F.concat(done["out"], F.array(F.slice(done["all"], b * BLOCK + 1, F.lit(BLOCK)))).alias("out"))
    blocks = F.aggregate(places, start, cut, lambda done: done["out"])
    totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda t, x: t + x))
    return F.flatten(F.zip_with(blocks, F.zip_with(_running(totals, depth - 1), totals, lambda upto, own: upto - own), appended))


def _spans(kind: str, text: Column, pattern: str, matches: Column) -> Column:
    """Structs (kind, start, end) of all matches, from the gaps between them."""
    sizes = F.transform(matches, F.char_length)
    # a gap and the match behind it, each as (gap, size); the last gap has no match
    paired = F.zip_with(F.split(text, pattern, -1), sizes, lambda gap, size: F.struct(F.char_length(gap).alias("gap"), F.coalesce(size, F.lit(0)).alias("size")))
    ends = _running(F.transform(paired, lambda p: p["gap"] + p["size"]))
    placed = F.zip_with(ends, paired, lambda end, p: F.struct(F.lit(kind).alias("kind"), (end - p["size"]).alias("start"), end.alias("end")))
    return F.slice(placed, F.lit(1), F.size(matches))


def _where(spans: Column | str, wanted: Column) -> Column:
    """The spans whose flag is set."""
    return F.filter(F.zip_with(spans, wanted, lambda s, keep: F.when(keep, s)), lambda s: s.isNotNull())


NOTHING = "array<struct<kind:string,start:int,end:int>>"


def with_base_spans(docs: DataFrame) -> DataFrame:
    """Add `assign`, `access`, `hex`: arrays of (kind, start, end) of the fixed patterns in `text`.

    An assignment is dropped if its value is shorter than 8. Matches of the other two are maximal runs, so a
    least length in the pattern finds the same as dropping short matches afterwards.
    """
    text, none = F.col("text"), F.array().cast(NOTHING)
    found = docs.withColumns(
        {
            "m_assign": F.regexp_extract_all(text, F.lit(ASSIGN), 0),
            "m_access": F.regexp_extract_all(text, F.lit(ACCESS), 0),
            "m_hex": F.regexp_extract_all(text, F.lit(HEX), 0),
        }
    )
    spans = found.withColumns(
        {
            kind: F.when(F.size(f"m_{kind}") > 0, _spans(kind, text, pattern, F.col(f"m_{kind}"))).otherwise(none)
            for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX))
        }
    )
    short = F.transform(F.col("m_assign"), lambda m: F.char_length(F.regexp_extract(m, ASSIGN_VALUE, 1)) >= 8)
    kept = _where("assign", short)
    return spans.withColumn("assign", F.when(F.size("m_assign") > 0, kept).otherwise(none)).drop("m_assign", "m_access", "m_hex")


def _codes(token: Column) -> Column:
    """The places of a token's characters in the alphabet, from 1; 0 for its beginning and for separators."""
    return F.concat(F.array(F.lit(0)), F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c)))


def _steps(codes: Column) -> Column:
    """Transitions as numbers: from x width + to."""
    return F.zip_with(
        F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1), lambda a, b: a * WIDTH + b
    )


def transition_counts(tokens: DataFrame) -> DataFrame:
    """Transitions of labelled tokens (token, n, random): counts for each kind."""
    weight = F.when(F.col("random"), F.col("n")).otherwise(0)
    return (
        tokens.select("random", "n", _codes(F.col("token")).alias("codes"))
        .select("random", "n", F.explode(_steps(F.col("codes"))).alias("step"))
        .groupBy("step")
        .agg(F.sum(weight).alias("in_random"), F.sum(F.col("n") - weight).alias("in_ordinary"))
    )


def labelled_tokens(scanned: DataFrame) -> DataFrame:
    """The distinct labelled samples (token, random), from the texts and base spans of `with_base_spans`."""
    text = F.col("text")
    found = F.concat(
        F.regexp_extract_all(text, F.lit(ASSIGN_VALUE), 1), F.regexp_extract_all(text, F.lit(ACCESS), 0), F.regexp_extract_all(text, F.lit(HEX), 0)
    )
    with_base = scanned.where(F.size("assign") + F.size("access") + F.size("hex") > 0)
    random = with_base.select(F.explode(found).alias("token")).where((F.char_length("token") >= 8) & ~F.col("token").contains("."))
    # what follows a name such as `token` belongs to no sample of ordinary words
    plain = F.when(F.size("assign") > 0, F.regexp_replace(text, ASSIGN, " ")).otherwise(text)
    words = scanned.select(F.explode(F.regexp_extract_all(plain, F.lit(ORDINARY), 0)).alias("token")).distinct()
    ordinary = words.select(F.explode(F.array_distinct(F.array("token", F.upper("token")))).alias("token"))
    return random.distinct().withColumn("random", F.lit(True)).union(ordinary.distinct().withColumn("random", F.lit(False)))


def ratios_of(counts: dict[int, tuple[int, int]]) -> list[float]:
    """Log-likelihood ratios of all transitions; steps into a separator say nothing."""
    ratios = [0.0] * (WIDTH * WIDTH)
    uniform = 1 / len(ALPHABET)
    for before in range(WIDTH):
        steps = range(before * WIDTH + 1, before * WIDTH + WIDTH)
        totals = [sum(counts[s][kind] for s in steps if s in counts) for kind in (0, 1)]
        for s in steps:
            seen = counts.get(s, (0, 0))
            p, q = (
                (1 - mix) * n / t + mix * uniform if t else uniform for n, t, mix in zip(seen, totals, (RANDOM_MIX, ORDINARY_MIX))
            )
            ratios[s] = math.log(p) - math.log(q)
    return ratios


def train(scanned: DataFrame) -> tuple[list[float], float]:
    """Log-likelihood ratios of all transitions, and the cut."""
    samples = Workspace(scanned.sparkSession, "secrets").table(labelled_tokens(scanned), "samples")
    counted = transition_counts(samples.withColumn("n", F.lit(1))).collect()  # at most WIDTH squared rows
    counts = {r["step"]: (r["in_random"], r["in_ordinary"]) for r in counted}
    if not any(n for _, n in counts.values()):
        return [0.0] * (WIDTH * WIDTH), LEAST_CUT
    ratios = ratios_of(counts)
    scored = samples.where(~F.col("random") & (F.char_length("token") >= LEAST_CHARS)).select(log_ratio(F.col("token"), ratios).alias("ratio"))
    highest = scored.agg(F.percentile_approx("ratio", 1 - EXCEEDED_BY, 100_000).alias("cut")).first()["cut"]
    return ratios, max(LEAST_CUT, highest if highest is not None else LEAST_CUT)


def log_ratio(token: Column, ratios: list[float]) -> Column:
    """log P(token | random) - log P(token | ordinary)."""
    table = F.array(*[F.lit(r) for r in ratios])
    return F.aggregate(_steps(_codes(token)), F.lit(0.0), lambda total, s: total + F.element_at(table, s + 1))


def scan(docs: DataFrame) -> DataFrame:
    """Add to the rows of `docs` (`text` must not be null) `assign`, `access`, `hex` and `random`, arrays of spans."""
    ratios, cut = train(with_base_spans(docs.select("text")))
    based = with_base_spans(docs)
    text, none = F.col("text"), F.array().cast(NOTHING)
    long = based.withColumn("m_long", F.regexp_extract_all(text, F.lit(LONG_TOKEN), 0))
    judged = long.withColumn("verdicts", F.transform("m_long", lambda m: log_ratio(m, ratios) > cut))
    found = _where(_spans("random", text, LONG_TOKEN, F.col("m_long")), F.col("verdicts"))
    return judged.withColumn("random", F.when(F.exists("verdicts", lambda v: v), found).otherwise(none)).drop("m_long", "verdicts")


def joined_spans(*columns: str) -> Column:
    """kind:start:end by start, then kind in the order of the columns."""
    numbered = F.concat(
        *[
            F.transform(c, lambda s, k=k: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), s["kind"].alias("kind")))
            for k, c in enumerate(columns)
        ]
    )
    return F.array_join(F.transform(F.array_sort(numbered), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The rows of `docs` with every span replaced by `mark`, and `n_chars` counted anew where it is there."""
    kept = docs.select(text_of().alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = scan(kept).withColumn("spans", F.array_sort(F.transform(F.concat("assign", "access", "hex", "random"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done, span):
        after = F.greatest(done["at"], span["end"])
        gap = F.substring(F.col("text"), done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        return F.struct(
            after.alias("at"),
            F.when(span["end"] <= done["at"], done["out"])
            .when(span["start"] < done["at"], done["out"])
            .otherwise(F.concat(done["out"], gap, F.lit(mark)))
            .alias("out"),
        )

    clean = F.aggregate("spans", start, step, lambda d: F.concat(d["out"], F.substring(F.col("text"), d["at"] + 1, F.length("text"))))
    # in a step of its own, so that no later column sees the new text under the old name
    found = found.select("row", "spans", clean.alias("cleaned"))
    text = F.when(F.size("spans") > 0, F.col("cleaned")).otherwise(F.col("row.text"))
    fields = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        fields["n_chars"] = F.when(F.size("spans") > 0, F.char_length("cleaned").cast(kind)).otherwise(F.col("row.n_chars"))
    return found.select(*[fields[c].alias(c) if c in fields else F.col(f"row.`{c}`") for c in docs.columns])
