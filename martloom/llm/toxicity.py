"""Toxicity by cumulative-link ordinal regression on sparse word features.

P(grade >= k) = sigmoid(w.x - theta_k) with one weight vector for all thresholds theta_1 <= theta_2 <= ...; the
expected severity is the sum of these probabilities. Features are the presence of words, chosen by how far
their frequency in rows of grade 1 and more differs from that in rows of grade 0: the signed root of the
log-likelihood ratio is sqrt(2 ln n) or more, n the number of words compared, which chance hardly reaches for any.

The model is fitted on at most `fit_rows` labelled documents, those whose ids hash lowest; the chosen labels
are broadcast (bounded by `fit_rows`), so texts are never shuffled. Scoring reads whole texts in one pass.

Nulls: a null text has no words and scores like any text without known words; labels without an id or a flag
are left out; if a document has several labels the most severe counts. Repeated rows are scored each. Without
labels of both kinds nothing is known to be toxic: every severity is next to 0. Other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martloom.llm.support import Workspace, text_of

# Letters of any script; digits, marks and signs end a word.
TERM = re.compile(r"[^\W\d_]+")
FIT_ROWS = 40_000
FEATURES = 50_000
LEAST_ROWS = 5  # labelled documents a feature must occur in
LONGEST = 40  # characters of a feature


@dataclass(frozen=True)
class OrdinalModel:
    """Words with weights, and ascending thresholds."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def at_least(self, text: str) -> list[float]:
        """P(grade >= k) for each k."""
        known = self.weights
        score = sum(known[t] for t in known.keys() & set(TERM.findall(text.lower())))
        return [1 / (1 + np.exp(np.clip(t - score, -60, 60))) for t in self.thresholds]


def graded_labels(labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Toxic flags per document, a bounded sample: the `fit_rows` ids with the lowest hash."""
    flags = labels.select(F.col("doc_id").cast("bigint").alias("label_id"), F.col("toxic").cast("int").alias("flag"))
    return (
        flags.where("label_id is not null and flag is not null")
        .groupBy("label_id")
        .agg(F.max("flag").alias("flag"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(fit_rows)
    )


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, grades: int = 3) -> OrdinalModel:
    """Fit on labelled documents.

    Labels only say toxic or not. The grade of a toxic document is the number of different telling words in
    it, up to `grades` - 1, and at least 1; telling words are those the flags themselves pick out.
    """
    work = Workspace(docs.sparkSession, "toxicity")
    sample = F.broadcast(work.table(graded_labels(labels, fit_rows), "labels"))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(w for w in set(TERM.findall(t.lower())) if len(w) <= LONGEST) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["flag", "terms"])

    joined = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).join(sample, F.col("doc_id") == F.col("label_id"))
    rows = work.table(joined.select("flag", "text").mapInArrow(terms, "flag int, terms array<string>"), "terms")
    totals = {r["flag"]: r["n"] for r in rows.groupBy(F.least("flag", F.lit(1)).alias("flag")).agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return OrdinalModel({}, tuple(60.0 + k for k in range(grades - 1)))
    in_bad, in_good = F.sum(F.when(F.col("flag") > 0, 1).otherwise(0)), F.sum(F.when(F.col("flag") <= 0, 1).otherwise(0))
    rate_bad, rate_good = F.col("b") / bad, F.col("g") / good

    def agreement(n: Column, total: int, rate: Column) -> Column:
        """n ln(n / expected) for presence and absence; 0 ln 0 is 0."""
        there = F.when(n > 0, n * F.ln(n / (rate * total))).otherwise(0.0)
        return there + F.when(n < total, (total - n) * F.ln((total - n) / ((1 - rate) * total))).otherwise(0.0)

    rate = (F.col("b") + F.col("g")) / (bad + good)
    ratio = F.greatest(2 * (agreement(F.col("b"), bad, rate) + agreement(F.col("g"), good, rate)), F.lit(0.0))
    z = F.when(rate_bad > rate_good, F.sqrt(ratio)).otherwise(-F.sqrt(ratio))
    compared = work.table(
        rows.select("flag", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(in_bad.alias("b"), in_good.alias("g"))
        .where(f"b + g >= {LEAST_ROWS}")
        .select("term", z.alias("z")),
        "words",
    )
    cut = float(np.sqrt(2 * np.log(max(compared.count(), 2))))
    chosen = (
        compared.where(F.abs("z") >= cut)
        .orderBy(F.desc(F.abs("z")), "term")
        .limit(FEATURES)
        .collect()
    )
    index = {r["term"]: k for k, r in enumerate(chosen)}
    telling = {k for k, r in enumerate(chosen) if r["z"] > 0}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[index[t] for t in terms if t in index] for terms in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["flag", "features"])

    # the bounded sample as patterns with counts: rows with the same features count together
    patterns = (
        rows.mapInArrow(features, "flag int, features array<int>")
        .groupBy(F.least("flag", F.lit(1)).alias("flag"), "features")
        .agg(F.count("*").alias("n"))
        .orderBy("flag", "features")
        .collect()
    )
    work.drop(rows, compared)
    sets = [r["features"] for r in patterns]
    grade = [min(grades - 1, max(1, len(telling.intersection(r["features"])))) if r["flag"] else 0 for r in patterns]
    weights, thresholds = fit_ordinal(sets, np.array(grade), np.array([r["n"] for r in patterns], float), len(index), grades)
    return OrdinalModel({t: float(weights[k]) for t, k in index.items()}, tuple(float(t) for t in thresholds))


def fit_ordinal(
    sets: list[list[int]], grade: np.ndarray, counts: np.ndarray, n_features: int, grades: int, l2: float = 0.1, steps: int = 800, rate: float = 0.1
) -> tuple[np.ndarray, np.ndarray]:
    """Maximum penalised likelihood by Adam; thresholds are a first one plus positive gaps."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    column = np.array([f for s in sets for f in s], int)
    total = counts.sum()
    value = np.zeros(n_features + grades - 1)
    value[n_features] = 1.0
    first, second = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, steps + 1):
        w, theta = value[:n_features], value[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(value[n_features + 1 :]))])
        score = np.bincount(row, w[column], len(sets))
        above = 1 / (1 + np.exp(np.clip(theta[None, :] - score[:, None], -60, 60)))
        upper = np.concatenate([np.ones((len(sets), 1)), above], axis=1)
        lower = np.concatenate([above, np.zeros((len(sets), 1))], axis=1)
        at = (np.arange(len(sets)), grade)
        p = np.maximum(upper[at] - lower[at], 1e-12)
        d_upper, d_lower = upper[at] * (1 - upper[at]) / p * counts, lower[at] * (1 - lower[at]) / p * counts
        d_score = d_upper - d_lower
        d_theta = np.array([d_lower[grade == k].sum() - d_upper[grade == k + 1].sum() for k in range(grades - 1)])
        gradient = np.empty_like(value)
        gradient[:n_features] = np.bincount(column, d_score[row], n_features) - l2 * w
        gradient[n_features] = d_theta.sum()
        for k in range(1, grades - 1):
            gradient[n_features + k] = d_theta[k:].sum() * np.exp(value[n_features + k])
        gradient /= total
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        value += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return value[:n_features], value[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(value[n_features + 1 :]))])


def score(docs: DataFrame, model: OrdinalModel, prefix: str = "") -> DataFrame:
    """Add `at_least` (probabilities), `severity` (expected grade) and `grade` (the last one with at least even
    odds) to `docs`; `prefix` keeps the names apart from those of the documents."""

    @F.pandas_udf("array<double>")
    def chances(texts):
        return texts.map(model.at_least)

    scored = docs.withColumn(f"{prefix}at_least", chances(text_of()))
    return scored.withColumns(
        {
            f"{prefix}severity": F.aggregate(f"{prefix}at_least", F.lit(0.0), lambda a, b: a + b),
            f"{prefix}grade": F.size(F.filter(f"{prefix}at_least", lambda p: p >= 0.5)),
        }
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents of grade 0, with their columns."""
    kept = docs.select(F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return score(kept, fit(docs, labels), "toxicity_").where("toxicity_grade = 0").select("row.*")
