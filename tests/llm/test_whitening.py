"""Whitening against a dense eigendecomposition, and the rank-one updates against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import whitening as wh
from martloom.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>"


def checked(spark_rows, vectors):
    """Compare result rows with numpy on `vectors`, the usable (vec_id, vector) pairs."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in vectors], dtype=object)
    distinct = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, sums = len(distinct), distinct.sum(0)
    centred = lambda a: np.array([[float(v * n - s) / n for v, s in zip(r, sums)] for r in a])
    fit = centred(distinct)
    values, axes = np.linalg.eigh(fit.T @ fit / n)
    values, axes = values[::-1], axes[:, ::-1]
    count = min(16, int((values > 1e-12 * values.sum()).sum()))
    deviations = [sum((n * v - s) ** 2 for v, s in zip(r, sums)) for r in x]
    white = centred(x) @ axes[:, :count] / np.sqrt(values[:count])
    rows = {}
    for r in spark_rows:
        rows.setdefault((r.vec_id, r.component), []).append(r)
    assert sum(map(len, rows.values())) == len(vectors) * count
    signs = {}
    for (vec_id, _), expected, deviation in zip(vectors, white, deviations):
        for k in range(count):
            for r in rows[vec_id, k + 1]:
                assert (r.n, r.deviation) == (n, deviation)
                assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
                assert r.identity_error <= 1e-8
                if abs(expected[k]) > 1e-3:
                    signs.setdefault(k, np.sign(r.whitened * expected[k]))
                assert r.whitened * signs.get(k, 1) == pytest.approx(expected[k], abs=1e-6)


@pytest.mark.parametrize("dims", [1, 2, 7, 40])
def test_rank_one_updates(dims):
    draw = np.random.default_rng(dims)
    for scale in (1e-6, 1.0, 1e9):
        values, vectors, wanted = np.zeros(dims), np.eye(dims), np.zeros((dims, dims))
        for k in range(3 * dims + 5):
            v = draw.normal(size=dims) * scale
            if k % 4 == 1:
                v[: dims // 2] = 0
            if k % 5 == 2:
                v = np.round(v / scale) * scale
            rho = float(draw.uniform(0, 2))
            values, vectors = wh.rank_one(values, vectors, rho, v)
            wanted += rho * np.outer(v, v)
        size = np.abs(wanted).max()
        assert np.abs(vectors @ np.diag(values) @ vectors.T - wanted).max() < 1e-11 * size
        assert np.abs(vectors.T @ vectors - np.eye(dims)).max() < 1e-11
        assert np.all(np.diff(values) >= 0)


def test_spectra_combine():
    draw = np.random.default_rng(4)
    x = draw.integers(-40, 40, (300, 9)) + wh.SHIFT
    parts = []
    for rows in (x[:1], x[1:5], x[5:200], x[200:200], x[200:]):
        part = wh.Spectrum(9)
        for row in rows:
            part.add(row)
        parts.append(wh.Spectrum.load(9, part.dump()))
    for part in parts[1:]:
        parts[0].merge(part)
    whole = parts[0]
    assert whole.n == 300 and (whole.sums == x.sum(0)).all()
    centred = x - x.mean(0)
    assert np.allclose(whole.vectors @ np.diag(whole.values) @ whole.vectors.T, centred.T @ centred, rtol=1e-9, atol=1e-7)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_awkward_vectors(spark, parts):
    draw = np.random.default_rng(1)
    good = [(i, [float(np.float32(c)) for c in draw.normal(size=20)]) for i in range(60)]
    good += [good[3], (None, good[4][1]), (-7, [0.0] * 20), (70, [1e-3] * 20), (71, [-1e-3] * 20)] + [(100 + i, good[0][1]) for i in range(80)]
    bad = [(1, None), (2, []), (5, [1.0, 2.0]), (6, [None] + [0.0] * 19), (7, [float("nan")] + [0.0] * 19), (8, [float("inf")] * 20)]
    df = spark.createDataFrame(good + bad, SCHEMA).withColumns({c: F.lit("x") for c in ("x", "v", "n", "slot", "state", "component")})
    found = wh.whitened(df, parts=parts)
    assert found.columns == [c.split()[0] for c in wh.WHITE_ROW.split(", ")]
    checked(found.collect(), good)


def test_little_variance(spark):
    flat = [(i, [float(i % 3), 2.0, float(i % 3) * 2]) for i in range(9)]
    checked(wh.whitened(spark.createDataFrame(flat, SCHEMA), parts=3).collect(), flat)
    for rows in ([], [(1, [0.5, 1.0])], [(1, [0.5, 1.0])] * 4, [(1, None)]):
        assert wh.whitened(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_large_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 1e9])]
    found = wh.whitened(spark.createDataFrame(rows, SCHEMA), parts=2).collect()
    assert len(found) in (3, 6) and all(r.deviation is None for r in found if r.vec_id != 3)


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_query(spark, size):
    sf_dir = f"/root/testdata/sf{size}"
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    checked(QUERIES["op11_whitening"](spark, sf_dir).collect(), [tuple(r) for r in table])
