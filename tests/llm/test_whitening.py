"""Whitening against a plain computation in fractions, and its edge cases."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, most=4):
    """vec_id -> deviation and whitened values, explained shares; all sums in whole numbers and fractions."""
    kept = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({v for _, v in kept})
    n, width = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(width)]
    mean = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in fit) / n) for j in range(width)] for i in range(width)])
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:most]
    out = [(i, sum((n * c - s) ** 2 for c, s in zip(v, sums)),
            np.array([float(c - m) for c, m in zip(v, mean)]) @ vectors[:, order] / np.sqrt(values[order])) for i, v in kept]
    return n, out, values[order] / values.sum()


def agrees(frame, rows, most=4):
    n, expected, shares = brute(rows, most)
    got = frame.collect()
    assert len(got) == len(expected) * most
    by = {}
    for r in got:
        assert r.n == n and r.identity_error <= 1e-9 and r.explained == pytest.approx(shares[r.component - 1], rel=1e-9)
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    signs = None
    for i, deviation, values in expected:
        found = np.array([by[i, deviation][k][0] for k in range(1, most + 1)])
        if signs is None and np.abs(values).min() > 1e-6:
            signs = np.sign(found * values)
        if signs is not None:
            assert found * signs == pytest.approx(values, abs=1e-9)
    assert signs is not None


def test_agrees_with_fractions(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", F.slice("embedding", 1, 9).alias("embedding"))
    agrees(whitening.digest(table), [(r.vec_id, r.embedding) for r in table.collect()])


def test_whole_table_matches_the_query(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = whitening.digest(table).toPandas()
    x = np.floor(np.stack(table.toPandas().embedding.values).astype(float) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    for k in range(1, 5):
        found = rows[rows.component == k].sort_values("vec_id").whitened.to_numpy()
        plain = (x - fit.mean(axis=0)) @ vectors[:, -k] / np.sqrt(values[-k])
        assert min(np.abs(found - plain).max(), np.abs(found + plain).max()) < 1e-9


def test_what_cannot_be_used_is_dropped(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(40)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 1.0, 2.0]), (103, [1.0, float("inf"), 2.0]), (104, [1.0, 2.0, float("-inf")])]
    frame = spark.createDataFrame(rows + rows[:7] + [(None, rows[0][1])] + odd, SCHEMA)
    more = frame.withColumns({"__x": F.lit(1), "n": F.lit("a"), "component": F.lit(None).cast("int")})
    agrees(whitening.digest(more), rows + rows[:7] + [(None, rows[0][1])], 3)


def test_hot_vector_counts_once(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(size=4)]) for i in range(30)]
    agrees(whitening.digest(spark.createDataFrame(rows + rows[:1] * 400, SCHEMA)), rows + rows[:1] * 400)


def test_without_variance_there_are_no_components(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]):
        assert whitening.digest(spark.createDataFrame(rows, SCHEMA)).collect() == []
    flat = [(1, [1.0, 5.0]), (2, [2.0, 5.0]), (3, [4.0, 5.0])]
    assert {r.component for r in whitening.digest(spark.createDataFrame(flat, SCHEMA)).collect()} == {1}


def test_shorter_vectors_end_in_zeros(spark):
    rows = [(1, [1.0]), (2, [2.0, 1.0]), (3, [0.5, 3.0]), (4, [])]
    full = [(i, (v + [0.0, 0.0])[:2]) for i, v in rows]
    agrees(whitening.digest(spark.createDataFrame(rows, SCHEMA)), full, 2)


def test_huge_entries_are_summed_exactly(spark):
    rows = [(1, [3.0e12, 1.0]), (2, [-2.5e13, 2.0]), (3, [1.0, 4.0e12]), (4, [7.0e11, -5.0])]
    exact = {i: d for i, d, _ in brute(rows, 2)[1]}
    got = {r.vec_id: int(r.deviation) for r in whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == exact
    assert {r.deviation for r in whitening.digest(spark.createDataFrame(rows, SCHEMA)).collect()} == {None}
    beyond = spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 0.0])], SCHEMA)
    assert {r.vec_id for r in whitening.digest(beyond).collect()} == {1, 2, 3}


def test_limbs_hold_what_decimals_cannot():
    total = 7 * 10 ** 50 + 12345
    batch = whitening._limbs({(0, 1): total, (1, 1): -5}).to_pylist()
    assert [int(r["high"]) * whitening.LIMB + int(r["low"]) for r in batch] == [total, -5]
