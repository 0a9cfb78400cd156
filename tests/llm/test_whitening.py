"""Whitening against whole-number arithmetic in plain Python."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from carelake.llm import whitening
from carelake.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<double>, label int, x int, n long"


def expected(rows):
    """Per usable row: its integers; per length: fit list, sums and exact covariance."""
    kept, spaces = [], {}
    for vec_id, vector in rows:
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector):
            x = tuple(min(max(math.floor(Fraction(c) * 256), -(2**63)), 2**63 - 1) for c in vector)
            kept.append((vec_id, x))
            spaces.setdefault(len(x), set()).add(x)
    models = {}
    for width, fit in spaces.items():
        n, sums = len(fit), [sum(x[i] for x in fit) for i in range(width)]
        cov = [[Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit), n**3) for j in range(width)]
               for i in range(width)]
        models[width] = (n, sums, cov)
    return kept, models


def check(rows, got, components=4):
    kept, models = expected(rows)
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.component), []).append(r)
    assert len(got) == sum(min(len(x), components) for _, x in kept)
    for vec_id, x in kept:
        n, sums, cov = models[len(x)]
        values, vectors = np.linalg.eigh(np.array([[float(v) for v in row] for row in cov]).reshape(len(x), len(x)))
        far = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        trace = float(sum(cov[i][i] for i in range(len(x))))
        for k in range(1, min(len(x), components) + 1):
            near = []
            for r in found[vec_id, k]:
                near.append(r.n == n and r.deviation_text == str(far) and r.deviation == (far if far < 2**63 else None))
                e = values[-k]
                if trace and near[-1]:
                    assert r.explained == pytest.approx(max(e, 0) / trace, rel=1e-9, abs=1e-12)
                if trace and e > 1e-9 * values[-1]:
                    assert r.identity_error < 1e-6
                    want = abs(sum(float(Fraction(a) - Fraction(s, n)) * v for a, s, v in zip(x, sums, vectors[:, -k], strict=True))) / math.sqrt(e)
                    near[-1] = near[-1] and abs(r.whitened) == pytest.approx(want, rel=1e-6, abs=1e-6)
                elif not trace:
                    assert r.whitened is None and r.explained is None and r.identity_error is None
            assert any(near), (vec_id, k)


def test_whitening_matches_whole_numbers(spark, scratch):
    r = random.Random(5)
    vectors = [[r.gauss(0, 1 + d) + d for d in range(6)] for _ in range(300)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, vectors[7]) for i in range(200)]
    df = spark.createDataFrame([(*row, 1, 2, 3) for row in rows], SCHEMA).repartition(7)
    got = whitening.whitened(df, scratch).collect()
    check(rows, got)
    signs = {(r.component, r.whitened) for r in got if r.vec_id == 7 or r.vec_id >= 1000}
    assert len(signs) == 4  # one result for equal vectors


def test_odd_vectors(spark, scratch):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25]), (2, [0.25, 1.0]), (2, [0.125, 0.1]), (None, [0.5, -0.25]), (3, None), (4, [None, 1.0]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [-inf, 0.0]), (8, []), (9, [3.0, 1.0, 2.0, 5.0, 7.0]), (10, [-0.0, 0.0]),
            (11, [1e-300, -1e-300]), (12, [0.7]), (13, [0.8]), (14, [0.7])]
    df = spark.createDataFrame([(*row, 1, 2, 3) for row in rows], SCHEMA)
    check(rows, whitening.whitened(df, scratch).collect())
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whitened(empty, Scratch(spark, "none")).count() == 0


def test_sums_beyond_a_long_stay_exact(spark, scratch):
    r = random.Random(6)
    rows = [(i, [r.uniform(-1, 1) * 10.0**p for p in (16, 14, 3)]) for i in range(40)] + [(99, [1e300, -1e300, 0.0])]
    df = spark.createDataFrame([(*row, 1, 2, 3) for row in rows], SCHEMA)
    got = whitening.whitened(df, scratch).collect()
    kept, models = expected(rows)
    n, sums, _ = models[3]
    far = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for i, x in kept}
    assert all(row.deviation_text == str(far[row.vec_id]) and row.deviation is None for row in got)


def test_planes_give_exact_products():
    r = np.random.default_rng(3)
    x = np.stack([r.integers(-300, 300, 9000), r.integers(0, 2, 9000), np.full(9000, -5),
                  r.integers(-2**40, 2**40, 9000)], axis=1)
    planes = whitening.Planes(x.min(0), x.max(0))
    planes.add(x[:100])
    planes.add(x[100:])
    shifted = (x - x.min(0)).astype(object)
    want = {(i, j): int((shifted[:, i] * shifted[:, j]).sum()) for i in range(4) for j in range(i, 4)}
    got = {}
    for i, j, limb, value in planes.rows():
        got[i, j] = got.get((i, j), 0) + (value << (whitening.LIMB_BITS * limb))
    assert all(got.get(k, 0) == v for k, v in want.items())
    assert all(got.get((i, -1), 0) == int(shifted[:, i].sum()) for i in range(4))
