"""Exact parts against plain integers, components against numpy's eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import whitening
from millrace.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows):
    """(n, x, S, V) of the usable rows (vec_id, vector)."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    moved = (n * x - sums).astype(float) / n
    return n, x, sums, moved.T @ moved / n


def check(found, rows, keep=32):
    n, x, sums, v = plain(rows)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > 1e-9 * values[0]).sum())
    count = min(keep, rank)
    assert len(found) == n * count
    by_row = {}
    for r in found:
        by_row.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    deviations = [int(((n * row - sums) ** 2).sum()) for row in x]
    assert {(k, d) for (k, _), d in zip(rows, deviations)} == set(by_row)
    moved = (n * x - sums).astype(float) / n
    for component in range(1, count + 1):
        e = values[component - 1]
        expected = moved @ vectors[:, component - 1] / math.sqrt(e)
        own = np.array([by_row[k, d][component]["whitened"] for (k, _), d in zip(rows, deviations)])
        sign = 1 if own @ expected > 0 else -1
        gap = min(abs(e - f) for i, f in enumerate(values) if i != component - 1) if len(values) > 1 else e
        if gap > 1e-6 * e:
            assert np.allclose(sign * own, expected, atol=1e-7)
        assert by_row[rows[0][0], deviations[0]][component]["explained"] == pytest.approx(e / np.trace(v), rel=1e-9)
        assert by_row[rows[0][0], deviations[0]][component]["n"] == n
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9


def test_query_on_all_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    found = QUERIES["op13_exact_whitening"](spark, "/root/testdata/sf0.001").collect()
    check(found, [(r["vec_id"], r["embedding"]) for r in table if r["embedding"] is not None])


def test_few_dimensions_bad_rows_repeats_and_clashes(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(40)]
    good += [good[0]] * 15 + [(None, [0.5] * 5)]
    bad = [(100, None), (101, [0.0, None, 1.0, 2.0, 3.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(good + bad, SCHEMA).repartition(4)
    for name in ("vector", "deviation", "component", "n", "whitened"):
        frame = frame.withColumn(name, F.lit("clash"))
    found = whitening.whiten_table(frame).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4, 5}
    unique = list({repr(r): r for r in good}.values())
    assert len(found) == len(good) * 5
    by_row = {(r["vec_id"], r["component"]): r["whitened"] for r in found}
    assert len(by_row) == len(unique) * 5
    whitened = np.array([[by_row[k, c] for c in range(1, 6)] for k, _ in good])
    assert np.allclose(whitened.T @ whitened / len(good), np.eye(5), atol=1e-9)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 9):
        frame = spark.createDataFrame(rows, SCHEMA)
        found = whitening.whiten_table(frame)
        assert found.count() == 0 and found.columns[:2] == ["vec_id", "component"]


def test_rank_below_the_dimensions_and_equal_eigenvalues(spark):
    # Two equal eigenvalues, one smaller, one zero.
    rows = [(0, [1.0, 0, 0, 2]), (1, [-1.0, 0, 0, 2]), (2, [0, 1.0, 0, 2]), (3, [0, -1.0, 0, 2]), (4, [0, 0, 0.5, 2]), (5, [0, 0, -0.5, 2])]
    frame = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in rows], SCHEMA)
    found = whitening.whiten_table(frame).collect()
    check(found, rows)
    assert {r["component"] for r in found} == {1, 2, 3}
    shares = {r["component"]: r["explained"] for r in found}
    assert shares[1] == shares[2] == pytest.approx(4 / 9) and shares[3] == pytest.approx(1 / 9)


def test_other_lengths_are_refused(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, [0.0, 5.0])], SCHEMA)
    with pytest.raises(Exception, match="components"):
        whitening.whiten_table(frame).collect()


def exact_polynomial(matrix):
    """Coefficients of det(x - matrix), constant first, by Faddeev and LeVerrier in fractions."""
    size = len(matrix)
    a = [[Fraction(v) for v in row] for row in matrix]
    m = [[Fraction(0)] * size for _ in range(size)]
    found = [Fraction(1)]
    for k in range(1, size + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(size)) + (found[-1] if i == j else 0) for j in range(size)] for i in range(size)]
        am = [[sum(a[i][t] * m[t][j] for t in range(size)) for j in range(size)] for i in range(size)]
        found.append(-sum(am[i][i] for i in range(size)) / k)
    return [int(c) for c in reversed(found)]


@pytest.mark.parametrize("size", [1, 2, 7])
def test_polynomial_is_exact(spark, size):
    rng = np.random.default_rng(size)
    half = rng.integers(-(10**9), 10**9, (size, size + 1)).astype(object)
    matrix = (half @ half.T).tolist()
    assert whitening.characteristic_polynomial(spark, matrix) == exact_polynomial(matrix)


def test_roots_with_multiplicities_and_neighbours():
    def from_roots(roots):
        own = [1]
        for r in roots:
            own = [(own[i - 1] if i else 0) - (r * own[i] if i < len(own) else 0) for i in range(len(own) + 1)]
        return own

    roots = [10**12, 10**12 - 1, 7, 7, 7, 3, 0, 0]
    found = whitening.largest_roots(from_roots(roots), 10)
    assert [(Fraction(a, 1 << b), n) for a, b, n in found] == [(10**12, 1), (10**12 - 1, 1), (7, 3), (3, 1)]
    assert whitening.roots_above(from_roots(roots), 7) == 2
    # Irrational: the roots of x * x - 4 x + 2.
    (high, low) = whitening.largest_roots([2, -4, 1], 2)
    assert abs(Fraction(high[0], 1 << high[1]) + Fraction(low[0], 1 << low[1]) - 4) < Fraction(1, 1 << 300)


def test_products_of_any_size_are_exact():
    rng = np.random.default_rng(1)
    for most in (1, 1000, 1 << 30, (1 << 62) - 1):
        x = rng.integers(-most, most + 1, (5000, 3))
        assert whitening.product_sum(x) == (x.astype(object).T @ x.astype(object)).tolist()
    values = [0, 1, -1, 1 << 130, -(1 << 130) + 12345]
    for v in values:
        assert sum(p << (whitening.PART_BITS * k) for k, p in enumerate(whitening._parts(v))) == v
