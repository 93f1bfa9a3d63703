import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.llm import whitening
from duebook.llm.catalog import QUERIES
from duebook.llm.common import staged
from duebook.llm.whitening import Iteration

SCHEMA = "vec_id long, embedding array<float>, x int, row string, component int, n int, whitened int"


def frame(spark, vectors):
    rows = [(i, v, 1, "r", 2, 3, 4) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(vectors):
    """Eigenvectors by a dense solver, from whole numbers."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in vectors])
    n, sums = len(x), x.sum(axis=0)
    z = (n * x - sums) / n
    values, axes = np.linalg.eigh(z.T @ z / n)
    deviation = [int(sum(int(d) ** 2 for d in row)) for row in n * x - sums]
    return n, z, values[::-1], axes[:, ::-1], deviation


def check(found, vectors, wanted):
    n, z, values, axes, deviation = plain(vectors)
    assert {r.component for r in found} == set(range(1, wanted + 1))
    assert len(found) == wanted * n
    by_row = {}
    for r in found:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    for j in range(wanted):
        column = np.array([by_row[i][j + 1].whitened for i, _ in vectors])
        expected = z @ axes[:, j] / np.sqrt(values[j])
        assert min(np.abs(column - expected).max(), np.abs(column + expected).max()) < 1e-6
    for (i, _), d in zip(vectors, deviation):
        for j, r in by_row[i].items():
            assert r.deviation == d and r.n == n
            assert r.explained == pytest.approx(values[j - 1] / values.sum(), rel=1e-9)
            assert r.identity_error < 1e-9


def some_vectors(n, d, seed=1):
    r = np.random.default_rng(seed)
    return [(i, v.tolist()) for i, v in enumerate(r.standard_normal((n, d)) * (1 + np.arange(d) / 20) + 3)]


def query_columns(df):
    return df.select("row.vec_id", *df.columns[1:])


def test_block_smaller_than_the_space(spark):
    vectors = some_vectors(700, 40)
    rows = staged(whitening.integers(frame(spark, vectors)), "whitening-test")
    fitted = whitening.fit(rows, Iteration(components=6, guard=6))
    assert 1 < fitted.rounds < 30 and fitted.residual < 1e-11
    assert fitted.n == 700
    found = whitening.components(frame(spark, vectors), settings=Iteration(components=6, guard=6))
    check(query_columns(found).collect(), vectors, 6)


def test_nulls_repeats_and_ragged_rows_take_their_defined_part(spark):
    vectors = some_vectors(60, 5)
    vectors += [(100 + i, vectors[0][1]) for i in range(20)]
    odd = [
        (-1, None),
        (-2, []),
        (-3, [1.0, None, 2.0, 3.0, 4.0]),
        (-4, [1.0, math.nan, 2.0, 3.0, 4.0]),
        (-5, [1.0, math.inf, 2.0, 3.0, 4.0]),
        (-6, [-math.inf] * 5),
        (-7, [1.0, 2.0]),
    ]
    found = whitening.components(frame(spark, vectors + odd))
    check(query_columns(found).collect(), vectors, 5)


def test_components_without_variance_are_left_out(spark):
    vectors = [(i, [*v, v[0], 7.0]) for i, v in some_vectors(50, 3)]
    found = whitening.components(frame(spark, vectors))
    assert {r.component for r in found.collect()} == {1, 2, 3}
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]):
        empty = whitening.components(frame(spark, rows))
        assert empty.columns == found.columns and empty.count() == 0


def test_deviations_are_exact_beyond_a_long():
    x = np.array([[1_000_000 + 2**28, 1_000_000]])
    n, sums = 10**10, (10**16, 10**16 + 3)
    exact = sum(Fraction(n * int(v) - s) ** 2 for v, s in zip(x[0], sums))
    assert whitening._deviations(x, n, sums) == [int(exact)]


def test_registered_query_over_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    found = QUERIES["op13_whitening"](spark, sf_dir)
    assert found.agg(F.max("identity_error")).first()[0] < 1e-9
    check(found.collect(), [(r.vec_id, r.embedding) for r in rows], 32)
