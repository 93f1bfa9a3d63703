import numpy as np
import pytest

from duebook.llm import metric_tree
from duebook.llm.metric_tree import Tree
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, v string, key string"


def brute_force(rows, k, asked):
    """Whole rows against each other; ids may repeat."""
    good = [
        (n, i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v])
        for n, (i, v, *_) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for n, i, q in good:
        if asked(i):
            scores = sorted(
                (-sum(a * b for a, b in zip(q, v)), j) for m, j, v in good if m != n and len(v) == len(q)
            )[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("tree", [Tree(), Tree(pivots=4, page=8, node=2, queries=2)])
def test_edges_against_brute_force(spark, tree):
    rng = np.random.default_rng(4)
    vectors = [[float(x) for x in v] for v in rng.normal(0, 1, (80, 6))]
    rows = [(i, v, 0, "v", "k") for i, v in enumerate(vectors)]
    rows += [(200 + i, vectors[7], 1, None, None) for i in range(12)]  # one common vector
    rows += [(300 + i, [round(x) for x in vectors[i]], 1, "", "") for i in range(20)]  # ties
    rows += [
        (400, None, None, None, None), (405, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, "v", "k"),
        (410, [float("nan")] * 6, 1, "v", "k"), (415, [float("inf")] + [0.0] * 5, 1, "v", "k"),
        (None, vectors[1], 1, "v", "k"), (420, [1.0, 2.0], 1, "v", "k"), (425, [2.0, 1.0], 1, "v", "k"),
        (5, vectors[5], 0, "v", "k"), (430, [0.0] * 6, 0, "v", "k"), (435, [3.0], 0, "v", "k"),
    ]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], *rest) for i, v, *rest in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = metric_tree.top_k(metric_tree.integers(df), F.col("vec_id") % 5 == 0, tree)
    assert sorted(tuple(r) for r in found.collect()) == brute_force(rows, 5, lambda i: i % 5 == 0)


def test_empty_and_huge(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert metric_tree.top_k(metric_tree.integers(empty), F.lit(True)).isEmpty()
    rows = [(i, [3e30 * (-1) ** i, 1.0], 0, "", "") for i in range(4)]
    huge = metric_tree.top_k(metric_tree.integers(spark.createDataFrame(rows, SCHEMA)), F.lit(True))
    assert huge.count() == 12


def test_pages_prune_and_stay_exact():
    rng = np.random.default_rng(0)
    centres = rng.integers(-2000, 2000, (8, 10))
    x = centres[rng.integers(0, 8, 600)] + rng.integers(-20, 20, (600, 10))
    q = x[:30]
    longest = float(np.sqrt((x**2).sum(axis=1)).max())
    score, entry = metric_tree.search_page(q, np.full(30, -np.inf), x, np.arange(600), longest, Tree())
    for i in range(30):
        exact = sorted(((-int(q[i] @ v), j) for j, v in enumerate(x)))[:6]
        assert [(-int(s), int(e)) for s, e in zip(score[i], entry[i])] == exact
