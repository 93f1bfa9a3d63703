import numpy as np
import pyarrow as pa
import pytest

from duebook.llm import near_copies
from duebook.llm.hashing import shingle_sets, word_hashes
from duebook.llm.near_copies import Likeness


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def brute_force(rows, like):
    """Smallest id reachable, over all pairs."""
    sets = [(i, shingles(t, like.words)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= like.percent * len(a | b):
                one, two = find(i), find(j)
                root[max(one, two)] = min(one, two)
    return {i: find(i) for i in root}


@pytest.mark.parametrize("like", [Likeness(), Likeness(words=3, percent=85), Likeness(tile=2)])
def test_edges_against_brute_force(documents, like):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    expected = brute_force(rows, like)
    found = near_copies.grouped(documents, like).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None
        elif r.n_shingles:
            assert r.component_id == expected[r.doc_id], r
        else:
            assert r.component_id == r.doc_id
    sizes = sorted((r.doc_id or -1, r.n_shingles) for r in found)
    assert sizes == sorted((i if i is not None and i != 0 else (-1 if i is None else -1), len(shingles(t, like.words))) for i, t in rows)


def test_group_that_is_linked_only_through_its_source(spark):
    """Copies with edits of their own are near the source and too far from each other."""
    rng = np.random.default_rng(3)
    source = [f"t{i}" for i in rng.integers(0, 5000, 300)]
    rows = [(50, " ".join(source))]
    for k in range(40):
        copy = list(source)
        for at in rng.choice(290, 6, replace=False):
            copy[at] = f"edit{k}_{at}"
        rows.append((k if k < 20 else 100 + k, " ".join(copy)))
    like = Likeness(words=3, percent=85, tile=8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_force(rows, like)
    assert {r.doc_id: r.component_id for r in near_copies.grouped(df, like).collect()} == expected


def test_one_of_each(documents, no_documents):
    kept = near_copies.one_of_each(documents)
    assert kept.columns == documents.columns
    groups = near_copies.grouped(documents)
    linked = groups.where("n_shingles > 0 AND doc_id IS NOT NULL").select("component_id").distinct().count()
    loose = groups.where("n_shingles = 0 OR doc_id IS NULL").count()
    assert kept.count() == linked + loose
    assert near_copies.one_of_each(no_documents).isEmpty()


def test_hashes_tell_words_and_texts_apart():
    texts = ["A b", "a  b\t", None, "", "ab", "é x", "x" * 5000, "y " * 3_000_00]
    hashes, counts = word_hashes(pa.array(texts))
    assert counts.tolist() == [len((t or "").encode().split()) for t in texts]
    assert (hashes[:2] == hashes[2:4]).all() and hashes[4] not in hashes[:4]
    assert len(np.unique(hashes[-3000:])) == 1
    sets = list(shingle_sets(pa.array(["a b", "a b c", "b a", "a b"]), 3))
    assert [len(s) for s in sets] == [1, 1, 1, 1]
    assert sets[0][0] == sets[3][0] and len({int(s[0]) for s in sets}) == 3


def test_common_counts_are_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (5000, 3000, 10, 6000)]
    found = near_copies.common_counts(sets)
    assert all(found[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets))
