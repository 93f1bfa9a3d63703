from math import comb

import pytest
from duebook.llm import source_mix
from pyspark.sql import functions as F


def targets(sizes, share=1.5, most=2.0, weights=(5.0, 2.0, 1.0)):
    """Shares are given out in rounds; whoever is above the cap stops there and the rest is reshared."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s] + 1e-9}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mix_of_edge_documents(documents):
    mix = source_mix.Mix(bucket_docs=4)
    rows = source_mix.sized(documents, F.struct("row.doc_id", "row.source", "row.text"))
    found = source_mix.mixed(rows, mix).select("row.*", "size", "source_size", "target", "taken").collect()
    sizes, taken, target = {}, {}, {}
    for r in found:
        assert r["size"] == len((r.text or "").encode().split())
        assert 0 <= r.taken <= 2 * r["size"]
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    expected = targets(sizes)
    assert len(found) == documents.count()
    for s, words in sizes.items():
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - expected[s]) <= 1
    again = source_mix.mixed(rows, mix).select("row.doc_id", "size", "taken").collect()
    assert sorted(map(str, again)) == sorted(str(type(again[0])(doc_id=r.doc_id, size=r["size"], taken=r.taken)) for r in found)


def test_rows_of_the_mix(documents):
    mixed = source_mix.mixed(source_mix.sized(documents, F.col("row")), source_mix.Mix(bucket_docs=4))
    taken = {}
    for r in mixed.select("row.doc_id", "row.text", "taken").collect():
        taken[(r.doc_id, r.text)] = taken.get((r.doc_id, r.text), 0) + r.taken
    rows = source_mix.drawn_rows(mixed).select("row.doc_id", "row.text", "row.n_chars", "words").collect()
    by_id = {}
    for r in rows:
        assert len(r.text.encode().split()) == r.words and r.n_chars == len(r.text)
        assert any(r.text in text for (i, text) in taken if i == r.doc_id and text)
        by_id[r.doc_id] = by_id.get(r.doc_id, 0) + r.words
    for i in {i for i, _ in taken}:
        assert by_id.get(i, 0) == sum(n for (j, _), n in taken.items() if j == i)


def test_hypergeometric_is_the_inverse_of_its_distribution(spark):
    cases = [(50, 20, 10, u / 20 + 0.025) for u in range(20)] + [(9, 0, 4, 0.5), (9, 9, 4, 0.5), (5, 3, 0, 0.1), (0, 0, 0, 0.3)]
    cases += [(4000, 1500, 2000, u / 7 + 0.05) for u in range(7)]
    df = spark.createDataFrame([tuple(map(float, c)) for c in cases], "total double, good double, drawn double, u double")
    found = df.select(
        "*", source_mix.hypergeometric(F.col("total"), F.col("good"), F.col("drawn"), F.col("u")).alias("x")
    ).collect()
    for r in found:
        total, good, drawn = int(r.total), int(r.good), int(r.drawn)
        below = 0
        for x in range(max(0, drawn + good - total), min(good, drawn) + 1):
            below += comb(good, x) * comb(total - good, drawn - x) / comb(total, drawn)
            if below >= r.u - 1e-9:
                break
        assert int(r.x) == x, r


def test_shards_get_exact_quotas(documents):
    rows = source_mix.sized(documents, F.struct("row.doc_id"))
    totals = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    mix = source_mix.Mix(tree_levels=3)
    for r in source_mix.plan(totals, mix).collect():
        assert len(r.begins) == 8 and r.begins[0] == 0
        assert r.begins == sorted(r.begins) and r.begins[-1] <= r.quota


def test_empty(no_documents):
    rows = source_mix.sized(no_documents, F.col("row"))
    assert source_mix.mixed(rows).isEmpty()
