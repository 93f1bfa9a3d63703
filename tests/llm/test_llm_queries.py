"""Registered text queries against SQL on DuckDB, and that every one of them gives whole tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from duebook.llm.catalog import ANSWERS, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
EVERY_ROW = {
    "op1_page_text": "pages",
    "op2_source_mix": "documents",
    "op4_context_mixing": "documents",
    "op5_host_rules": "documents",
    "op6_pieces": "documents",
    "op7_url_rules": "pages",
    "op8_personal_data": "documents",
    "op9_near_copies": "documents",
    "op10_token_scan": "documents",
    "op11_token_alignment": "documents",
}


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    answer = duck.execute(ANSWERS[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(tuple(str(v) for v in row) for row in answer.fetchall())
    assert expected
    assert sorted(tuple(str(row[c]) for c in columns) for row in df.collect()) == expected


@pytest.mark.parametrize("name", sorted(EVERY_ROW))
def test_one_result_per_row(spark, name):
    rows = spark.read.parquet(f"{SF_DIR}/{EVERY_ROW[name]}.parquet")
    key = rows.columns[0]
    found = QUERIES[name](spark, SF_DIR).select(key)
    assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in rows.select(key).collect())


def test_native_queries_run_no_python(spark):
    for name in ("op2_source_mix", "op5_host_rules"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        for word in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan


def test_pipeline_stages(spark):
    from duebook.llm import host_rules, near_copies, personal_data
    from duebook.llm.common import staged, table
    from pyspark.sql import functions as F

    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "private_spans", "target_mix", "token_ids"]

    kept = staged(stages["quality_rules"](spark, docs, SF_DIR), "test")
    verdict = QUERIES["op5_host_rules"](spark, SF_DIR).where("kept").select("doc_id")
    assert kept.columns == columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in verdict.collect())

    single = staged(stages["near_duplicates"](spark, kept, SF_DIR), "test")
    groups = near_copies.grouped(kept).select("component_id").distinct()
    assert single.columns == columns
    assert sorted(r[0] for r in single.select("doc_id").collect()) == sorted(r[0] for r in groups.collect())

    private = staged(stages["private_spans"](spark, single, SF_DIR), "test")
    texts = {r.doc_id: r.text for r in single.collect()}
    assert private.columns == columns and private.count() == single.count()
    for r in private.collect():
        assert r.n_chars == len(r.text)
        assert not personal_data.base_spans(r.text)
        if not personal_data.HINT.search(texts[r.doc_id]):
            assert r.text == texts[r.doc_id]

    mixed = staged(stages["target_mix"](spark, private, SF_DIR), "test")
    assert mixed.columns == columns
    count = F.sum(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")))
    before, after = (d.agg(count).first()[0] for d in (private, mixed))
    assert abs(after - 1.5 * before) <= 20

    last = stages["token_ids"](spark, mixed, SF_DIR)
    assert last.where("round_trip").count() == mixed.count()
