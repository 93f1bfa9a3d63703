import pytest
from pyspark.sql import functions as F

from duebook.operators.quality import FAILURES, HAS_ERROR, Rule, flag_failures
from duebook.plans.publish import publish_judged
from duebook.sources import versions


@pytest.fixture(params=["managed", "folder"])
def store(spark, fresh_name, tmp_path, request):
    table, rejects = fresh_name("clean"), fresh_name("rejects")
    folder = str(tmp_path) if request.param == "folder" else None

    def put(batch, *values, **options):
        rows = spark.createDataFrame([(v,) for v in values], "v int").withColumn("_batch_id", F.lit(batch))
        judged = flag_failures(rows, [Rule("positive", "v > 0")])
        publish_judged(judged, batch, table, rejects, folder=folder, **options)

    def seen():
        return (
            sorted(r.v for r in spark.table(table).collect()),
            sorted((r["_batch_id"], r.v) for r in spark.table(rejects).collect()),
        )

    return table, put, seen


def version_tables(spark, table):
    return {t.name for t in spark.catalog.listTables(pattern=f"{table}_version_*".lower())}


def test_batches_and_reruns(spark, store):
    table, put, seen = store
    put("b1", 1, 2, -1, -2)
    assert seen() == ([1, 2], [("b1", -2), ("b1", -1)])
    put("b2", 3, -3)
    assert seen() == ([3], [("b1", -2), ("b1", -1), ("b2", -3)])
    put("b2", 4, -4, -5)
    assert seen() == ([4], [("b1", -2), ("b1", -1), ("b2", -5), ("b2", -4)])
    put("b3", 5)
    assert seen() == ([5], [("b1", -2), ("b1", -1), ("b2", -5), ("b2", -4)])
    put("b'4")
    assert seen()[0] == []
    assert len(version_tables(spark, table)) == 2, "the current one and the one before"


def test_a_failure_at_any_step_leaves_the_old_pair_whole(spark, store, monkeypatch):
    table, put, seen = store
    put("b1", 1, -1)
    old = seen()

    def fail(*_):
        raise OSError("lost")

    for step in ("replace_partition", "_replace_pair"):
        with monkeypatch.context() as patch:
            patch.setattr(versions, step, fail)
            with pytest.raises(OSError):
                put("b2", 2, -2)
        assert seen() == old
    with monkeypatch.context() as patch:
        patch.setattr(versions, "remove_orphans", fail)
        with pytest.raises(OSError):
            put("b2", 2, -2)
    assert seen() == ([2], [("b1", -1), ("b2", -2)])
    put("b3", 3)
    assert seen() == ([3], [("b1", -1), ("b2", -2)])
    assert len(version_tables(spark, table)) == 2, "versions of failed batches are removed"


def test_a_reader_keeps_its_version_over_one_switch(spark, store):
    table, put, _ = store
    put("b1", 1, 2)
    reader = spark.table(table)
    put("b2", 3)
    assert sorted(r.v for r in reader.collect()) == [1, 2]


def test_a_refused_batch_leaves_nothing(spark, store):
    table, put, seen = store
    put("b1", 1)

    def refuse(version):
        assert spark.table(version.name).count() == 2
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        put("b2", -1, -2, check=refuse)
    assert seen() == ([1], []) and len(version_tables(spark, table)) == 1


def test_layouts_never_change_silently(spark, store):
    table, put, seen = store
    put("b1", 1)
    rows = spark.createDataFrame([("x",)], "v string").withColumn("_batch_id", F.lit("b2"))
    judged = flag_failures(rows, [])
    with pytest.raises(ValueError, match="differ"):
        publish_judged(judged, "b2", table, f"{table}_other")
    assert seen()[0] == [1]


def test_the_clean_view_reads_one_part_only(spark, store):
    table, put, _ = store
    put("b1", 1, -1)
    plan = spark.table(table)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and f"NOT {HAS_ERROR}" in plan and "PartitionFilters: [isnotnull" in plan
    assert FAILURES in spark.table(table).columns
