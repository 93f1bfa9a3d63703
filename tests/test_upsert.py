import os
import pathlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from duebook.contracts import PAYMENTS, PLACEMENTS
from duebook.plans.ingest import ingest_payments, ingest_placements
from duebook.sources import upsert as module
from duebook.sources.upsert import rewritten, upsert

SCHEMA = "id string, value int, month string, arrived int"
AS_OF = date(2024, 6, 30)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(spark, table):
    return sorted(tuple(r[c] for c in ("id", "value", "month", "arrived")) for r in spark.table(table).collect())


@pytest.fixture
def store(spark, fresh_name):
    table = fresh_name("upserted")

    def put(*rows):
        return upsert(frame(spark, *rows), table, ["id"], "month", ["arrived"])

    return table, put


def files(spark, table):
    return {
        r.name: r.month
        for r in spark.table(table).select(F.input_file_name().alias("name"), "month").distinct().collect()
    }


def test_corrections_moves_late_rows_and_reruns(spark, store):
    table, put = store
    done = put(("a", 1, "01", 1), ("b", 1, "01", 1), ("c", 1, "02", 1), ("d", 1, "03", 1), ("e", 1, "04", 1))
    assert done.partitions == ("01", "02", "03", "04") and done.rows == 5
    before = files(spark, table)
    done = put(("a", 2, "01", 2), ("c", 2, "05", 2), ("d", 0, "03", 0), ("f", 2, "06", 2), ("a", 9, "01", 1))
    assert done == module.Upserted(("01", "02", "05", "06"), 3, 1)
    expected = [
        ("a", 2, "01", 2), ("b", 1, "01", 1), ("c", 2, "05", 2), ("d", 1, "03", 1),
        ("e", 1, "04", 1), ("f", 2, "06", 2),
    ]
    assert content(spark, table) == expected, "'c' left its month and 'd' arrived too late"
    kept = {name for name, month in before.items() if month in ("03", "04")}
    assert kept <= set(files(spark, table)), "untouched months keep their files"
    done = put(("a", 2, "01", 2), ("c", 2, "05", 2), ("f", 2, "06", 2))
    assert done.rows == 3 and content(spark, table) == expected
    assert put(("e", 0, "09", 0)).partitions == ()
    assert content(spark, table) == expected


def test_a_hot_month_and_key_columns_only(spark, store, monkeypatch):
    table, put = store
    put(*[(f"k{i}", 1, "01" if i % 3 else "02", 1) for i in range(300)])
    monkeypatch.setattr(module, "broadcast_if_small", lambda df: df.hint("merge"))
    put(*[(f"k{i}", 2, "01", 2) for i in range(0, 300, 2)])
    rows = content(spark, table)
    assert len(rows) == 300 and sum(r[1] for r in rows) == 450
    current = spark.table(table)
    new = frame(spark, ("k1", 3, "02", 3))
    plan = module.judged(new, current, ["id"], "month", ["arrived"])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line or "ReadSchema" in line]
    assert scans and not any("value" in line for line in scans)
    plan = rewritten(current, new, ["id"], "month", ["02"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan or "PartitionFilters: [month" in plan


def test_empty_batches(spark, store):
    table, put = store
    put(("a", 1, "01", 1))
    none = upsert(frame(spark).limit(0), table, ["id"], "month", ["arrived"])
    assert none == module.Upserted((), 0, 0)
    assert content(spark, table) == [("a", 1, "01", 1)]


def land(folder, contract, lines, arrived):
    folder.mkdir(exist_ok=True)
    file = folder / f"f{arrived}.csv"
    file.write_text("\n".join([",".join(contract.fieldNames()), *lines]) + "\n")
    os.utime(file, (arrived, arrived))
    return str(folder)


def test_payments_over_batches(spark, tmp_path, fresh_name, ansi):
    names = dict(table=fresh_name("payments"), quarantine_table=fresh_name("rejects"))

    def run(batch, arrived, *lines):
        path = land(tmp_path / batch, PAYMENTS, lines, arrived)
        return ingest_payments(spark, path, batch_id=batch, as_of=AS_OF, limit=0.6, **names)

    run("b1", 1000, "P1,C1,2024-01-05,10.00,CARD", "P2,C1,2024-02-05,20.00,CARD", "P3,C1,2024-02-06,-1.00,CARD")
    run("b2", 3000, "P1,C1,2024-03-05,11.00,CARD", "P3,C1,2024-02-06,1.00,CARD", ",C9,2024-01-01,1.00,CARD")
    done = run("late", 2000, "P1,C1,2024-01-05,99.00,CARD", "P4,C2,2024-01-09,4.00,CARD")
    assert done.metrics["rows_total"] == 2
    run("b2", 3000, "P1,C1,2024-03-05,11.00,CARD", "P3,C1,2024-02-06,1.00,CARD", ",C9,2024-01-01,1.00,CARD")
    rows = spark.table(names["table"]).collect()
    assert sorted((r.payment_id, str(r.amount), r.payment_month, r["_batch_id"]) for r in rows) == [
        ("P1", "11.00", "2024-03", "b2"),
        ("P2", "20.00", "2024-02", "b1"),
        ("P3", "1.00", "2024-02", "b2"),
        ("P4", "4.00", "2024-01", "late"),
    ]
    rejects = spark.table(names["quarantine_table"]).collect()
    assert sorted((r["_batch_id"], r.payment_id or "") for r in rejects) == [("b1", "P3"), ("b2", "")]


def test_the_breaker_stops_a_batch_of_changes(spark, tmp_path, fresh_name):
    table = fresh_name("payments")
    path = land(tmp_path / "x", PAYMENTS, ["P1,C1,2024-01-05,-1.00,CARD"], 1000)
    with pytest.raises(ValueError, match="quarantined"):
        ingest_payments(spark, path, batch_id="b", as_of=AS_OF, table=table, quarantine_table=fresh_name("r"))
    assert not spark.catalog.tableExists(table)
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    assert not list(shared.glob("ingest-b-*")) and not list(shared.glob("upsert-*"))


def test_placements_have_two_keys(spark, tmp_path, fresh_name):
    names = dict(table=fresh_name("placements"), quarantine_table=fresh_name("rejects"))
    for batch, arrived, lines in (
        ("b1", 1000, ["C1,A,2024-01-05,", "C1,B,2024-02-05,2024-02-01"]),
        ("b2", 2000, ["C1,A,2024-01-05,2024-01-09", "C2,,2024-01-05,"]),
    ):
        path = land(tmp_path / batch, PLACEMENTS, lines, arrived)
        ingest_placements(spark, path, batch_id=batch, as_of=AS_OF, limit=0.6, **names)
    rows = spark.table(names["table"]).collect()
    assert sorted((r.client_id, str(r.first_contact_date), r["_dq_failures"]) for r in rows) == [
        ("A", "2024-01-09", []),
        ("B", "2024-02-01", ["contact_not_before_placement"]),
    ]
    assert spark.table(names["quarantine_table"]).count() == 1


def test_rewritten_months_and_reduced_changes_are_not_staged(spark, store, monkeypatch):
    table, put = store
    put(("a", 1, "01", 1), ("b", 1, "02", 1), ("c", 1, "02", 1))
    purposes = []

    def noted(df, purpose, *rest):
        purposes.append(purpose)
        return staged(df, purpose, *rest)

    staged = module.staged
    monkeypatch.setattr(module, "staged", noted)
    moved = frame(spark, ("a", 2, "02", 2), ("c", 2, "03", 2))
    done = upsert(moved, table, ["id"], "month", ["arrived"], reduced=True)
    assert done == module.Upserted(("01", "02", "03"), 2, 0)
    assert content(spark, table) == [("a", 2, "02", 2), ("b", 1, "02", 1), ("c", 2, "03", 2)]
    assert spark.table(table).where("month = '01'").isEmpty()
    put(("b", 3, "03", 3))
    assert purposes == ["upsert-verdicts", "upsert-changes", "upsert-verdicts"]
    assert content(spark, table) == [("a", 2, "02", 2), ("b", 3, "03", 3), ("c", 2, "03", 2)]
