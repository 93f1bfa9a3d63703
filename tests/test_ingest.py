import pathlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from duebook.contracts import PAYMENTS, RAW_CASES
from duebook.operators.privacy import forbidden_columns
from duebook.operators.quality import FAILURES
from duebook.plans.ingest import ingest_cases, silver_cases, silver_payments
from duebook.plans.publish import publish_training_set
from duebook.sources.landing import read_landing

NAMES = RAW_CASES.fieldNames()
AS_OF = date(2024, 6, 30)


def line(reference, **values):
    row = {
        "case_reference": reference,
        "portfolio_id": "PF",
        "national_id": "123",
        "debtor_name": "Ann",
        "original_balance": "100.00",
        "current_balance": "90.00",
        "default_date": "2023-01-01",
        "currency": "PLN",
    } | values
    return ",".join(row.get(n, "") for n in NAMES)


GOOD = [line(f"C{i}") for i in range(40)]
BAD = [
    line("", national_id="1"),
    line("", national_id="2"),
    line("N1", current_balance="-5"),
    line("U1", current_balance="lots"),
    "broken,line",
    "broken,line",
]


@pytest.fixture
def landing_folder(tmp_path):
    def write(*lines, header=NAMES):
        folder = tmp_path / "landing"
        folder.mkdir(exist_ok=True)
        (folder / "cases.csv").write_text("\n".join([",".join(header), *lines]) + "\n")
        return str(folder)

    return write


def run(spark, path, names, **options):
    clean, quarantine = names
    defaults = dict(batch_id="b1", as_of=AS_OF, pepper="k", limit=0.5)
    return ingest_cases(
        spark, path, clean_table=clean, quarantine_table=quarantine, **(defaults | options)
    )


def test_rows_end_up_clean_or_quarantined(spark, landing_folder, fresh_name, ansi):
    names = fresh_name("cases"), fresh_name("rejects")
    done = run(spark, landing_folder(*GOOD, *GOOD[:3], *BAD), names)
    clean, rejects = spark.table(names[0]), spark.table(names[1])
    assert clean.count() == 40, "re-sent rows collapse"
    assert done.metrics["rows_total"] == 46 and done.metrics["rows_quarantined"] == 6
    assert done.metrics["failed_row_well_formed"] == 2
    assert done.metrics["failed_current_balance_readable"] == 1
    reasons = sorted((r["case_reference"] or "", r[FAILURES][0]) for r in rejects.collect())
    assert reasons == [
        ("", "case_reference_present"),
        ("", "case_reference_present"),
        ("N1", "balance_non_negative"),
        ("U1", "current_balance_readable"),
        ("broken", "row_well_formed"),
        ("broken", "row_well_formed"),
    ]
    for table in (clean, rejects):
        assert not forbidden_columns(table.columns)
        assert dict(table.dtypes)["current_balance"] == "decimal(18,2)"
        assert table.where(F.col("national_id_pseudonym").startswith("px_")).count() > 0


def test_a_batch_can_run_again(spark, landing_folder, fresh_name):
    names = fresh_name("cases"), fresh_name("rejects")
    path = landing_folder(*GOOD, *BAD)
    run(spark, path, names)
    run(spark, path, names, batch_id="b2")
    run(spark, path, names, batch_id="b2")
    rejects = spark.table(names[1]).groupBy("_batch_id").count().collect()
    assert {r["_batch_id"]: r["count"] for r in rejects} == {"b1": 6, "b2": 6}
    assert {r[0] for r in spark.table(names[0]).select("_batch_id").distinct().collect()} == {"b2"}


def test_allowed_columns_may_come_and_go(spark, landing_folder, fresh_name):
    names = fresh_name("cases"), fresh_name("rejects")
    run(spark, landing_folder(*GOOD, *BAD[:1]), names)
    extended = [g + ",gold" for g in GOOD]
    run(spark, landing_folder(*extended, header=[*NAMES, "segment_code"]), names, batch_id="b2")
    assert [r[0] for r in spark.table(names[0]).select("segment_code").distinct().collect()] == ["gold"]
    run(spark, landing_folder(*GOOD), names, batch_id="b3")
    assert spark.table(names[0]).where("segment_code IS NOT NULL").isEmpty()


def test_breaker_stops_before_anything_is_published(spark, landing_folder, fresh_name):
    names = fresh_name("cases"), fresh_name("rejects")
    with pytest.raises(ValueError, match="quarantined"):
        run(spark, landing_folder(*GOOD, *BAD), names, limit=0.10)
    assert not any(spark.catalog.tableExists(n) for n in names)
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    assert not list(shared.glob("ingest-*")), "staged rows are removed"


def test_personal_looking_column_stops_the_batch(spark, landing_folder, fresh_name):
    path = landing_folder(*[g + ",x" for g in GOOD], header=[*NAMES, "spouse_email"])
    with pytest.raises(ValueError, match="spouse_email"):
        run(spark, path, (fresh_name("c"), fresh_name("q")))


def test_silver_casts_are_visible(spark, ansi):
    row = dict.fromkeys(NAMES) | {"case_reference": "C", "portfolio_id": "P"}
    row |= {"default_date": "1.1.2024", "current_balance": "7"}
    df = spark.createDataFrame([tuple(row[n] for n in NAMES)], RAW_CASES)
    out = silver_cases(df).first()
    assert out[FAILURES] == ["default_date_readable"]
    assert out["default_date"] is None and str(out["current_balance"]) == "7.00"


def test_training_days_replace_only_themselves(spark, fresh_name):
    paid = spark.createDataFrame(
        [("P1", "C1", date(2024, 1, 10), 5)], "payment_id string, case_reference string, payment_date date, amount int"
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    cases = spark.createDataFrame([("C1",), ("C2",)], "case_reference string")
    table = fresh_name("training")
    publish_training_set(paid, cases, [date(2024, 1, 1), date(2024, 2, 1)], table)
    publish_training_set(paid, cases, [date(2024, 2, 1), date(2024, 3, 1)], table)
    rows = spark.table(table).groupBy("as_of_date").count().collect()
    assert {r["as_of_date"]: r["count"] for r in rows} == {
        date(2024, 1, 1): 2,
        date(2024, 2, 1): 2,
        date(2024, 3, 1): 2,
    }


def test_silver_payments(spark, tmp_path, ansi):
    lines = [
        ",".join(PAYMENTS.fieldNames()),
        "P1,C1,2024-01-01,10.00,CARD",
        "P1,C1,2024-01-02,11.00,CARD",
        "P2,C1,2030-01-01,-1.00,CARD",
        "P3,C1,2024-01-01,lots,CARD",
        "P3,C1,2024-01-01,lots,CARD",
        ",C1,2024-01-01,5.00,CARD",
        ",C1,2024-01-01,5.00,CARD",
        "P4,,1999-01-01,5.00,CARD",
    ]
    (tmp_path / "p.csv").write_text("\n".join(lines) + "\n")
    rows = silver_payments(read_landing(spark, str(tmp_path), PAYMENTS, "b"), AS_OF).collect()
    found = sorted((r["payment_id"] or "", str(r["amount"]), ",".join(r[FAILURES])) for r in rows)
    unreadable = "row_well_formed,amount_not_null,payment_amount_positive"
    assert found == [
        ("", "5.00", "payment_id_not_null"),
        ("", "5.00", "payment_id_not_null"),
        ("P1", "11.00", ""),
        ("P2", "-1.00", "payment_amount_positive,payment_date_not_future"),
        ("P3", "None", unreadable),
        ("P3", "None", unreadable),
        ("P4", "5.00", "case_reference_not_null,payment_date_plausible"),
    ]


def test_the_file_that_arrived_last_wins_whatever_its_name(spark, tmp_path):
    import os


    header = ",".join(PAYMENTS.fieldNames())
    for name, amount, day, arrived in (("p_9", "50.00", "03", 1_000), ("p_10", "10.00", "01", 2_000)):
        file = tmp_path / f"{name}.csv"
        file.write_text(f"{header}\nP1,C1,2024-01-{day},{amount},CARD\n")
        os.utime(file, (arrived, arrived))
    landed = read_landing(spark, str(tmp_path), PAYMENTS, "b1")
    rows = silver_payments(landed, date(2024, 6, 1)).collect()
    assert [str(r["amount"]) for r in rows] == ["10.00"]
    assert "_arrived_at" not in rows[0].asDict()
