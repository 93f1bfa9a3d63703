from datetime import date

import pytest
from pyspark.sql import functions as F

from duebook.operators.quality import (
    ERROR,
    FAILURES,
    WARN,
    Rule,
    apply_rules,
    case_rules,
    check_error_rate,
    dedupe_latest,
    flag_failures,
    payment_rules,
    recorded_metrics,
)

AS_OF = date(2024, 6, 30)
CASES = (
    "case_reference string, current_balance decimal(18,2), original_balance decimal(18,2), "
    "currency string, default_date date, national_id string, debtor_email string, "
    "debtor_phone string"
)


@pytest.fixture
def cases(spark):
    rows = [
        ("ok", "80.00", "100.00", "PLN", date(2023, 1, 1), "1", "a@b.invalid", "123456"),
        ("unreachable", "80.00", "100.00", "EUR", date(2023, 1, 1), None, None, None),
        ("negative", "-1.00", "100.00", "SEK", date(2023, 1, 1), "1", None, None),
        ("odd", "80.00", "100.00", "XXX", date(2025, 1, 1), "1", None, None),
        ("unit", "300.01", "100.00", "GBP", AS_OF, "1", None, None),
        ("  ", None, None, None, None, None, None, None),
    ]
    text = spark.createDataFrame(rows, CASES.replace("decimal(18,2)", "string"))
    money = {c: F.col(c).cast("decimal(18,2)") for c in ("current_balance", "original_balance")}
    return text.withColumns(money)


def failures(df):
    return {row["case_reference"]: row[FAILURES] for row in df.collect()}


def test_case_rules(cases):
    assert failures(flag_failures(cases, case_rules(AS_OF))) == {
        "ok": [],
        "unreachable": ["national_id_or_contact_present"],
        "negative": ["balance_non_negative"],
        "odd": ["currency_supported", "default_date_not_future"],
        "unit": ["balance_not_above_original"],
        "  ": [rule.name for rule in case_rules(AS_OF)],
    }


def test_warnings_stay_clean_and_parts_cover_the_input(cases):
    clean, rejected, metrics = apply_rules(cases, case_rules(AS_OF))
    assert set(failures(clean)) == {"ok", "unreachable", "unit"}
    assert set(failures(rejected)) == {"negative", "odd", "  "}
    row = metrics.first()
    assert row["rows_total"] == 6 and row["rows_quarantined"] == 3
    assert row["failed_national_id_or_contact_present"] == 2
    assert row["failed_case_reference_present"] == 1
    recorded = recorded_metrics(flag_failures(cases, case_rules(AS_OF)), case_rules(AS_OF))
    assert recorded.first() == row


def test_null_condition_fails(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    clean, rejected, _ = apply_rules(df, [Rule("positive", "v > 0")])
    assert [r["k"] for r in clean.collect()] == ["a"]
    assert [r["k"] for r in rejected.collect()] == ["b"]


def test_only_warnings_never_quarantine(spark):
    df = spark.createDataFrame([(-1,)], "v int")
    clean, rejected, _ = apply_rules(df, [Rule("positive", "v > 0", WARN)])
    assert clean.count() == 1 and rejected.isEmpty()


def test_no_rules(spark):
    df = spark.createDataFrame([(1,)], "v int")
    clean, rejected, metrics = apply_rules(df, [])
    assert clean.collect() == df.collect()
    assert rejected.isEmpty() and dict(rejected.dtypes)[FAILURES] == "array<string>"
    assert metrics.first()["rows_total"] == 1


def test_payment_rules(spark):
    rows = [(10, date(2024, 1, 1)), (0, date(2024, 1, 1)), (5, date(2025, 1, 1)), (5, date(1970, 1, 1))]
    df = spark.createDataFrame(rows, "amount int, payment_date date")
    found = [r[FAILURES] for r in flag_failures(df, payment_rules(AS_OF)).collect()]
    assert found == [
        [],
        ["payment_amount_positive"],
        ["payment_date_not_future"],
        ["payment_date_plausible"],
    ]
    assert [r.severity for r in payment_rules(AS_OF)] == [ERROR, ERROR, WARN]


def test_circuit_breaker():
    check_error_rate({"rows_total": 10, "rows_quarantined": 1}, 0.10)
    with pytest.raises(ValueError, match="20.00%"):
        check_error_rate({"rows_total": 10, "rows_quarantined": 2}, 0.10)
    with pytest.raises(ValueError, match="empty"):
        check_error_rate({"rows_total": 0, "rows_quarantined": 0}, 0.10)


VERSIONS = [("a", 1, date(2024, 1, 1)), ("a", 2, date(2024, 2, 1)), ("a", 3, date(2024, 1, 15))]


def test_dedupe_keeps_latest_and_collapses_copies(spark):
    df = spark.createDataFrame(VERSIONS * 3, "k string, v int, at date")
    assert [r["v"] for r in dedupe_latest(df, ["k"], ["at"]).collect()] == [2]


def test_dedupe_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    kept = {r["k"]: r["v"] for r in dedupe_latest(df, ["k"], ["v"]).collect()}
    assert kept == {None: 2, "a": 3}


def test_dedupe_ties_do_not_depend_on_arrival(spark):
    rows = [(f"k{i % 7}", i, date(2024, 1, 1)) for i in range(200)]
    results = []
    for order, parts in ((rows, 1), (rows[::-1], 5), (sorted(rows), 3)):
        df = spark.createDataFrame(order, "k string, v int, at date").repartition(parts)
        results.append(sorted(map(tuple, dedupe_latest(df, ["k"], ["at"]).collect())))
    assert results[0] == results[1] == results[2] and len(results[0]) == 7


def test_dedupe_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id < 900, 'hot', string(id)) AS k", "id AS v")
    plan = dedupe_latest(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("row_number(), 1, Final"), plan.index("row_number(), 1, Partial")
    assert final < plan.index("Exchange hashpartitioning") < partial
