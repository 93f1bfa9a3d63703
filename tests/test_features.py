import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from duebook.plans import features

D = Decimal
AS_OF = date(2024, 3, 1)
PAYMENTS = "payment_id string, case_reference string, payment_date date, amount decimal(18,2)"
BEFORE = [
    ("P1", "C1", date(2024, 1, 10), D("100.00")),
    ("P2", "C1", date(2024, 2, 10), D("150.00")),
    ("P3", "C2", date(2023, 12, 1), D("50.00")),
]


@pytest.fixture
def cases(spark):
    return spark.createDataFrame(
        [("C1", "P0"), ("C2", "P0"), ("C3", "P1")], "case_reference string, portfolio_id string"
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, PAYMENTS)


def by_case(df):
    return {r["case_reference"]: r.asDict() for r in df.collect()}


FUTURE = [
    ("P9", "C1", date(2024, 5, 1), D("9999.00")),
    ("P8", "C3", date(2024, 3, 15), D("500.00")),
    ("P7", "C2", AS_OF, D("1.00")),
]


def test_later_payments_change_no_feature(spark, cases):
    before = by_case(features.features_pit(frame(spark, BEFORE), cases, AS_OF))
    after = by_case(features.features_pit(frame(spark, BEFORE + FUTURE), cases, AS_OF))
    assert after == before
    trained = features.training_set(frame(spark, BEFORE + FUTURE), cases, AS_OF)
    assert by_case(trained.drop(features.LABEL)) == before


def test_naive_features_leak(spark, cases):
    before = by_case(features.features_naive(frame(spark, BEFORE), cases, AS_OF))
    after = by_case(features.features_naive(frame(spark, BEFORE + FUTURE), cases, AS_OF))
    assert after != before


def test_feature_values(spark, cases, ansi):
    rows = by_case(features.features_pit(frame(spark, BEFORE), cases, AS_OF))
    assert rows["C1"] == {
        "case_reference": "C1",
        "portfolio_id": "P0",
        "as_of_date": AS_OF,
        "payments_count_lifetime": 2,
        "amount_paid_lifetime": D("250.00"),
        "last_payment_date": date(2024, 2, 10),
        "amount_paid_30d": D("150.00"),
        "amount_paid_90d": D("250.00"),
        "distinct_months_paid": 2,
        "avg_days_between_payments": 31.0,
        "stddev_days_between_payments": None,
        "days_since_last_payment": 20,
        "has_ever_paid": True,
    }
    never = rows["C3"]
    assert never["payments_count_lifetime"] == 0 and never["amount_paid_lifetime"] == 0
    assert never["days_since_last_payment"] is None and never["has_ever_paid"] is False


def test_trailing_windows_include_their_first_day(spark):
    rows = [
        ("P1", "C1", AS_OF - timedelta(days=30), D("1.00")),
        ("P2", "C1", AS_OF - timedelta(days=31), D("2.00")),
        ("P3", "C1", AS_OF - timedelta(days=91), D("4.00")),
        ("P4", "C1", AS_OF, D("8.00")),
    ]
    (row,) = features.trailing_sums(frame(spark, rows), AS_OF).collect()
    assert (row["amount_paid_30d"], row["amount_paid_90d"]) == (D("1.00"), D("3.00"))


@pytest.mark.parametrize(
    "day, label", [(-1, False), (0, True), (89, True), (90, False)]
)
def test_label_window(spark, cases, day, label):
    paid = frame(spark, [("P1", "C1", AS_OF + timedelta(days=day), D("1.00"))])
    for rows in (
        features.forward_label(paid, cases, AS_OF),
        features.training_set(paid, cases, AS_OF),
    ):
        assert by_case(rows)["C1"][features.LABEL] is label
        assert by_case(rows)["C3"][features.LABEL] is False


def test_only_a_positive_sum_counts_as_paid(spark, cases):
    rows = [("P1", "C1", AS_OF, D("5.00")), ("P2", "C1", AS_OF, D("-5.00"))]
    assert by_case(features.forward_label(frame(spark, rows), cases, AS_OF))["C1"][
        features.LABEL
    ] is False


@pytest.fixture
def random_payments(spark):
    rng = random.Random(5)
    rows = [
        (f"P{i:04}", f"C{rng.randrange(12)}", date(2023, 1, 1) + timedelta(days=rng.randrange(60)), D(rng.randrange(1, 99)))
        for i in range(400)
    ]
    return frame(spark, rows)


def reference_gaps(payments):
    ordered = Window.partitionBy("case_reference").orderBy("payment_date", "payment_id")
    return payments.withColumn("prev_payment_date", F.lag("payment_date").over(ordered)).withColumn(
        "gap_days", F.datediff("payment_date", "prev_payment_date")
    )


def test_gaps_equal_a_plain_window(random_payments):
    expected = reference_gaps(random_payments)
    found = features.payment_gaps(random_payments).select(*expected.columns)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_gap_statistics_equal_plain_aggregates(random_payments):
    expected = {
        r["case_reference"]: (r["a"], r["s"])
        for r in reference_gaps(random_payments)
        .groupBy("case_reference")
        .agg(F.avg("gap_days").alias("a"), F.stddev_samp("gap_days").alias("s"))
        .collect()
    }
    for row in features.gap_statistics(random_payments).collect():
        average, deviation = expected[row["case_reference"]]
        assert row["avg_days_between_payments"] == pytest.approx(average)
        assert row["stddev_days_between_payments"] == pytest.approx(deviation)


@pytest.mark.parametrize("days", [[0], [0, 0], [0, 0, 0], [0, 7], [0, 7, 14]])
def test_gap_statistics_of_few_payments(spark, days):
    rows = [(f"P{i}", "C", date(2024, 1, 1) + timedelta(days=d), D(1)) for i, d in enumerate(days)]
    (row,) = features.gap_statistics(frame(spark, rows)).collect()
    gaps = [b - a for a, b in zip(days, days[1:])]
    assert row["avg_days_between_payments"] == (sum(gaps) / len(gaps) if gaps else None)
    assert row["stddev_days_between_payments"] == (0.0 if len(gaps) > 1 else None)


def test_backfill_equals_single_days(spark, random_payments):
    cases = spark.createDataFrame([(f"C{i}",) for i in range(14)], "case_reference string")
    days = [date(2022, 9, 1), date(2022, 12, 31), date(2023, 1, 10), date(2023, 1, 11), date(2023, 2, 1)]
    days += [date(2023, 3, 2), date(2023, 4, 1), date(2023, 5, 30), date(2023, 6, 1), date(2024, 1, 1)]
    found = features.training_set_backfill(random_payments, cases, days)
    expected = [
        r for d in days for r in features.training_set(random_payments, cases, d)
        .select(*found.columns).collect()
    ]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected), key=str)


VERSIONS = [
    ("C1", "old", date(2023, 1, 1), date(2024, 3, 1)),
    ("C1", "new", date(2024, 3, 1), None),
    ("C2", "gone", date(2023, 1, 1), date(2023, 2, 1)),
]


def test_case_versions_do_not_multiply_rows(spark):
    versions = spark.createDataFrame(
        VERSIONS, "case_reference string, stage string, valid_from date, valid_to date"
    )
    paid = frame(spark, BEFORE)
    (row,) = features.training_set(paid, versions, AS_OF).collect()
    assert (row["case_reference"], row["stage"]) == ("C1", "new")
    assert features.forward_label(paid, versions, AS_OF).count() == 1
    both = features.training_set_backfill(paid, versions, [date(2023, 1, 15), AS_OF])
    found = {(r["case_reference"], r["as_of_date"]): r["stage"] for r in both.collect()}
    assert found == {
        ("C1", date(2023, 1, 15)): "old",
        ("C2", date(2023, 1, 15)): "gone",
        ("C1", AS_OF): "new",
    }


def test_changed_rows_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    b = spark.createDataFrame([(1,), (2,), (3,), (None,)], "v int")
    assert {r["v"]: r["copies"] for r in features.changed_rows(a, b).collect()} == {1: -1, 3: 1}
    assert features.changed_rows(a, a).isEmpty()


def test_leakage_check_finds_the_naive_build(spark, cases):
    found = features.leakage_check(frame(spark, BEFORE + FUTURE), cases, AS_OF).collect()
    changes = {r["build"]: (r["rows_added"], r["rows_removed"]) for r in found}
    assert changes == {"point_in_time": (0, 0), "naive": (3, 3)}


def test_date_bound_reaches_the_scan_and_payments_are_read_once(spark, cases, tmp_path):
    frame(spark, BEFORE).write.parquet(str(tmp_path / "p"))
    payments = spark.read.parquet(str(tmp_path / "p"))
    plan = features.training_set(payments, cases, AS_OF)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("FileScan parquet") == 1
    assert "LessThan(payment_date,2024-05-30)" in text
    assert "payment_id" not in text
