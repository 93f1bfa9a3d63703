from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Row

from duebook.contracts import (
    INVESTING_FACT,
    SERVICING_FACT,
    SILVER_CASES,
    conform,
)
from duebook.operators.joins import as_of_slice, broadcast_if_small, join_valid_version, join_version_by_month
from duebook.operators.quality import FAILURES, split
from duebook.plans import facts

D = Decimal
PAYMENTS = "payment_id string, case_reference string, payment_date date, amount decimal(18,2)"


def payments_frame(spark, rows):
    rows = [(f"P{i}", case, day, D(amount)) for i, (case, day, amount) in enumerate(rows)]
    return spark.createDataFrame(rows, PAYMENTS)


@pytest.fixture
def portfolio(spark):
    return spark.createDataFrame(
        [("PF", date(2023, 1, 20), D("200.00"), D("1000.00"))],
        "portfolio_id string, purchase_date date, purchase_price decimal(18,2), "
        "gross_face_value decimal(18,2)",
    )


def investing(spark, portfolio, payments, curve=(("PF", 0, "0.050000"), ("PF", 1, "0.100000"))):
    cases = spark.createDataFrame(
        [("C1", "PF"), ("C2", "PF"), ("C3", "OTHER")], "case_reference string, portfolio_id string"
    )
    curve = spark.createDataFrame(
        [(p, m, D(pct)) for p, m, pct in curve],
        "portfolio_id string, months_on_book int, forecast_pct decimal(9,6)",
    )
    fact = facts.investing_performance(payments_frame(spark, payments), cases, portfolio, curve)
    out = conform(fact, INVESTING_FACT, "b1")
    return {row["as_of_month"]: row for row in out.collect()}


def test_investing_measures(spark, portfolio, ansi):
    rows = investing(
        spark,
        portfolio,
        [
            ("C1", date(2023, 1, 5), "10.00"),
            ("C2", date(2023, 1, 31), "30.00"),
            ("C1", date(2023, 2, 1), "80.00"),
            ("C1", date(2023, 4, 1), "5.00"),
        ],
    )
    january, february, april = (rows[date(2023, m, 1)] for m in (1, 2, 4))
    assert [r["months_on_book"] for r in (january, february, april)] == [0, 1, 3]
    assert january["collections_forecast"] == D("50.00") and january["erc_remaining"] == D("10.00")
    assert february["collections_actual"] == D("80.00")
    assert february["recovery_rate_to_date"] == D("0.120000")
    assert february["money_multiple"] == D("0.600000")
    assert february["erc_remaining"] == D("0.00"), "over-collection is floored at zero"
    assert april["collections_forecast"] is None and april["erc_remaining"] == D("0.00")


def test_months_before_purchase_and_unknown_portfolios_are_left_out(spark, portfolio):
    payments = [
        ("C1", date(2022, 12, 31), "10.00"),
        ("C1", date(2023, 6, 1), "10.00"),
        ("C3", date(2023, 6, 1), "7.00"),
    ]
    rows = investing(spark, portfolio, payments)
    assert list(rows) == [date(2023, 6, 1)]
    assert rows[date(2023, 6, 1)]["months_on_book"] == 5
    assert rows[date(2023, 6, 1)]["recovery_rate_to_date"] == D("0.010000")


def test_unmatched_portfolios_are_reported(spark, portfolio):
    monthly = spark.createDataFrame(
        [("PF", date(2023, 6, 1), D("1.00")), ("OTHER", date(2023, 6, 1), D("7.00"))],
        "portfolio_id string, as_of_month date, collections_actual decimal(18,2)",
    )
    assert [tuple(r) for r in facts.unmatched_portfolios(monthly, portfolio).collect()] == [
        ("OTHER", 1, D("7.00"))
    ]


def test_measures_too_large_for_their_types_are_rejected_by_name(spark, portfolio, ansi):
    rows = investing(spark, portfolio, [("C1", date(2023, 1, 1), "9999999.00")])
    row = rows[date(2023, 1, 1)]
    assert row["recovery_rate_to_date"] is None and row["_dq_has_error"]
    assert row[FAILURES] == ["recovery_rate_to_date_fits_type", "money_multiple_fits_type"]


def test_a_huge_outstanding_amount_is_not_a_finished_portfolio(spark, ansi):
    schema = (
        "portfolio_id string, purchase_date date, purchase_price decimal(18,2), "
        "gross_face_value decimal(18,2)"
    )
    huge = [("PF", date(2023, 1, 20), D("1.00"), D("9000000000000000.00"))]
    curve = [("PF", 0, "2.000000")]
    rows = investing(spark, spark.createDataFrame(huge, schema), [("C1", date(2023, 1, 1), "5000.00")], curve)
    row = rows[date(2023, 1, 1)]
    assert row["erc_remaining"] is None and row["_dq_has_error"]
    assert set(row[FAILURES]) == {
        "collections_forecast_fits_type", "erc_remaining_fits_type", "money_multiple_fits_type",
    }


CONTRACTS = "client_id string, commission_rate decimal(9,6), sla_target_days int, valid_from date, valid_to date"


@pytest.fixture
def contracts(spark):
    return spark.createDataFrame(
        [
            ("A", D("0.150000"), 30, date(2020, 1, 1), date(2024, 6, 10)),
            ("A", D("0.100000"), 20, date(2024, 6, 10), None),
            ("N", D("0.100000"), None, date(2020, 1, 1), None),
        ],
        CONTRACTS,
    )


def servicing(spark, contracts, payments, placements, **options):
    placed = spark.createDataFrame(
        placements,
        "case_reference string, client_id string, placed_date date, first_contact_date date",
    )
    out = facts.servicing_performance(payments_frame(spark, payments), placed, contracts, **options)
    return sorted(out.collect(), key=lambda r: (r["as_of_month"], r["commission_rate"] or 0))


PLACED = [("C1", "A", date(2023, 1, 1), date(2023, 1, 20))]
MIXED = [
    ("C1", date(2023, 6, 15), "1000.00"),
    ("C1", date(2024, 6, 9), "600.00"),
    ("C1", date(2024, 6, 10), "400.00"),
    ("C1", date(2024, 7, 1), "1000.00"),
]


def test_commission_at_month_start(spark, contracts, ansi):
    rows = servicing(spark, contracts, MIXED, PLACED)
    assert [(r["as_of_month"].month, r["commission_earned"]) for r in rows] == [
        (6, D("150.00")),
        (6, D("150.00")),
        (7, D("100.00")),
    ]


def test_commission_at_payment_date(spark, contracts):
    rows = servicing(spark, contracts, MIXED, PLACED, price_on="payment_date")
    june = [r for r in rows if r["as_of_month"] == date(2024, 6, 1)]
    assert [(r["collections_actual"], r["commission_earned"]) for r in june] == [
        (D("400.00"), D("40.00")),
        (D("600.00"), D("90.00")),
    ]


@pytest.mark.parametrize(
    "client, contact, status",
    [
        ("A", date(2023, 1, 31), "MET"),
        ("A", date(2023, 2, 1), "BREACHED"),
        ("A", None, "PENDING"),
        ("N", date(2023, 1, 2), "BREACHED"),
        ("UNKNOWN", None, "PENDING"),
    ],
)
def test_sla_status(spark, contracts, client, contact, status):
    placed = [("C1", client, date(2023, 1, 1), contact)]
    (row,) = servicing(spark, contracts, [("C1", date(2023, 3, 1), "1.00")], placed)
    assert row["sla_met"] == status


def test_payment_without_contract_is_quarantined_by_the_contract(spark, contracts):
    placed = [("C1", "UNKNOWN", date(2023, 1, 1), None), ("C2", "A", date(2023, 1, 1), None)]
    frame = spark.createDataFrame(
        placed, "case_reference string, client_id string, placed_date date, first_contact_date date"
    )
    paid = payments_frame(
        spark, [("C1", date(2023, 3, 1), "1.00"), ("C2", date(2023, 3, 1), "1.00")]
    )
    fact = facts.servicing_performance(paid, frame, contracts)
    clean, rejected = split(conform(fact, SERVICING_FACT, "b"))
    assert clean.drop(FAILURES).columns == SERVICING_FACT.fieldNames()
    assert [f.dataType for f in clean.drop(FAILURES).schema] == [f.dataType for f in SERVICING_FACT]
    assert [r["case_reference"] for r in clean.collect()] == ["C2"]
    (bad,) = rejected.collect()
    assert bad[FAILURES] == ["commission_rate_not_null", "commission_earned_not_null"]


def test_conform_flags_values_that_do_not_fit(spark, ansi):
    names = SILVER_CASES.fieldNames()
    row = dict.fromkeys(names)
    row |= {"case_reference": "C1", "portfolio_id": "P", "current_balance": "1e30", "default_date": "x"}
    df = spark.createDataFrame([tuple(row[n] for n in names)], ", ".join(f"{n} string" for n in names))
    out = conform(df, SILVER_CASES, "b").first()
    assert out[FAILURES] == ["current_balance_fits_type", "default_date_fits_type"]
    assert out["current_balance"] is None


def test_conform_refuses_missing_columns(spark):
    with pytest.raises(ValueError, match="client_id"):
        conform(spark.range(1), SERVICING_FACT, "b")


def test_facts_share_only_collections():
    audit = {"_ingested_at", "_batch_id"}
    shared = set(INVESTING_FACT.fieldNames()) & set(SERVICING_FACT.fieldNames()) - audit
    assert shared == {"as_of_month", "collections_actual"}
    assert "purchase_price" not in SERVICING_FACT.fieldNames()
    assert "client_id" not in INVESTING_FACT.fieldNames()


def test_validity_is_half_open(spark, contracts):
    assert [r["commission_rate"] for r in as_of_slice(contracts, date(2024, 6, 10)).collect()] == [
        D("0.100000"),
        D("0.100000"),
    ]
    plain = spark.range(3)
    assert as_of_slice(plain, date(2024, 1, 1)) is plain


def test_valid_version_join_never_multiplies(spark, contracts):
    days = spark.createDataFrame(
        [("A", date(2019, 1, 1)), ("A", date(2024, 6, 9)), ("A", date(2024, 6, 10)), (None, None)],
        "client_id string, day date",
    )
    out = join_valid_version(days, contracts, "client_id", "day")
    assert sorted(str(r["commission_rate"]) for r in out.collect()) == [
        "0.100000", "0.150000", "None", "None",
    ]


def test_large_version_tables_are_merged_with_the_same_result(spark, contracts):
    days = spark.createDataFrame(
        [("A", date(2024, 6, 9), 1), ("A", date(2024, 6, 10), 2), ("B", date(2024, 6, 10), 3)],
        "client_id string, day date, n int",
    )
    small = join_valid_version(days, contracts, "client_id", "day")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = join_valid_version(days, contracts, "client_id", "day", broadcast_max_rows=0)
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan
        assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_client_with_many_versions_is_joined_by_month(spark):
    first = date(2000, 1, 1)
    rows = [("A", i, first + timedelta(days=i), first + timedelta(days=i + 1)) for i in range(10_000)]
    rows += [
        ("B", -1, date(1990, 1, 1), None), ("B", -2, None, date(2030, 1, 1)),
        ("B", -3, date(2010, 1, 1), date(2010, 1, 1)), (None, -4, date(1990, 1, 1), None),
    ]
    versions = spark.createDataFrame(rows, "client_id string, v int, valid_from date, valid_to date")
    wanted = {
        ("A", first): 0, ("A", first + timedelta(days=9_999)): 9_999, ("A", first + timedelta(days=10_000)): None,
        ("A", date(1999, 12, 31)): None, ("A", date(2010, 2, 28)): 3_711, ("B", date(2010, 1, 1)): -1,
        ("B", date(2040, 1, 1)): -1, ("C", first): None, (None, first): None, ("A", None): None,
    }
    days = spark.createDataFrame(list(wanted) * 3, "client_id string, day date")
    for span in (None, (date(1999, 1, 1), date(2040, 12, 31))):
        out = join_version_by_month(days, versions, "client_id", "day", span)
        assert out.columns == ["client_id", "day", "v"]
        expected = [str(Row(client_id=c, day=d, v=v)) for (c, d), v in wanted.items()] * 3
        assert sorted(map(str, out.collect())) == sorted(expected)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "SortMergeJoin [client_id" in plan and "_month" in plan
    assert join_version_by_month(days.where("false"), versions, "client_id", "day").isEmpty()
    assert join_version_by_month(days, versions.where("false"), "client_id", "day").count() == 30


def test_broadcast_only_below_the_bound(spark):
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(broadcast_if_small(spark.range(10), max_rows=10))
    assert "broadcast" not in plan(broadcast_if_small(spark.range(11), max_rows=10))


def test_fact_joins_never_broadcast_a_fact(spark, contracts):
    placed = spark.createDataFrame(
        PLACED, "case_reference string, client_id string, placed_date date, first_contact_date date"
    )
    out = facts.servicing_performance(payments_frame(spark, MIXED), placed, contracts)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [case_reference" in plan
    assert plan.count("BroadcastHashJoin") == 1
