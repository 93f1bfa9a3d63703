"""The shape of the physical plans: shuffles, pushdown, pruning."""

import os
from datetime import date

import pytest

from duebook import fixtures as fx
from duebook.operators.quality import (
    case_rules,
    flag_failures,
    payment_rules,
    rule_metrics,
    split,
)
from duebook.plans import facts, features
from duebook.sources.storage import write_bucketed

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
AS_OF = date(1999, 1, 1)


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Deduplicated tables on disk, as the pipelines find them."""
    folder = tmp_path_factory.mktemp("silver")
    frames = {
        "payments": fx.payments(spark, SF_DIR),
        "cases": fx.cases(spark, SF_DIR),
        "contracts": fx.contracts(spark, SF_DIR),
        "portfolios": fx.portfolios(spark, SF_DIR),
        "curve": fx.forecast_curve(spark, SF_DIR),
    }
    for name, df in frames.items():
        df.write.parquet(str(folder / name))
    return {name: spark.read.parquet(str(folder / name)) for name in frames}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.mark.parametrize("price_on", ["month_start", "payment_date"])
def test_servicing_shuffles_payments_twice_and_cases_once(silver, price_on):
    out = facts.servicing_performance(
        silver["payments"], silver["cases"], silver["contracts"], price_on
    )
    assert shuffles(out) == 3
    assert "payment_id" not in plan(out) and "original_balance" not in plan(out)


def test_training_set_reads_payments_once(silver):
    cases = silver["cases"].select("case_reference", "portfolio_id")
    for out in (
        features.training_set(silver["payments"], cases, AS_OF),
        features.training_set_backfill(silver["payments"], cases, [date(1998, 1, 1), AS_OF]),
    ):
        text = plan(out)
        assert text.count("FileScan") == 2
        assert shuffles(out) == 3
        assert "LessThan(payment_date,1999-04-01)" in text


def test_feature_bound_is_pushed_to_the_scan(silver):
    text = plan(features.features_pit(silver["payments"], silver["cases"], AS_OF))
    assert "LessThan(payment_date,1999-01-01)" in text


def test_label_bounds_are_pushed_to_the_scan(silver):
    text = plan(features.forward_label(silver["payments"], silver["cases"], AS_OF))
    assert "GreaterThanOrEqual(payment_date,1999-01-01), LessThan(payment_date," in text


def test_gap_statistics_window_sees_days_not_payments(silver):
    text = plan(features.gap_statistics(silver["payments"]))
    window = text.index("Window [lag")
    first_exchange = text.rindex("Exchange hashpartitioning(case_reference")
    assert window < first_exchange and "partial_count(1)" in text[first_exchange:]


def test_rules_take_one_pass(silver, spark, sf_dir):
    debtors = fx.debtors(spark, sf_dir)
    people = silver["cases"].join(debtors, "debtor_key")
    metrics = rule_metrics(people, case_rules(AS_OF))
    assert plan(metrics).count("FileScan") == 2
    clean, _ = split(flag_failures(people, case_rules(AS_OF)))
    assert shuffles(clean) == 0


def test_filter_on_the_verdict_does_not_build_the_list_of_names(silver):
    rejected = split(flag_failures(silver["payments"], payment_rules(AS_OF)))[1]
    text = plan(rejected.select("payment_id"))
    assert "array" not in text


def test_investing_windows_run_on_months(silver):
    out = facts.investing_performance(
        silver["payments"], silver["cases"], silver["portfolios"], silver["curve"]
    )
    text = plan(out)
    assert text.index("Window [sum") < text.index("partial_sum")
    assert "BuildLeft" not in text


@pytest.fixture(scope="module")
def bucketed(spark, silver):
    for name, sort_by in (("payments", ["payment_date"]), ("cases", [])):
        assert write_bucketed(silver[name], f"bucketed_{name}", "case_reference", 8, sort_by)
    return {name: spark.table(f"bucketed_{name}") for name in ("payments", "cases")}


def test_buckets_save_every_shuffle_by_case(silver, bucketed):
    cases = bucketed["cases"].select("case_reference", "portfolio_id")
    for out in (
        features.features_pit(bucketed["payments"], cases, AS_OF),
        features.training_set(bucketed["payments"], cases, AS_OF),
        features.training_set_backfill(bucketed["payments"], cases, [date(1998, 1, 1), AS_OF]),
        features.gap_statistics(bucketed["payments"]),
        facts.collections_by_case_month(bucketed["payments"]),
        facts.servicing_performance(bucketed["payments"], bucketed["cases"], silver["contracts"]),
    ):
        assert shuffles(out) == 0
        assert "Bucketed: true" in plan(out)
