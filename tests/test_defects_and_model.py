from datetime import date

import pytest
from pyspark.sql import functions as F

from duebook.operators import defects
from duebook.operators.quality import case_rules, rule_metrics
from duebook.plans import features, model


@pytest.fixture(scope="module")
def cases(spark):
    return defects.generate_cases(spark, 20_000)


def test_defects_have_the_asked_shares(cases):
    total = cases.count()
    assert 20_000 * 1.02 < total < 20_000 * 1.04

    def share(condition):
        return cases.where(condition).count() / total

    assert share(f"portfolio_id = '{defects.HOT_PORTFOLIO}'") == pytest.approx(0.4, abs=0.02)
    assert share("national_id IS NULL") == pytest.approx(0.05, abs=0.01)
    assert share("debtor_email IS NULL") == pytest.approx(0.10, abs=0.01)
    assert share("current_balance > 10 * original_balance") == pytest.approx(0.01, abs=0.005)
    assert share("default_date = DATE'1970-01-01'") == pytest.approx(0.005, abs=0.003)
    assert share("currency = 'XXX'") == pytest.approx(0.002, abs=0.002)


def test_copies_are_exact_or_near(cases):
    versions = cases.groupBy("case_reference").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("current_balance").alias("balances")
    )
    assert versions.where("n > 1 AND balances = 1").count() > 200
    assert versions.where("balances > 1").count() > 100


def test_generation_does_not_depend_on_partitions(spark, cases):
    again = defects.generate_cases(spark, 20_000).repartition(3)
    assert cases.exceptAll(again).isEmpty() and again.exceptAll(cases).isEmpty()


def test_rules_find_the_defects(cases):
    rules = case_rules(date(2024, 6, 30))
    row = rule_metrics(cases, rules).first()
    assert row["failed_balance_not_above_original"] > 100
    assert row["failed_currency_supported"] > 10


def test_money_stays_decimal(cases):
    kinds = dict(cases.dtypes)
    assert kinds["original_balance"] == kinds["current_balance"] == "decimal(18,2)"


def test_payments(cases):
    payments = defects.generate_payments(cases.dropDuplicates(["case_reference"]))
    row = (
        payments.join(cases.dropDuplicates(["case_reference"]), "case_reference")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("payment_id").alias("ids"),
            F.min("amount").alias("least"),
            F.max("amount").alias("most"),
            F.countDistinct("channel").alias("channels"),
            F.count_if(F.col("payment_date") < F.col("default_date")).alias("backdated"),
        )
        .first()
    )
    assert row["n"] == row["ids"] and row["n"] / 20_000 == pytest.approx(3.5, abs=0.1)
    assert row["least"] >= 10 and row["most"] < 810 and row["channels"] == 3
    assert row["backdated"] / row["n"] == pytest.approx(0.03, abs=0.005)


@pytest.fixture(scope="module")
def training(spark):
    base = defects.generate_cases(spark, 1500, copy_rate=0, near_copy_rate=0)
    rows = features.training_set_backfill(
        defects.generate_payments(base),
        base.select("case_reference"),
        [date(2022, 1, 1), date(2023, 1, 1)],
    )
    from duebook.sources.storage import stage

    return stage(rows, "training", ["as_of_date"])


def test_temporal_split_is_exact(training):
    train, test = model.temporal_split(training, date(2023, 1, 1))
    assert {r[0] for r in train.select("as_of_date").distinct().collect()} == {date(2022, 1, 1)}
    assert {r[0] for r in test.select("as_of_date").distinct().collect()} == {date(2023, 1, 1)}


def test_model_trains_and_is_gated(training):
    fitted = model.train_propensity(training, date(2023, 1, 1), rounds=3)
    assert 0.5 < fitted.auc <= 1.0
    assert fitted.train_rows == fitted.test_rows == 1500
    assert fitted.looks_leaky == (fitted.auc > 0.95)


def test_gate_trips_on_a_leak(training):
    leaky = training.withColumn(
        "days_since_last_payment", F.col(features.LABEL).cast("int") * 100
    )
    assert model.train_propensity(leaky, date(2023, 1, 1), rounds=1).looks_leaky
