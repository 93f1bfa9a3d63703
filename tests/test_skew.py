from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from duebook.operators import defects, skew


@pytest.fixture(scope="module")
def cases(spark):
    df = defects.generate_cases(spark, 5000, 10).select(
        "case_reference", "portfolio_id", "original_balance"
    )
    return df.withColumn(
        "portfolio_id",
        F.when(F.xxhash64("case_reference") % 50 != 0, F.col("portfolio_id")),
    )


def bag(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_measure_skew(spark):
    df = spark.createDataFrame([(None,)] * 100 + [("A",)] * 5 + [("B",)] * 5, "k string")
    assert [(r["k"], r["rows"]) for r in skew.measure_skew(df, "k", 2).collect()] == [
        (None, 100),
        ("A", 5),
    ]
    assert skew.measure_skew(df, "k").first()["share"] == pytest.approx(100 / 110)


def test_generated_cases_are_skewed(cases):
    top = skew.measure_skew(cases, "portfolio_id").first()
    assert top["portfolio_id"] == defects.HOT_PORTFOLIO and top["share"] > 0.3


@pytest.mark.parametrize("hot", [None, [defects.HOT_PORTFOLIO]])
def test_salted_join_equals_plain_join(spark, cases, hot):
    small = cases.select("portfolio_id").distinct().withColumn("n", F.lit(1))
    plain = cases.join(small, "portfolio_id")
    salted = skew.salted_join(cases, small, "portfolio_id", 7, hot, by=["case_reference"])
    assert bag(salted.select(*plain.columns)) == bag(plain)
    assert salted.where("portfolio_id IS NULL").isEmpty()


def test_only_hot_keys_are_repeated(spark):
    small = spark.createDataFrame([("A",), ("B",)], "k string")
    counts = skew.explode_salt(small, 4, "k", ["A"]).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in counts} == {"A": 4, "B": 1}
    assert skew.explode_salt(small, 4).count() == 8


def test_salt_spreads_different_rows_and_identical_copies(spark):
    rows = spark.range(4000).select(F.lit("hot").alias("k"), "id")
    copies = spark.range(0, 4000, 1, 40).select(F.lit("hot").alias("k"))
    for df in (rows, copies):
        salts = skew.add_salt(df, 8).groupBy("_salt").count().collect()
        assert len(salts) == 8 and max(r["count"] for r in salts) < 1000


def test_salt_is_the_same_in_every_run(spark):
    df = spark.range(500)
    assert bag(skew.add_salt(df, 8)) == bag(skew.add_salt(df, 8))


def test_two_stage_aggregate_equals_plain(cases):
    two = skew.aggregate_skewed(cases, "portfolio_id", "original_balance", 7)
    plain = cases.groupBy("portfolio_id").agg(
        F.sum("original_balance").alias("s"),
        F.count("original_balance").alias("n"),
        F.min("original_balance").alias("lo"),
        F.max("original_balance").alias("hi"),
    )
    assert bag(two.drop("original_balance_avg")) == bag(plain)


def test_average_of_nothing_is_null(spark, ansi):
    df = spark.createDataFrame([("a", None), ("b", Decimal(2))], "k string, v decimal(18,2)")
    rows = {r["k"]: r["v_avg"] for r in skew.aggregate_skewed(df, "k", "v").collect()}
    assert rows["a"] is None and rows["b"] == 2


def test_hot_keys_are_whole_and_exact(spark):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, "warm")
        .when(F.col("id") % 97 == 2, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("k")
    )
    exact = {r.k: r["count"] for r in rows.where("k IS NOT NULL").groupBy("k").count().collect()}
    total = sum(exact.values())
    for share in (0.01, 0.3, 0.5):
        found = skew.hot_keys(rows, "k", share).collect()
        assert {r.k: r.rows for r in found} == {k: n for k, n in exact.items() if n >= share * total}
        assert all(r.share == pytest.approx(r.rows / total) for r in found)
    assert skew.hot_keys(rows.limit(0), "k", 0.1).isEmpty()
    with pytest.raises(ValueError):
        skew.hot_keys(rows, "k", 0.0001)


def test_salted_join_finds_its_hot_keys(spark, cases):
    small = cases.select("portfolio_id").distinct().withColumn("n", F.lit(1))
    plain = cases.join(small, "portfolio_id")
    salted = skew.salted_join(cases, small, "portfolio_id", 7, by=["case_reference"], least_share=0.2)
    assert bag(salted.select(*plain.columns)) == bag(plain)
    text = salted._jdf.queryExecution().optimizedPlan().toString()
    assert defects.HOT_PORTFOLIO in text
    none = skew.salted_join(cases, small, "portfolio_id", least_share=0.9)
    assert bag(none.select(*plain.columns)) == bag(plain)
    assert "_salt" not in none._jdf.queryExecution().optimizedPlan().toString()
