from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from duebook.operators import health


@pytest.fixture
def publish(spark, fresh_name):
    def write(rows, age_hours=1, extra="", columns="k string, amount decimal(18,2)"):
        loaded = datetime.now() - timedelta(hours=age_hours)
        table = fresh_name("gold")
        schema = f"{columns}, _ingested_at timestamp"
        spark.createDataFrame([(*r, loaded) for r in rows], schema).write.saveAsTable(table)
        return table

    return write


def findings(spark, table):
    spec = health.TableSpec(table, ("k",), ("amount",))
    return {
        r["check_name"]: (r["passed"], r["detail"])
        for r in health.table_health(spark, [spec]).collect()
    }


def test_healthy_table(spark, publish):
    found = findings(spark, publish([("a", Decimal(1)), ("b", Decimal(0))]))
    assert len(found) == 6 and all(value == (True, "") for value in found.values())


def test_every_failure_is_reported_at_once(spark, publish):
    table = publish([("a", Decimal(-1)), ("a", Decimal(1))], age_hours=30)
    found = findings(spark, table)
    assert found["grain_unique"] == (False, "1 keys are not unique")
    assert found["no_negative_money"] == (False, "1 rows are negative")
    assert found["fresh"] == (False, "age in hours: 30")
    assert found["not_empty"][0] and found["readable"][0]


def test_empty_and_absent_tables(spark, publish):
    found = findings(spark, publish([]))
    assert found["not_empty"] == (False, "no rows")
    assert found["fresh"] == (False, "age in hours: unknown")
    assert findings(spark, "no_such_table") == {"readable": (False, "no such table")}


def test_personal_data_is_found(spark, publish):
    table = publish([("a", Decimal(1), "x")], columns="k string, amount decimal(18,2), debtor_name string")
    assert findings(spark, table)["no_personal_data"] == (False, "debtor_name")


def test_one_scan_per_table(spark, publish):
    spec = health.TableSpec(publish([("a", Decimal(1))]), ("k",), ("amount",))
    plan = health.table_health(spark, [spec])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_absent_columns_are_failed_findings(spark):
    df = spark.createDataFrame([(1, 2.0)], "k int, m double")
    spec = health.TableSpec("t", ("k", "gone"), ("m", "lost"))
    found = {r["check_name"]: (r["passed"], r["detail"]) for r in health.check_table(df, spec).collect()}
    assert found["fresh"] == (False, "no column _ingested_at")
    assert found["grain_unique"] == (False, "no column gone")
    assert found["no_negative_money"] == (False, "no column lost")
    assert found["not_empty"] == (True, "")


def test_age_is_measured_from_the_given_time(spark):
    df = spark.sql("SELECT 1 AS k, TIMESTAMP'2024-01-01 00:00:00' AS _ingested_at")
    for hour, fresh in ((20, True), (27, False)):
        now = datetime(2024, 1, 1 + hour // 24, hour % 24)
        rows = health.check_table(df, health.TableSpec("t", ("k",)), now=now).collect()
        assert {r["check_name"]: r["passed"] for r in rows}["fresh"] == fresh
