"""Checks on published tables. All failures are reported together, one row per check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.operators.privacy import forbidden_columns

MAX_AGE_HOURS = 26


@dataclass(frozen=True)
class TableSpec:
    name: str
    grain: tuple[str, ...]
    money: tuple[str, ...] = ()


def duplicate_keys(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Keys that break the declared grain, with their number of rows."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def _any_negative(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c) < 0 for c in columns])


def negative_money(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows have a negative amount."""
    return df.agg(F.count_if(_any_negative(columns)).alias("rows_negative"))


def _hours_since(moment: Column, now: datetime | None) -> Column:
    """Hours from ``moment`` to ``now``, or to the clock where nobody says what time it is."""
    until = F.current_timestamp() if now is None else F.lit(now)
    return (F.unix_timestamp(until) - F.unix_timestamp(moment)) / 3600


def freshness(
    df: DataFrame, column: str = "_ingested_at", now: datetime | None = None
) -> DataFrame:
    """One row: newest load time and its age in hours; both NULL for a table without the column."""
    latest = F.max(column) if column in df.columns else F.lit(None).cast("timestamp")
    return df.agg(latest.alias("latest"), _hours_since(latest, now).alias("age_hours"))


def not_empty(df: DataFrame) -> bool:
    return not df.isEmpty()


def _finding(check: str, passed: Column, detail: Column) -> Column:
    passed = F.coalesce(passed, F.lit(False))
    return F.struct(
        F.lit(check).alias("check_name"),
        passed.alias("passed"),
        F.when(passed, "").otherwise(detail).alias("detail"),
    )


def _findings(one_row: DataFrame, table: str, findings: Sequence[Column]) -> DataFrame:
    found = one_row.select(F.inline(F.array(*findings)))
    return found.select(F.lit(table).alias("table_name"), "*")


def check_table(
    df: DataFrame,
    spec: TableSpec,
    max_age_hours: int = MAX_AGE_HOURS,
    now: datetime | None = None,
) -> DataFrame:
    """All checks of one table in one pass: a sum per grain key, then one over the keys.

    A check whose columns the table lacks is a failed finding that names them, never a gap in the
    report.
    """
    missing = {
        "grain_unique": [c for c in spec.grain if c not in df.columns],
        "fresh": [c for c in ("_ingested_at",) if c not in df.columns],
        "no_negative_money": [c for c in spec.money if c not in df.columns],
    }
    measures = [F.count(F.lit(1)).alias("rows")]
    totals = [
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count_if(F.col("rows") > 1).alias("doubled"),
    ]
    leaked = forbidden_columns(df.columns)
    doubled = F.concat(F.col("doubled").cast("string"), F.lit(" keys are not unique"))
    findings = [
        _finding("readable", F.lit(True), F.lit("")),
        _finding("not_empty", F.col("rows") > 0, F.lit("no rows")),
        _finding("no_personal_data", F.lit(not leaked), F.lit(", ".join(leaked))),
    ]
    if not missing["grain_unique"]:
        findings.append(_finding("grain_unique", F.col("doubled") == 0, doubled))
    if not missing["fresh"]:
        measures.append(F.max("_ingested_at").alias("latest"))
        totals.append(F.max("latest").alias("latest"))
        hours = _hours_since(F.col("latest"), now)
        known = F.coalesce(F.floor(hours).cast("string"), F.lit("unknown"))
        age = F.concat(F.lit("age in hours: "), known)
        findings.append(_finding("fresh", hours <= max_age_hours, age))
    if spec.money and not missing["no_negative_money"]:
        measures.append(F.count_if(_any_negative(spec.money)).alias("negative"))
        totals.append(F.coalesce(F.sum("negative"), F.lit(0)).alias("negative"))
        count = F.concat(F.col("negative").cast("string"), F.lit(" rows are negative"))
        findings.append(_finding("no_negative_money", F.col("negative") == 0, count))
    findings += [
        _finding(check, F.lit(False), F.lit(f"no column {', '.join(names)}"))
        for check, names in missing.items()
        if names
    ]
    grain = [c for c in spec.grain if c in df.columns]
    per_key = df.groupBy(*grain).agg(*measures)
    return _findings(per_key.agg(*totals), spec.name, findings)


def table_health(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    max_age_hours: int = MAX_AGE_HOURS,
    now: datetime | None = None,
) -> DataFrame:
    """(table_name, check_name, passed, detail) for every check of every table."""
    results = []
    for spec in specs:
        if spark.catalog.tableExists(spec.name):
            results.append(check_table(spark.table(spec.name), spec, max_age_hours, now))
        else:
            absent = _finding("readable", F.lit(False), F.lit("no such table"))
            results.append(_findings(spark.range(1), spec.name, [absent]))
    return reduce(DataFrame.unionByName, results)
