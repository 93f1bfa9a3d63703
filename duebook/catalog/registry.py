"""Registration of queries, and the dates and secrets they share."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook import fixtures as fx
from duebook.contracts import MONEY
from duebook.session import bound_tasks
from duebook.sources.storage import buckets_for, shared_folder, write_bucketed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ANSWERS: dict[str, str] = {}

FEATURES_AS_OF = date(1999, 1, 1)
RULES_AS_OF = date(2002, 1, 1)
BACKFILL_DATES = (date(1997, 1, 1), date(1998, 1, 1), date(1999, 1, 1), date(2000, 1, 1))
PEPPER = "test-only-pepper"


def query(answer: str | None = None, name: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` function under its name."""

    def register(function):
        key = name or function.__name__

        @wraps(function)
        def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
            bound_tasks(spark, sf_dir)
            return function(spark, sf_dir)

        QUERIES[key] = sized
        if answer is not None:
            ANSWERS[key] = answer
        return function

    return register


def money(df: DataFrame, *names: str) -> DataFrame:
    """Sums come out wider than the contract; bring them back to it."""
    return df.withColumns({n: F.col(n).try_cast(MONEY) for n in names})


def bucketed_silver(spark: SparkSession, sf_dir: str, least: int = 8) -> dict[str, DataFrame]:
    """Payments and cases as silver tables in buckets of a case, as many as the payments need."""
    folder = shared_folder(spark, "buckets")
    buckets = buckets_for(fx.payments_raw(spark, sf_dir), least)
    suffix = folder.rsplit("-", 1)[1]
    frames = {
        "payments": (fx.payments(spark, sf_dir), ["payment_date"]),
        "cases": (fx.cases(spark, sf_dir), []),
    }
    tables = {}
    for name, (df, sort_by) in frames.items():
        table, path = f"{name}_{suffix}", f"{folder}/{name}"
        write_bucketed(df, table, "case_reference", buckets, sort_by, path)
        tables[name] = spark.table(table)
    return tables
