"""Publishing: facts against their contract, rejects to quarantine, training sets by day."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duebook.contracts import conform
from duebook.operators.quality import FAILURES
from duebook.plans.features import training_set_backfill
from duebook.sources.storage import replace_partitions, staged
from duebook.sources.versions import Version, drop_version, switch_to, write_version


def below(folder: str | None, name: str) -> str | None:
    """Where a table of that name stands, if tables have a folder."""
    return f"{folder.rstrip('/')}/{name}" if folder else None


def publish_judged(
    rows: DataFrame,
    batch_id: str,
    table: str,
    quarantine_table: str,
    hidden: tuple[str, ...] = (),
    folder: str | None = None,
    check: Callable[[Version], None] | None = None,
) -> None:
    """Write a judged batch once, check it, and publish both parts by one switch.

    If the check raises, the written version is dropped and everything stays as it was.
    """
    spark = rows.sparkSession
    version = write_version(rows, table, batch_id, folder)
    try:
        if check:
            check(version)
    except Exception:
        drop_version(spark, version)
        raise
    switch_to(spark, version, table, quarantine_table, hidden, folder)


def publish_fact(
    fact: DataFrame,
    contract: StructType,
    batch_id: str,
    table: str,
    quarantine_table: str,
    folder: str | None = None,
) -> None:
    """Write a fact with its audit columns; rows that break the contract go to quarantine.

    The fact is computed once, by the job that writes it, and both parts appear together.
    """
    judged = conform(fact, contract, batch_id)
    publish_judged(judged, batch_id, table, quarantine_table, (FAILURES,), folder)


def publish_training_set(
    payments: DataFrame,
    cases: DataFrame,
    as_of_dates: Sequence[date],
    table: str,
    folder: str | None = None,
) -> None:
    """Write or replace the training rows of the given days; other days in the table stay."""
    path = below(folder, table)
    built = training_set_backfill(payments, cases, as_of_dates)
    with staged(built, f"publish-{table}", ["as_of_date"]) as rows:
        replace_partitions(rows, table, "as_of_date", sorted(set(as_of_dates)), path)
