"""Joins with a size-checked broadcast, and valid-time (SCD2) dimensions.

Validity is half open, ``[valid_from, valid_to)``; a NULL ``valid_to`` means still open.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 200_000
OPEN_END = date(9999, 12, 31)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast only when a count proves the side small; else leave it to Spark.

    Meant for narrow dimensions whose estimated size Catalyst gets wrong (a view over a
    large table, say). The count is a map-side-combined aggregate, so checking a side that
    turns out large costs one scan and moves no rows. Beyond the bound the join stays an
    equi join that Spark sorts and merges, with adaptive skew splitting.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def join_large(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join two sides that both grow with the data.

    The merge hint keeps Catalyst from broadcasting one of them on the strength of a low
    estimate (compressed files, derived columns). It spills, and adaptive execution splits
    its skewed partitions.
    """
    return left.join(right.hint("merge"), on, how)


def valid_at(at: Column) -> Column:
    """Predicate: the row's validity covers ``at``."""
    return (F.col("valid_from") <= at) & (at < F.coalesce(F.col("valid_to"), F.lit(OPEN_END)))


def as_of_slice(df: DataFrame, as_of: date) -> DataFrame:
    """The dimension versions valid on one day; unversioned frames pass unchanged."""
    return df.where(valid_at(F.lit(as_of))) if "valid_from" in df.columns else df


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def versions_by_month(versions: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per version and calendar month (``_month``) that it covers between two days.

    The two days bound what an open end turns into. Versions without a start, those that end before
    they begin and those outside the days have no rows.
    """
    begins = F.greatest(F.col("valid_from"), first)
    ends = F.least(F.date_sub(F.coalesce(F.col("valid_to"), F.lit(OPEN_END)), 1), last)
    covers = F.col("valid_from").isNotNull() & first.isNotNull() & (begins <= ends)
    months = F.when(covers, F.sequence(_month_number(begins), _month_number(ends)))
    return versions.withColumn("_month", F.explode(months))


def join_version_by_month(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    span: tuple[date, date] | None = None,
) -> DataFrame:
    """:func:`join_valid_version` for version tables of any size and keys with any number of versions.

    Equality on (key, month) with the exact range as a residual: a fact meets the versions of its own
    month and not all of its key's, and a key with many facts or versions spreads over its months.
    Adaptive execution splits a month that is still too large on the fact side. ``span`` names the
    first and last day of ``facts[at]``; without it one aggregate over the facts finds them. Facts whose
    key or day is NULL, or which no version covers, stay with NULLs.
    """
    if span is None:
        found = facts.agg(F.min(at), F.max(at)).first()
        span = (found[0], found[1])
    first, last = (F.lit(day).cast("date") for day in span)
    placed = versions_by_month(versions.withColumnRenamed(key, "_version_key"), first, last)
    on = (
        (F.col(key) == F.col("_version_key"))
        & (_month_number(F.col(at)) == F.col("_month"))
        & valid_at(F.col(at))
    )
    return join_large(facts, placed, on, "left").drop("_version_key", "_month", "valid_from", "valid_to")


def join_valid_version(

    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Left join the version of ``versions`` that was valid at ``facts[at]``.

    A version table that a count proves small is broadcast: equality on the key, the range as a
    residual. A larger one is joined by month, see :func:`join_version_by_month`. Neither plans as a
    nested loop.
    """
    if versions.count() > broadcast_max_rows:
        return join_version_by_month(facts, versions, key, at)
    dimension = F.broadcast(versions.withColumnRenamed(key, "_version_key"))
    on = (F.col(key) == F.col("_version_key")) & valid_at(F.col(at))
    return facts.join(dimension, on, "left").drop("_version_key", "valid_from", "valid_to")
