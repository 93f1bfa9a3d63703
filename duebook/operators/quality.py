"""Rule-based data quality: evaluate, split, measure, stop, deduplicate.

A rule is stored as SQL text so that it can be printed, kept in a table and reviewed.
All rules are evaluated in one projection, and all counts in one aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

ERROR = "error"
WARN = "warn"
FAILURES = "_dq_failures"
HAS_ERROR = "_dq_has_error"


@dataclass(frozen=True)
class Rule:
    """``passes`` is a SQL predicate; false and NULL both count as a failure."""

    name: str
    passes: str
    severity: str = ERROR
    description: str = ""


def _fails(rule: Rule) -> Column:
    return ~F.coalesce(F.expr(rule.passes), F.lit(False))


def _any_fails(rules: Sequence[Rule]) -> Column:
    return reduce(Column.__or__, [_fails(rule) for rule in rules], F.lit(False))


def _errors(rules: Sequence[Rule]) -> list[Rule]:
    return [rule for rule in rules if rule.severity == ERROR]


def flag_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the names of the failed rules and whether any of them is an error.

    The list is only built for rows that fail something, and the error flag is a plain
    predicate, so that a filter on it can be pushed towards the scan.
    """
    nothing = F.array().cast("array<string>")
    names = F.array_compact(F.array(*[F.when(_fails(r), F.lit(r.name)) for r in rules]))
    failed = F.when(_any_fails(rules), names).otherwise(nothing) if rules else nothing
    return df.select("*", failed.alias(FAILURES), _any_fails(_errors(rules)).alias(HAS_ERROR))


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined). Warnings stay in the clean part, with their names."""
    clean = flagged.where(~F.col(HAS_ERROR)).drop(HAS_ERROR)
    quarantined = flagged.where(F.col(HAS_ERROR)).drop(HAS_ERROR)
    return clean, quarantined


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, quarantined, metrics), all lazy. Nothing is cached or collected here."""
    if not rules:
        empty = df.withColumn(FAILURES, F.array().cast("array<string>")).where(F.lit(False))
        return df, empty, rule_metrics(df, rules)
    return (*split(flag_failures(df, rules)), rule_metrics(df, rules))


def rule_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: total, failures per rule, quarantined. One pass, combined on the map side."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_total"),
        *[F.count_if(_fails(rule)).alias(f"failed_{rule.name}") for rule in rules],
        F.count_if(_any_fails(_errors(rules))).alias("rows_quarantined"),
    )


def recorded_metrics(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same row from a written result, which may no longer have the rules' columns."""
    return flagged.agg(*_recorded(rules))


def _recorded(rules: Sequence[Rule]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows_total"),
        *[
            F.count_if(F.array_contains(FAILURES, rule.name)).alias(f"failed_{rule.name}")
            for rule in rules
        ],
        F.count_if(HAS_ERROR).alias("rows_quarantined"),
    ]


def observed_metrics(flagged: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """``flagged`` with its :func:`recorded_metrics` observed by whatever job computes it next.

    Rows of a task that ran twice may be counted twice: compare ``rows_total`` with what was written.
    """
    observation = Observation()
    counts = _recorded(rules)
    return flagged.observe(observation, *counts), observation


def error_rate(metrics: DataFrame, threshold: float) -> DataFrame:
    """The circuit breaker's verdict on rows of metrics: ``rate``, ``passed`` and why not."""
    rate = F.when(F.col("rows_total") > 0, F.col("rows_quarantined") / F.col("rows_total"))
    reason = F.when(rate.isNull(), "the source is empty").when(rate > threshold, "above the limit")
    return metrics.select(
        "rows_total",
        "rows_quarantined",
        rate.alias("rate"),
        F.lit(threshold).alias("threshold"),
        reason.isNull().alias("passed"),
        F.coalesce(reason, F.lit("")).alias("reason"),
    )


def check_error_rate(metrics: Mapping[str, int], threshold: float) -> None:
    """Circuit breaker over one collected metrics row."""
    total = metrics["rows_total"]
    if total == 0:
        raise ValueError("no rows reached the rules: the source is empty")
    rate = metrics["rows_quarantined"] / total
    if rate > threshold:
        raise ValueError(f"{rate:.2%} of {total} rows quarantined, limit is {threshold:.2%}")


def case_rules(as_of: date) -> list[Rule]:
    """Rules for typed cases."""
    # Names, limits, currencies and severities of the rules.
    return [
        Rule(
            "case_reference_present",
            "case_reference IS NOT NULL AND length(trim(case_reference)) > 0",
            ERROR,
            "without a reference no payment can be matched",
        ),
        Rule(
            "balance_non_negative",
            "current_balance >= 0",
            ERROR,
            "a negative balance is a payment booked on the wrong case",
        ),
        Rule(
            "balance_not_above_original",
            "current_balance <= original_balance * 3",
            WARN,
            "more than three times the principal points to a wrong money unit",
        ),
        Rule(
            "currency_supported",
            "currency IN ('PLN', 'EUR', 'SEK', 'GBP')",
            ERROR,
            "an unknown currency makes every converted total wrong",
        ),
        Rule(
            "default_date_not_future",
            f"default_date <= DATE'{as_of.isoformat()}'",
            ERROR,
            "a default cannot lie after the as-of date",
        ),
        Rule(
            "national_id_or_contact_present",
            "national_id IS NOT NULL OR debtor_email IS NOT NULL OR debtor_phone IS NOT NULL",
            WARN,
            "nobody can be identified or reached",
        ),
    ]


def payment_rules(as_of: date) -> list[Rule]:
    # Names, limits and severities of the rules.
    return [
        Rule("payment_amount_positive", "amount > 0", ERROR),
        Rule("payment_date_not_future", f"payment_date <= DATE'{as_of.isoformat()}'", ERROR),
        Rule(
            "payment_date_plausible",
            "payment_date >= DATE'2000-01-01'",
            WARN,
            "1970-01-01 is a zero timestamp, not a payment day",
        ),
    ]


def placement_rules(as_of: date) -> list[Rule]:
    return [
        Rule("placed_date_not_future", f"placed_date <= DATE'{as_of.isoformat()}'", ERROR),
        Rule(
            "contact_not_before_placement",
            "first_contact_date IS NULL OR first_contact_date >= placed_date",
            WARN,
            "a debtor cannot be reached before the case arrives",
        ),
    ]


def dedupe_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """Keep the row with the highest ``latest_by`` values per key; NULL keys form one group.

    Ties go to the highest of the remaining columns, in order, so the pick never depends on
    how rows arrive: rows that still tie are identical. ``row_number() = 1`` is planned with a
    partial group limit before the shuffle: each map task sends at most one row per key, which
    keeps a key that holds a third of the table harmless. The key's hash leads the
    partitioning because sorting compares its eight bytes before it looks at any text.
    """
    tie_break = [c for c in df.columns if c not in {*keys, *latest_by}]
    latest = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(
        *[F.desc(c) for c in [*latest_by, *tie_break]]
    )
    ranked = df.withColumn("_rank", F.row_number().over(latest))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
