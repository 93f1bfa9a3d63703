"""Case files to clean and quarantined tables.

One pass over the files: header check, typed values, rules and privacy policy are all row-wise
and run in the scan stage, so that raw personal data is neither shuffled nor written. The only
shuffle is the deduplication. Its result is written once; the counts for the circuit breaker are observed by
that write, and the clean table and the quarantine table are views of it, switched together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duebook.contracts import (
    OPTIONAL_INBOUND,
    PAYMENTS,
    PLACEMENTS,
    RAW_CASES,
    SILVER_CASES,
)
from duebook.operators.privacy import apply_policy, assert_registry_covers
from duebook.operators.quality import (
    ERROR,
    HAS_ERROR,
    Rule,
    case_rules,
    check_error_rate,
    dedupe_latest,
    flag_failures,
    observed_metrics,
    payment_rules,
    placement_rules,
    recorded_metrics,
    split,
)
from duebook.plans.publish import below, publish_judged
from duebook.sources.landing import CORRUPT, read_landing
from duebook.sources.storage import replace_partition, staged
from duebook.sources.upsert import upsert
from duebook.sources.versions import Version

QUARANTINE_LIMIT = 0.10
_OWN_KEY = "_own_key"
ARRIVAL = ("_arrived_at", "_source_file")
KNOWN_SAFE = ("case_reference", "portfolio_id", "_source_file", "_arrived_at")

_CAST_TARGETS = {
    f.name: f.dataType
    for f in SILVER_CASES.fields
    if f.dataType != RAW_CASES[f.name].dataType
}


def type_cases(bronze: DataFrame) -> DataFrame:
    """Text to typed columns. ``_lost_<column>`` marks a value the cast could not read."""
    typed = {name: F.col(name).try_cast(kind) for name, kind in _CAST_TARGETS.items()}
    lost = {
        f"_lost_{name}": F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
        for name, kind in _CAST_TARGETS.items()
    }
    return bronze.withColumns(lost).withColumns(typed)


def typing_rules() -> list[Rule]:
    return [Rule(f"{name}_readable", f"NOT _lost_{name}", ERROR) for name in _CAST_TARGETS]


def silver_cases(bronze: DataFrame) -> DataFrame:
    """Typed cases with the names of unreadable values in ``_dq_failures``."""
    return drop_lost_flags(flag_failures(type_cases(bronze), typing_rules()))


def drop_lost_flags(df: DataFrame) -> DataFrame:
    return df.drop(*[f"_lost_{name}" for name in _CAST_TARGETS])


@dataclass(frozen=True)
class Ingested:
    clean: str
    quarantine: str
    metrics: Mapping[str, int]


def ingest_rules(as_of: date) -> list[Rule]:
    well_formed = Rule("row_well_formed", f"{CORRUPT} IS NULL", ERROR)
    return [well_formed, *typing_rules(), *case_rules(as_of)]


def with_optional_columns(landed: DataFrame) -> DataFrame:
    """All columns an originator may add, NULL where it did not: table layouts stay fixed."""
    absent = sorted(OPTIONAL_INBOUND - set(landed.columns))
    return landed.withColumns({c: F.lit(None).cast("string") for c in absent}).select(
        *[c for c in landed.columns if c not in OPTIONAL_INBOUND], *sorted(OPTIONAL_INBOUND)
    )


def checked_cases(landed: DataFrame, as_of: date, pepper: str) -> DataFrame:
    """Landed rows typed, judged, pseudonymised and deduplicated.

    The raw text of a malformed line may hold personal data and is dropped.
    """
    judged = drop_lost_flags(flag_failures(type_cases(landed), ingest_rules(as_of)))
    protected = apply_policy(_number_unkeyed(judged, "case_reference").drop(CORRUPT), pepper)
    return _latest_arrival(protected, ["case_reference"]).drop("_arrived_at")


def _number_unkeyed(landed: DataFrame, *keys: str) -> DataFrame:
    """Give every row that cannot be keyed (malformed, or without one of ``keys``) a key of its own.

    Such rows are all kept for quarantine, and the numbers spread them over tasks. Numbering
    happens in the file scan, where a repeated task sees the same rows in the same order.
    """
    unkeyed = F.col(CORRUPT).isNotNull()
    for key in keys:
        unkeyed = unkeyed | F.coalesce(F.length(F.trim(key)) == 0, F.lit(True))
    return landed.withColumn(_OWN_KEY, F.when(unkeyed, F.monotonically_increasing_id()))


def _latest_arrival(rows: DataFrame, keys: Sequence[str], *then: str) -> DataFrame:
    """The version of each key from the file that arrived last; its path only decides a tie."""
    return dedupe_latest(rows, [*keys, _OWN_KEY], [*ARRIVAL, *then]).drop(_OWN_KEY)


@dataclass(frozen=True)
class Feed:
    """A silver table that is fed by changes: its contract, key, month and own rules.

    ``then`` breaks ties between rows of one file.
    """

    contract: StructType
    keys: tuple[str, ...]
    date: str
    month: str
    rules: Callable[[date], list[Rule]]
    then: tuple[str, ...] = ()

    def all_rules(self, as_of: date) -> list[Rule]:
        return [
            Rule("row_well_formed", f"{CORRUPT} IS NULL", ERROR),
            *[
                Rule(f"{f.name}_not_null", f"{f.name} IS NOT NULL")
                for f in self.contract
                if not f.nullable
            ],
            *self.rules(as_of),
        ]


PAYMENT_FEED = Feed(
    PAYMENTS, ("payment_id",), "payment_date", "payment_month", payment_rules, ("payment_date",)
)
PLACEMENT_FEED = Feed(
    PLACEMENTS,
    ("case_reference", "client_id"),
    "placed_date",
    "placed_month",
    placement_rules,
    ("placed_date",),
)


def checked_feed(landed: DataFrame, feed: Feed, as_of: date) -> DataFrame:
    """Landed rows (already typed by their contract) judged, latest version per key, with its arrival."""
    judged = flag_failures(landed, feed.all_rules(as_of))
    return _latest_arrival(_number_unkeyed(judged, *feed.keys).drop(CORRUPT), feed.keys, *feed.then)


def silver_payments(landed: DataFrame, as_of: date) -> DataFrame:
    """Payments as they are published, with failures: latest version per payment."""
    return checked_feed(landed, PAYMENT_FEED, as_of).drop("_arrived_at")


def ingest_changes(
    spark: SparkSession,
    landing_path: str,
    feed: Feed,
    *,
    batch_id: str,
    as_of: date,
    table: str,
    quarantine_table: str,
    table_folder: str | None = None,
    limit: float = QUARANTINE_LIMIT,
) -> Ingested:
    """Add a batch of new, corrected or late rows to a table that is partitioned by month.

    Across batches the version that arrived last wins, whichever batch runs last. Only months with changed
    keys are written again. Nothing is published if too many rows are quarantined; a batch that runs
    again replaces its own rejects and changes nothing else.
    """
    landed = read_landing(spark, landing_path, feed.contract, batch_id, allowed_new=())
    rules = feed.all_rules(as_of)
    checked, observed = observed_metrics(checked_feed(landed, feed, as_of), rules)
    with staged(checked, f"ingest-{batch_id}", [HAS_ERROR]) as rows:
        metrics = trusted_metrics(observed, rows, rules)
        check_error_rate(metrics, limit)
        clean, rejected = split(rows)
        replace_partition(
            rejected, quarantine_table, "_batch_id", batch_id, below(table_folder, quarantine_table)
        )
        monthly = clean.withColumn(feed.month, F.date_format(feed.date, "yyyy-MM"))
        folder = below(table_folder, table)
        upsert(monthly, table, feed.keys, feed.month, ARRIVAL, folder, reduced=True)  # by checked_feed
    return Ingested(table, quarantine_table, metrics)


def ingest_payments(spark: SparkSession, landing_path: str, **options) -> Ingested:
    """:func:`ingest_changes` for payments: one row per payment id, by month of payment."""
    return ingest_changes(spark, landing_path, PAYMENT_FEED, **options)


def ingest_placements(spark: SparkSession, landing_path: str, **options) -> Ingested:
    """:func:`ingest_changes` for placements: one row per case and client, by month of placement."""
    return ingest_changes(spark, landing_path, PLACEMENT_FEED, **options)


def ingest_cases(
    spark: SparkSession,
    landing_path: str,
    *,
    batch_id: str,
    as_of: date,
    pepper: str,
    clean_table: str,
    quarantine_table: str,
    table_folder: str | None = None,
    limit: float = QUARANTINE_LIMIT,
) -> Ingested:
    """Replace the clean table with this batch and add its rejects to the quarantine table.

    One job reads the files, writes the batch and counts what the rules found; clean rows and rejects then
    appear together. Nothing is published if the share of quarantined rows is above ``limit``.
    Running a batch again replaces its rejects.
    """
    landed = with_optional_columns(read_landing(spark, landing_path, RAW_CASES, batch_id))
    assert_registry_covers([c for c in landed.columns if c != CORRUPT], KNOWN_SAFE)
    rules = ingest_rules(as_of)
    rows, observed = observed_metrics(checked_cases(landed, as_of, pepper), rules)
    metrics: dict[str, int] = {}

    def check(version: Version) -> None:
        metrics.update(trusted_metrics(observed, spark.table(version.name), rules))
        check_error_rate(metrics, limit)

    publish_judged(rows, batch_id, clean_table, quarantine_table, folder=table_folder, check=check)
    return Ingested(clean_table, quarantine_table, metrics)


def trusted_metrics(
    observed: Observation, written: DataFrame, rules: Sequence[Rule]
) -> dict[str, int]:
    """Metrics observed in the write, if they count the written rows; else counted from those.

    Tasks that ran twice may have been observed twice. The number of written rows comes from file footers.
    """
    found = observed.get
    if found.get("rows_total") == written.count():
        return dict(found)
    return recorded_metrics(written, rules).first().asDict()
