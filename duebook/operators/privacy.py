"""Personal-data policy: what happens to each column, guards, and read-time protection."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.functions.privacy import last_four, pseudonym

PSEUDONYMISE = "pseudonymise"
MASK_LAST4 = "mask_last4"
REDACT = "redact"
KEEP = "keep"

# Treatment and reason per personal column.
REGISTRY: dict[str, tuple[str, str]] = {
    "national_id": (PSEUDONYMISE, "joins one person across portfolios"),
    "debtor_email": (PSEUDONYMISE, "shows whether a person can be contacted"),
    "debtor_phone": (MASK_LAST4, "the last digits let an agent verify a caller"),
    "debtor_name": (REDACT, "not needed for analysis"),
    "debtor_address": (REDACT, "not needed for analysis"),
    "postcode_area": (KEEP, "coarse area for segments"),
    "date_of_birth": (REDACT, "not needed for analysis"),
}

# Fragments that make a column name look personal.
SUSPICIOUS = ("name", "email", "phone", "mobile", "address", "birth", "pesel", "nip")

# Access groups of the read-time rules.
PHONE_GROUP = "collections-ops"
PSEUDONYM_GROUP = "data-engineers"
ALL_CLIENTS_GROUP = "servicing-all-clients"
CLIENT_GROUP_PREFIX = "client-"

Registry = Mapping[str, tuple[str, str]]


def apply_policy(df: DataFrame, pepper: str, registry: Registry = REGISTRY) -> DataFrame:
    """Replace, mask or drop every registered column in one projection.

    Columns without a rule pass unchanged, absent ones are ignored, and applying the policy
    twice changes nothing.
    """
    kept: list[Column] = []
    derived: list[Column] = []
    for name in df.columns:
        treatment = registry.get(name, (KEEP, ""))[0]
        if treatment == KEEP:
            kept.append(F.col(name))
        elif treatment == PSEUDONYMISE:
            derived.append(pseudonym(F.col(name), pepper).alias(f"{name}_pseudonym"))
        elif treatment == MASK_LAST4:
            derived.append(last_four(F.col(name)).alias(f"{name}_masked"))
        elif treatment != REDACT:
            raise ValueError(f"unknown treatment {treatment!r} for column {name}")
    return df.select(*kept, *derived)


def forbidden_columns(columns: Iterable[str], registry: Registry = REGISTRY) -> list[str]:
    """Registered columns that must not appear under their raw name in a written table."""
    return sorted(c for c in set(columns) if registry.get(c, (KEEP, ""))[0] != KEEP)


def assert_no_personal_data(
    columns: Iterable[str], target: str, registry: Registry = REGISTRY
) -> None:
    leaked = forbidden_columns(columns, registry)
    if leaked:
        raise ValueError(f"raw personal data {leaked} must not be written to {target}")


def assert_registry_covers(
    columns: Iterable[str], known_safe: Collection[str] = (), registry: Registry = REGISTRY
) -> None:
    """Refuse a column whose name looks personal but that has no registered treatment."""
    unknown = [c for c in columns if c not in known_safe and _looks_unregistered(c, registry)]
    if unknown:
        raise ValueError(f"columns {sorted(unknown)} look personal: register a treatment")


def _looks_unregistered(column: str, registry: Registry) -> bool:
    name = column.lower()
    return column not in registry and any(fragment in name for fragment in SUSPICIOUS)


def unregistered_columns(
    spark: SparkSession, schema: str, registry: Registry = REGISTRY
) -> list[tuple[str, str]]:
    """(table, column) of every suspicious column in a catalog schema, from metadata only.

    The policy's own output columns (``..._pseudonym``, ``..._masked``) are treated already.
    """
    return [
        (table.name, column.name)
        for table in spark.catalog.listTables(schema)
        if not table.isTemporary
        for column in spark.catalog.listColumns(f"{schema}.{table.name}")
        if _looks_unregistered(column.name, registry)
        and column.name not in masked_columns([column.name])
    ]


# Read-time masks as SQL. ``member`` says whether the reader belongs to the group that may
# see the value.
PHONE_MASK = (
    "CASE WHEN member THEN phone "
    "ELSE concat('***', right(regexp_replace(phone, '[^0-9]', ''), 4)) END"
)
PSEUDONYM_MASK = "CASE WHEN member THEN value END"


CLIENT_FILTER = (
    f"array_contains(groups, '{ALL_CLIENTS_GROUP}') "
    f"OR coalesce(array_contains(groups, concat('{CLIENT_GROUP_PREFIX}', lower(client))), false)"
)


def create_access_functions(spark: SparkSession) -> None:
    """Register ``mask_phone``, ``mask_pseudonym`` and ``client_row_filter`` as SQL functions.

    ``groups`` are those of the reader; open-source Spark knows no account groups.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION client_row_filter("
        f"client STRING, groups ARRAY<STRING>) RETURNS BOOLEAN RETURN {CLIENT_FILTER}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_phone(phone STRING, member BOOLEAN) "
        f"RETURNS STRING RETURN {PHONE_MASK}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_pseudonym(value STRING, member BOOLEAN) "
        f"RETURNS STRING RETURN {PSEUDONYM_MASK}"
    )


def masked_columns(columns: Iterable[str]) -> dict[str, str]:
    """Column name to the mask a view must put on it."""
    masks = {}
    for name in columns:
        if name.endswith("_masked"):
            masks[name] = PHONE_GROUP
        elif name.endswith("_pseudonym"):
            masks[name] = PSEUDONYM_GROUP
    return masks


MOST_GROUPS = 10_000


def masked(df: DataFrame, groups: Collection[str]) -> DataFrame:
    """``df`` as a member of ``groups`` may see it: one projection, pushed into the scan."""
    hidden = {n: g for n, g in masked_columns(df.columns).items() if g not in groups}
    digits = {
        n: F.concat(F.lit("***"), F.right(F.regexp_replace(n, "[^0-9]", ""), F.lit(4)))
        for n, g in hidden.items()
        if g == PHONE_GROUP
    }
    blank = {n: F.lit(None).cast("string") for n, g in hidden.items() if g == PSEUDONYM_GROUP}
    return df.withColumns({**digits, **blank}) if hidden else df


def create_masked_view(
    spark: SparkSession, table: str, view: str, groups: Collection[str]
) -> DataFrame:
    """A view of ``table`` for readers in ``groups``; checks that every mask is attached."""
    source = spark.table(table)
    shown = masked(source, groups)
    if shown.columns != source.columns:
        raise ValueError(f"view {view} does not have the columns of {table}")
    shown.createOrReplaceTempView(view)
    return spark.table(view)


def visible_rows(
    df: DataFrame,
    entitlements: DataFrame,
    principal: str,
    key: str = "client_id",
    most_groups: int = MOST_GROUPS,
) -> DataFrame:
    """Rows of the clients that ``principal`` may see.

    ``entitlements`` has (principal, group_name). A member of the all-clients group sees
    every row, others those of ``client-<lower-case id>``. The groups of one principal are read
    first; up to ``most_groups`` of them become a list in the filter, which runs in the scan. A
    principal with more is matched by a semi join of the fact with the groups.
    """
    groups = entitlements.where(F.col("principal") == principal).select("group_name").distinct()
    known = [row["group_name"] for row in groups.limit(most_groups + 1).collect()]
    own = F.concat(F.lit(CLIENT_GROUP_PREFIX), F.lower(key))
    if len(known) <= most_groups:
        return df if ALL_CLIENTS_GROUP in known else df.where(own.isin(known))
    if not groups.where(F.col("group_name") == ALL_CLIENTS_GROUP).isEmpty():
        return df
    return df.join(groups, own == F.col("group_name"), "left_semi")
