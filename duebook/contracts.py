"""Schema contracts of every layer, and the step that enforces them.

A contract names the columns of a layer, their order and their types; :func:`conform` applies one to a frame and
turns every value it cannot type, and every NULL it must not have, into a named failure of the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from duebook.operators.quality import ERROR, Rule, flag_failures

MONEY = DecimalType(18, 2)
RATE = DecimalType(9, 6)

AUDIT_FIELDS = [
    StructField("_ingested_at", TimestampType(), False),
    StructField("_batch_id", StringType(), False),
]


def _text(*names: str, required: bool = False) -> list[StructField]:
    return [StructField(n, StringType(), not required) for n in names]


# The columns an originator is contracted to send, in contract order.
RAW_CASES = StructType(
    _text("case_reference", "portfolio_id", required=True)
    + _text(
        "national_id",
        "debtor_name",
        "debtor_email",
        "debtor_phone",
        "debtor_address",
        "postcode_area",
        "date_of_birth",
        "original_balance",
        "current_balance",
        "default_date",
        "product_type",
        "currency",
    )
)

# Columns an originator may add without a review.
OPTIONAL_INBOUND = frozenset(
    {"segment_code", "collection_status", "last_payment_date", "originator_score"}
)

_SILVER_TYPES = {
    "original_balance": MONEY,
    "current_balance": MONEY,
    "default_date": DateType(),
    "date_of_birth": DateType(),
}

SILVER_CASES = StructType(
    [
        StructField(f.name, _SILVER_TYPES.get(f.name, f.dataType), f.nullable)
        for f in RAW_CASES.fields
    ]
)

# Fixed values from here on: names, order and types of columns are the contract.
PAYMENTS = StructType(
    [
        StructField("payment_id", StringType(), False),
        StructField("case_reference", StringType(), False),
        StructField("payment_date", DateType(), False),
        StructField("amount", MONEY, False),
        StructField("channel", StringType()),
    ]
)

PLACEMENTS = StructType(
    [
        StructField("case_reference", StringType(), False),
        StructField("client_id", StringType(), False),
        StructField("placed_date", DateType(), False),
        StructField("first_contact_date", DateType()),
    ]
)

PORTFOLIOS = StructType(
    [
        StructField("portfolio_id", StringType(), False),
        StructField("purchase_date", DateType(), False),
        StructField("purchase_price", MONEY),
        StructField("gross_face_value", MONEY),
        StructField("seller_name", StringType()),
        StructField("country_code", StringType()),
    ]
)

CLIENT_CONTRACTS = StructType(
    [
        StructField("client_id", StringType(), False),
        StructField("commission_rate", RATE, False),
        StructField("sla_target_days", IntegerType()),
        StructField("valid_from", DateType(), False),
        StructField("valid_to", DateType()),
    ]
)

FORECAST_CURVE = StructType(
    [
        StructField("portfolio_id", StringType(), False),
        StructField("months_on_book", IntegerType(), False),
        StructField("forecast_pct", RATE, False),
    ]
)

# Fixed values as well. One row per owned portfolio and month.
INVESTING_FACT = StructType(
    [
        StructField("portfolio_id", StringType(), False),
        StructField("as_of_month", DateType(), False),
        StructField("months_on_book", IntegerType(), False),
        StructField("collections_actual", MONEY, False),
        StructField("collections_forecast", MONEY),
        StructField("erc_remaining", MONEY),
        StructField("recovery_rate_to_date", RATE),
        StructField("purchase_price", MONEY),
        StructField("money_multiple", RATE),
        *AUDIT_FIELDS,
    ]
)

# One row per client, case and month. Debt serviced for a client has no purchase price.
SERVICING_FACT = StructType(
    [
        StructField("client_id", StringType(), False),
        StructField("case_reference", StringType(), False),
        StructField("as_of_month", DateType(), False),
        StructField("collections_actual", MONEY, False),
        StructField("commission_rate", RATE, False),
        StructField("commission_earned", MONEY, False),
        StructField("sla_target_days", IntegerType()),
        StructField("sla_actual_days", IntegerType()),
        StructField("sla_met", StringType()),
        *AUDIT_FIELDS,
    ]
)

# Reference tables that must exist with these types before the first load.
REFERENCE_TABLES = {
    "portfolios": PORTFOLIOS,
    "client_contracts": CLIENT_CONTRACTS,
    "forecast_curve": FORECAST_CURVE,
}


def conform(df: DataFrame, contract: StructType, batch_id: str) -> DataFrame:
    """Project ``df`` onto ``contract`` and flag the rows that break it.

    Columns come out in contract order and type. ``_dq_failures`` names every required
    field that is NULL and every value the cast lost, so the caller splits the result
    with :func:`duebook.operators.quality.split` and quarantines the rest.
    One narrow projection: no shuffle.
    """
    audit = {f.name for f in AUDIT_FIELDS}
    missing = [f.name for f in contract.fields if f.name not in df.columns and f.name not in audit]
    if missing:
        raise ValueError(f"columns required by the contract are absent: {missing}")

    typed, rules = [], []
    for field in contract.fields:
        name = field.name
        if name in audit and name not in df.columns:
            value = F.current_timestamp() if name == "_ingested_at" else F.lit(batch_id)
            typed.append(value.alias(name))
            continue
        value = F.col(name).try_cast(field.dataType)
        typed.append(value.alias(name))
        if df.schema[name].dataType != field.dataType:
            typed.append((F.col(name).isNotNull() & value.isNull()).alias(f"_lost_{name}"))
            rules.append(Rule(f"{name}_fits_type", f"NOT _lost_{name}", ERROR))
        if not field.nullable:
            rules.append(Rule(f"{name}_not_null", f"{name} IS NOT NULL", ERROR))
    flagged = flag_failures(df.select(*typed), rules)
    return flagged.drop(*[c for c in flagged.columns if c.startswith("_lost_")])
