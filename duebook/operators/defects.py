"""Generated cases and payments with the defects that the checks must find.

Every choice is a hash of the row key, never a random draw, so a retried task and a second
run produce the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.contracts import MONEY
from duebook.functions.text import zero_padded

HOT_PORTFOLIO = "PORTFOLIO_000"
CHANNELS = ("BANK_TRANSFER", "CARD", "DIRECT_DEBIT")


def hash_number(digest: Column, part: int = 0) -> Column:
    """A number below 2**28 from seven hex digits of an MD5 digest (``part`` 0 to 3)."""
    return F.conv(F.substring(digest, 1 + 7 * part, 7), 16, 10).cast("bigint")


def chance(digest: Column, part: int, share: float) -> Column:
    """True for ``share`` of all digests, in steps of one ten-thousandth."""
    return hash_number(digest, part) % 10_000 < round(share * 10_000)


def inject_defects(
    cases: DataFrame,
    *,
    hot_share: float = 0.4,
    null_rate: float = 0.05,
    unit_error_rate: float = 0.01,
    epoch_rate: float = 0.005,
    unmapped_rate: float = 0.002,
    copy_rate: float = 0.02,
    near_copy_rate: float = 0.01,
    hot_portfolio: str = HOT_PORTFOLIO,
) -> DataFrame:
    """Plant defects in clean cases, in one projection and without a shuffle.

    A hot portfolio, missing ids and e-mail addresses, balances in the wrong money unit,
    1970-01-01 dates, an unmapped currency, exact copies, and near copies that share the key
    but not the balance.
    """
    one = F.md5(F.concat(F.lit("a:"), F.col("case_reference")))
    two = F.md5(F.concat(F.lit("b:"), F.col("case_reference")))
    missing = F.lit(None).cast("string")
    spoiled = cases.withColumns(
        {
            "portfolio_id": F.when(chance(one, 0, hot_share), F.lit(hot_portfolio)).otherwise(
                F.col("portfolio_id")
            ),
            "national_id": F.when(chance(one, 1, null_rate), missing).otherwise(
                F.col("national_id")
            ),
            "debtor_email": F.when(chance(one, 2, null_rate * 2), missing).otherwise(
                F.col("debtor_email")
            ),
            "current_balance": F.when(
                chance(one, 3, unit_error_rate), F.col("original_balance") * 100
            )
            .otherwise(F.col("current_balance"))
            .cast(MONEY),
            "default_date": F.when(
                chance(two, 0, epoch_rate), F.lit("1970-01-01").cast("date")
            ).otherwise(F.col("default_date")),
            "currency": F.when(chance(two, 1, unmapped_rate), F.lit("XXX")).otherwise(
                F.col("currency")
            ),
        }
    )
    zero, one_more = F.lit(0).cast(MONEY), F.lit(1).cast(MONEY)
    copies = F.array_compact(
        F.array(
            zero,
            F.when(chance(two, 2, copy_rate), zero),
            F.when(chance(two, 3, near_copy_rate), one_more),
        )
    )
    return (
        spoiled.withColumn("_surcharge", F.explode(copies))
        .withColumn(
            "current_balance", (F.col("current_balance") + F.col("_surcharge")).cast(MONEY)
        )
        .drop("_surcharge")
    )


def generate_cases(
    spark: SparkSession, n_cases: int = 100_000, n_portfolios: int = 20, **rates: float
) -> DataFrame:
    """``n_cases`` clean cases made on the executors, passed through :func:`inject_defects`."""
    number = F.col("id").cast("string")
    one = F.md5(F.concat(F.lit("c:"), number))
    two = F.md5(F.concat(F.lit("d:"), number))
    cents = 50_000 + hash_number(one, 0) % 5_000_000
    owed = (cents / 100).cast(MONEY)
    currencies = F.array(*[F.lit(c) for c in ("PLN", "EUR", "SEK")])
    portfolio = (hash_number(one, 1) % max(1, n_portfolios - 1) + 1).cast("string")
    clean = spark.range(n_cases).select(
        F.concat(F.lit("CASE_"), zero_padded(number, 9)).alias("case_reference"),
        F.concat(F.lit("PORTFOLIO_"), zero_padded(portfolio, 3)).alias("portfolio_id"),
        zero_padded((hash_number(one, 2) * 373).cast("string"), 11).alias("national_id"),
        F.concat(F.lit("Debtor "), number).alias("debtor_name"),
        F.concat(F.lit("debtor"), number, F.lit("@example.invalid")).alias("debtor_email"),
        F.concat(F.lit("+48"), zero_padded(hash_number(one, 3).cast("string"), 9)).alias(
            "debtor_phone"
        ),
        F.concat(F.lit("Street "), number).alias("debtor_address"),
        zero_padded((hash_number(two, 0) % 99).cast("string"), 2).alias("postcode_area"),
        owed.alias("original_balance"),
        (owed * (hash_number(two, 1) % 10_000).cast("decimal(5,0)") / 10_000)
        .cast(MONEY)
        .alias("current_balance"),
        F.date_sub(F.lit("2024-01-01").cast("date"), (hash_number(two, 2) % 1500).cast("int")).alias(
            "default_date"
        ),
        F.element_at(currencies, (hash_number(two, 3) % 3 + 1).cast("int")).alias("currency"),
        F.lit("CONSUMER_LOAN").alias("product_type"),
    )
    return inject_defects(clean, **rates)


def generate_payments(
    cases: DataFrame, payments_per_case: float = 3.0, backdated_rate: float = 0.03
) -> DataFrame:
    """1 to ``2 * payments_per_case`` payments per case, some dated before the default."""
    most = max(1, int(payments_per_case * 2))
    case_digest = F.md5(F.concat(F.lit("n:"), F.col("case_reference")))
    how_many = (hash_number(case_digest) % most + 1).cast("int")
    rows = (
        cases.select(
            "case_reference",
            "default_date",
            F.explode(F.sequence(F.lit(1), how_many)).alias("_n"),
        )
        .withColumn(
            "payment_id", F.concat("case_reference", F.lit("_P"), F.col("_n").cast("string"))
        )
        .withColumn("_digest", F.md5("payment_id"))
    )
    digest = F.col("_digest")
    later = (hash_number(digest, 0) % 900).cast("int")
    days = F.when(chance(digest, 1, backdated_rate), -1 - later % 60).otherwise(later)
    cents = 1_000 + hash_number(digest, 2) % 80_000
    return rows.select(
        "payment_id",
        "case_reference",
        F.date_add("default_date", days).alias("payment_date"),
        (cents.cast("decimal(18,0)") / 100).cast(MONEY).alias("amount"),
        F.element_at(
            F.array(*[F.lit(c) for c in CHANNELS]), (hash_number(digest, 3) % 3 + 1).cast("int")
        ).alias("channel"),
    )
