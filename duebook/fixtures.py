"""Receivables-shaped frames derived from the benchmark tables.

The same definitions exist as SQL text in :mod:`duebook.oracles`; these are the
DataFrame versions that the registered queries read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.functions.text import zero_padded
from duebook.operators.quality import dedupe_latest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def case_number(reference: str = "case_reference") -> Column:
    return F.expr(f"substring({reference}, 6)").cast("bigint")


def _case_reference(key: str) -> Column:
    return F.concat(F.lit("CASE_"), zero_padded(F.col(key).cast("string"), 9))


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with planted defects."""
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    ordered = F.col("o_orderdate").cast("date")
    balance = (
        F.when(key % 100 == 7, F.lit(-10).cast("decimal(18,2)"))
        .when(key % 100 == 13, (price * 100).cast("decimal(18,2)"))
        .when(key % 250 == 99, F.lit(None).cast("decimal(18,2)"))
        .otherwise(price)
    )
    default_date = (
        F.when(key % 200 == 21, _date("1970-01-01"))
        .when(key % 333 == 5, _date("2099-01-01"))
        .otherwise(ordered)
    )
    currency = (
        F.when(key % 500 == 3, "XXX")
        .when(key % 3 == 0, "PLN")
        .when(key % 3 == 1, "EUR")
        .otherwise("SEK")
    )
    contacted = F.when(
        F.col("o_orderstatus") != "P", F.date_add(ordered, (key % 45).cast("int"))
    )
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        _case_reference("o_orderkey").alias("case_reference"),
        F.concat(F.lit("PF_"), zero_padded(F.col("c_nationkey").cast("string"), 2)).alias(
            "portfolio_id"
        ),
        F.col("c_mktsegment").alias("client_id"),
        F.col("c_custkey").alias("debtor_key"),
        price.alias("original_balance"),
        balance.alias("current_balance"),
        default_date.alias("default_date"),
        currency.alias("currency"),
        ordered.alias("placed_date"),
        contacted.alias("first_contact_date"),
    )


def payments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item; payment ids repeat, so this is real dedupe input."""
    reference = _case_reference("l_orderkey")
    channel = (
        F.when(F.col("l_returnflag") == "A", "BANK_TRANSFER")
        .when(F.col("l_returnflag") == "N", "CARD")
        .otherwise("DIRECT_DEBIT")
    )
    return table(spark, sf_dir, "lineitem").select(
        reference.alias("case_reference"),
        F.col("l_linenumber").alias("line_no"),
        F.concat(reference, F.lit("_P"), F.col("l_linenumber").cast("string")).alias("payment_id"),
        F.col("l_shipdate").cast("date").alias("payment_date"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        channel.alias("channel"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest version of each payment, ties broken by amount and channel."""
    raw = payments_raw(spark, sf_dir).select(
        "case_reference", "payment_id", "payment_date", "amount", "channel"
    )
    return dedupe_latest(raw, ["payment_id"], ["payment_date", "amount", "channel"])


def portfolios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PF_24 has no row and PF_23 has price 0."""
    face = F.sum("original_balance")
    price = F.when(F.col("portfolio_id") == "PF_23", F.lit(0).cast("decimal(18,2)")).otherwise(
        (face * F.lit("0.12").cast("decimal(9,6)")).cast("decimal(18,2)")
    )
    return (
        cases(spark, sf_dir)
        .where(F.col("portfolio_id") != "PF_24")
        .groupBy("portfolio_id")
        .agg(price.alias("purchase_price"), face.cast("decimal(18,2)").alias("gross_face_value"))
        .withColumn(
            "purchase_date",
            F.date_add(
                _date("1996-01-01"), F.expr("substring(portfolio_id, 4)").cast("int") * 20
            ),
        )
        .select("portfolio_id", "purchase_date", "purchase_price", "gross_face_value")
    )


def forecast_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative forecast for months 0 to 59; later months have none."""
    months = portfolios(spark, sf_dir).select(
        "portfolio_id", F.explode(F.sequence(F.lit(0), F.lit(59))).alias("months_on_book")
    )
    pct = (F.col("months_on_book") + 1) * F.lit("0.012500").cast("decimal(9,6)")
    return months.withColumn("forecast_pct", pct.cast("decimal(9,6)"))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two contract versions per client; MACHINERY starts mid-month, FURNITURE has no target."""
    clients = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("client_id"))
    start = F.when(F.col("client_id") == "MACHINERY", _date("1997-01-15")).otherwise(
        _date("1990-01-01")
    )
    change = _date("1998-06-10")
    versions = F.array(
        F.struct(
            F.lit("0.150000").cast("decimal(9,6)").alias("rate"),
            F.lit(30).alias("days"),
            start.alias("valid_from"),
            change.alias("valid_to"),
        ),
        F.struct(
            F.lit("0.100000").cast("decimal(9,6)").alias("rate"),
            F.lit(20).alias("days"),
            change.alias("valid_from"),
            F.lit(None).cast("date").alias("valid_to"),
        ),
    )
    return (
        clients.distinct()
        .select("client_id", F.explode(versions).alias("v"))
        .select(
            "client_id",
            F.col("v.rate").alias("commission_rate"),
            F.when(F.col("client_id") != "FURNITURE", F.col("v.days")).alias("sla_target_days"),
            F.col("v.valid_from").alias("valid_from"),
            F.col("v.valid_to").alias("valid_to"),
        )
    )


def debtors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data with NULL, blank, padded and too-short values."""
    key = F.col("c_custkey")
    identity = zero_padded((key * 7919).cast("string"), 11)
    national_id = (
        F.when(key % 20 == 0, F.lit(None).cast("string"))
        .when(key % 20 == 1, "   ")
        .when(key % 20 == 2, F.concat(F.lit(" "), identity, F.lit(" ")))
        .otherwise(identity)
    )
    email = F.when(
        key % 10 != 4, F.concat(F.lit("Debtor"), key.cast("string"), F.lit("@Example.invalid"))
    )
    phone = F.when(key % 50 == 9, "12").otherwise(
        F.concat(F.lit("+48 "), zero_padded(((key * 104729) % 1000000000).cast("string"), 9))
    )
    return table(spark, sf_dir, "customer").select(
        key.alias("debtor_key"),
        national_id.alias("national_id"),
        F.col("c_name").alias("debtor_name"),
        email.alias("debtor_email"),
        phone.alias("debtor_phone"),
        F.concat(F.lit("Street "), key.cast("string")).alias("debtor_address"),
        zero_padded((key % 100).cast("string"), 2).alias("postcode_area"),
    )


def cases_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases plus an exact re-send of 2 %."""
    copies = F.when(case_number() % 50 == 0, 2).otherwise(1)
    return (
        cases(spark, sf_dir)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
        .drop("_copy")
    )


def cases_with_debtors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases_raw(spark, sf_dir).join(debtors(spark, sf_dir), "debtor_key")


def bronze_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-sent cases as originators send them: text only, some values unreadable."""
    number = case_number()
    return cases_with_debtors(spark, sf_dir).select(
        "case_reference",
        "portfolio_id",
        "national_id",
        "debtor_name",
        "debtor_email",
        "debtor_phone",
        "debtor_address",
        "postcode_area",
        F.lit(None).cast("string").alias("date_of_birth"),
        F.col("original_balance").cast("string").alias("original_balance"),
        F.when(number % 700 == 11, "n/a")
        .otherwise(F.col("current_balance").cast("string"))
        .alias("current_balance"),
        F.when(number % 900 == 17, "2001-13-45")
        .otherwise(F.col("default_date").cast("string"))
        .alias("default_date"),
        F.lit("CONSUMER_LOAN").alias("product_type"),
        "currency",
    )


def cases_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 % of the rows on one portfolio, 1 % on NULL."""
    number = case_number()
    portfolio = (
        F.when(number % 10 < 4, F.lit("PF_00"))
        .when(number % 100 == 77, F.lit(None).cast("string"))
        .otherwise(F.col("portfolio_id"))
    )
    return cases(spark, sf_dir).select(
        "case_reference", portfolio.alias("portfolio_id"), "original_balance"
    )


def case_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid-time history of each case: placed until contacted, then contacted."""
    placed, contact = F.col("placed_date"), F.col("first_contact_date")
    still_open = F.lit(None).cast("date")

    def version(stage: str, start: Column, end: Column) -> Column:
        return F.struct(
            F.lit(stage).alias("stage"), start.alias("valid_from"), end.alias("valid_to")
        )

    history = F.array_compact(
        F.array(
            F.when(contact.isNull() | (contact > placed), version("placed", placed, contact)),
            F.when(contact.isNotNull(), version("contacted", contact, still_open)),
        )
    )
    return (
        cases(spark, sf_dir)
        .select("case_reference", "portfolio_id", F.explode(history).alias("v"))
        .select("case_reference", "portfolio_id", "v.*")
    )
