"""The two monthly facts. They differ in grain and share no measures beyond collections.

The investing fact joins payments to their cases first and then sums per portfolio and month: cases
rarely pay twice a month, so a sum per case and month before the join would shuffle the payments once
more and hardly reduce them. Adaptive execution splits the join where one case holds many payments,
because an exchange follows anyway. The servicing fact keeps the case in its grain, so there the sum
comes first: Spark combines it on the map side, and a case brings at most one row per month to the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.contracts import MONEY
from duebook.functions.dates import month_of, whole_months
from duebook.operators.joins import join_large, join_valid_version


def collections_by_case_month(payments: DataFrame) -> DataFrame:
    return payments.groupBy(
        "case_reference", month_of("payment_date").alias("as_of_month")
    ).agg(F.sum("amount").alias("collections_actual"))


def collections_by_portfolio_month(payments: DataFrame, cases: DataFrame) -> DataFrame:
    paid = payments.select("case_reference", month_of("payment_date").alias("as_of_month"), "amount")
    owned = cases.select("case_reference", "portfolio_id")
    return (
        join_large(paid, owned, "case_reference")
        .groupBy("portfolio_id", "as_of_month")
        .agg(F.sum("amount").alias("collections_actual"))
    )


def add_months_on_book(monthly: DataFrame, portfolios: DataFrame) -> DataFrame:
    """Age of the portfolio in months; months before the purchase are dropped, and so are
    portfolios without a row of their own (see :func:`unmatched_portfolios`)."""
    bought = portfolios.select(
        "portfolio_id", "purchase_date", "purchase_price", "gross_face_value"
    )
    age = whole_months(F.col("as_of_month"), F.col("purchase_date"))
    return (
        monthly.join(bought, "portfolio_id", "left")
        .withColumn("months_on_book", age)
        .where(F.col("months_on_book") >= 0)
    )


def unmatched_portfolios(monthly: DataFrame, portfolios: DataFrame) -> DataFrame:
    """Collections the investing fact leaves out because the portfolio is unknown."""
    return (
        monthly.join(portfolios.select("portfolio_id"), "portfolio_id", "left_anti")
        .groupBy("portfolio_id")
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.sum("collections_actual").alias("collections_actual"),
        )
    )


def running_collections(monthly: DataFrame) -> DataFrame:
    """Cumulative collections. The input has one row per portfolio and month, so a window
    partition is never longer than the life of a portfolio."""
    life = (
        Window.partitionBy("portfolio_id")
        .orderBy("as_of_month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return monthly.withColumn(
        "collections_cumulative", F.sum("collections_actual").over(life)
    )


def join_forecast(monthly: DataFrame, forecast_curve: DataFrame) -> DataFrame:
    curve = forecast_curve.select("portfolio_id", "months_on_book", "forecast_pct")
    return monthly.join(curve, ["portfolio_id", "months_on_book"], "left")


def _ratio(part: Column, whole: Column) -> Column:
    """NULL unless the denominator is positive; as wide as the division makes it."""
    return F.when(whole > 0, F.try_divide(part, whole))


def investing_performance(
    payments: DataFrame, cases: DataFrame, portfolios: DataFrame, forecast_curve: DataFrame
) -> DataFrame:
    """Owned portfolios by month: forecast, remaining collections, recovery, multiple.

    ``erc_remaining`` compares the cumulative collections with the share the curve expects
    *by that month*. It is floored at zero, and zero in months beyond the curve.

    Measures keep the width that the arithmetic gives them. :func:`duebook.contracts.conform` casts
    them and names what does not fit, so an outstanding amount too large for its type is a
    rejected row and never a finished portfolio.
    """
    monthly = collections_by_portfolio_month(payments, cases)
    aged = running_collections(add_months_on_book(monthly, portfolios))
    expected = F.col("gross_face_value") * F.col("forecast_pct")
    cumulative = F.col("collections_cumulative")
    zero = F.lit(0).cast(MONEY)
    remaining = F.greatest(zero, expected - cumulative)
    return join_forecast(aged, forecast_curve).select(
        "portfolio_id",
        "as_of_month",
        "months_on_book",
        "collections_actual",
        expected.alias("collections_forecast"),
        F.when(F.col("forecast_pct").isNull(), zero).otherwise(remaining).alias("erc_remaining"),
        _ratio(cumulative, F.col("gross_face_value")).alias("recovery_rate_to_date"),
        "purchase_price",
        _ratio(cumulative, F.col("purchase_price")).alias("money_multiple"),
    )


def sla_status(target_days: Column, actual_days: Column) -> Column:
    """PENDING until contacted; meeting the target on its last day is MET."""
    return (
        F.when(actual_days.isNull(), "PENDING")
        .when(actual_days <= target_days, "MET")
        .otherwise("BREACHED")
    )


def collections_by_client_case(
    payments: DataFrame, placements: DataFrame, priced_on: str = "as_of_month"
) -> DataFrame:
    """Collections per client, case and month (and pricing day, if that is finer)."""
    days = dict.fromkeys([priced_on, "as_of_month"])
    per_case = (
        payments.withColumn("as_of_month", month_of("payment_date"))
        .groupBy("case_reference", *days)
        .agg(F.sum("amount").alias("collections_actual"))
    )
    placed = placements.select(
        "case_reference", "client_id", "placed_date", "first_contact_date"
    )
    # Same hash partitioning as the join, so this second sum adds no shuffle. It only
    # merges rows when a case was placed twice with identical dates.
    return (
        join_large(per_case, placed, "case_reference")
        .groupBy("client_id", "case_reference", *days, "placed_date", "first_contact_date")
        .agg(F.sum("collections_actual").alias("collections_actual"))
    )


def servicing_performance(
    payments: DataFrame,
    placements: DataFrame,
    client_contracts: DataFrame,
    price_on: str = "month_start",
) -> DataFrame:
    """Serviced cases by client and month: commission and service level.

    ``price_on="month_start"`` applies the contract valid on the first of the payment month.
    ``price_on="payment_date"`` applies the one valid on each payment day, with one row per
    rate and target in months where the contract changed. A payment no contract covers keeps
    a NULL rate here; :func:`duebook.contracts.conform` sends it to quarantine.
    """
    priced_on = {"month_start": "as_of_month", "payment_date": "payment_date"}[price_on]
    collected = collections_by_client_case(payments, placements, priced_on)
    contract = client_contracts.select(
        "client_id", "commission_rate", "sla_target_days", "valid_from", "valid_to"
    )
    priced = join_valid_version(collected, contract, "client_id", priced_on)
    if priced_on != "as_of_month":
        grain = [c for c in priced.columns if c not in (priced_on, "collections_actual")]
        priced = priced.groupBy(*grain).agg(
            F.sum("collections_actual").alias("collections_actual")
        )
    actual_days = F.datediff("first_contact_date", "placed_date")
    return priced.select(
        "client_id",
        "case_reference",
        "as_of_month",
        "collections_actual",
        "commission_rate",
        (F.col("collections_actual") * F.col("commission_rate"))
        .try_cast(MONEY)
        .alias("commission_earned"),
        "sla_target_days",
        actual_days.alias("sla_actual_days"),
        sla_status(F.col("sla_target_days"), actual_days).alias("sla_met"),
    )
