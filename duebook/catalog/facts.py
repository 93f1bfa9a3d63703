"""Queries: joins, monthly aggregates and the two facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from duebook import fixtures as fx
from duebook.catalog.registry import bucketed_silver, money, query
from duebook.contracts import INVESTING_FACT, SERVICING_FACT, conform
from duebook.operators.joins import (
    as_of_slice,
    join_large,
    join_valid_version,
    join_version_by_month,
)
from duebook.operators.quality import FAILURES
from duebook.oracles import SERVICING_SELECT, over_views
from duebook.plans import facts

SLICE_DAY = date(1999, 1, 1)

PORTFOLIO_MONTHS = """
SELECT k.portfolio_id, CAST(date_trunc('month', p.payment_date) AS DATE) AS as_of_month,
       sum(p.amount) AS amt
FROM v_payments p JOIN v_cases k ON p.case_reference = k.case_reference GROUP BY ALL"""

CASE_MONTHS = """
SELECT k.client_id, k.case_reference, CAST(date_trunc('month', p.payment_date) AS DATE) AS as_of_month,
       k.placed_date, k.first_contact_date, sum(p.amount) AS amt
FROM v_payments p JOIN v_cases k ON p.case_reference = k.case_reference GROUP BY ALL"""

AGED_MONTHS = """
SELECT m.portfolio_id, m.as_of_month, m.amt, f.purchase_price, f.gross_face_value,
       CAST((year(m.as_of_month) - year(f.purchase_date)) * 12
            + month(m.as_of_month) - month(f.purchase_date) AS INT) AS months_on_book
FROM m JOIN v_portfolios f ON m.portfolio_id = f.portfolio_id
WHERE (year(m.as_of_month) - year(f.purchase_date)) * 12
      + month(m.as_of_month) - month(f.purchase_date) >= 0"""

RUNNING_MONTHS = """
SELECT *, sum(amt) OVER (PARTITION BY portfolio_id ORDER BY as_of_month
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
FROM aged"""

_INVESTING_STEPS = (("m", PORTFOLIO_MONTHS), ("aged", AGED_MONTHS), ("life", RUNNING_MONTHS))


def _portfolio_months(spark, sf):
    return facts.collections_by_portfolio_month(fx.payments(spark, sf), fx.cases(spark, sf))


def _aged_months(spark, sf):
    return facts.add_months_on_book(_portfolio_months(spark, sf), fx.portfolios(spark, sf))


@query(
    over_views(
        """
SELECT p.payment_id, p.case_reference, p.payment_date, p.amount, k.portfolio_id, k.client_id
FROM v_payments p JOIN v_cases k ON p.case_reference = k.case_reference"""
    )
)
def join_inner_equi(spark, sf):
    cases = fx.cases(spark, sf).select("case_reference", "portfolio_id", "client_id")
    return join_large(fx.payments(spark, sf).drop("channel"), cases, "case_reference")


@query(
    over_views(
        "SELECT portfolio_id, as_of_month, CAST(amt AS DECIMAL(18,2)) AS collections_actual FROM m",
        ("m", PORTFOLIO_MONTHS),
    )
)
def collections_by_portfolio_month(spark, sf):
    return money(_portfolio_months(spark, sf), "collections_actual")


@query(
    over_views(
        """
SELECT client_id, case_reference, as_of_month, placed_date, first_contact_date,
       CAST(amt AS DECIMAL(18,2)) AS collections_actual FROM m""",
        ("m", CASE_MONTHS),
    )
)
def collections_by_case_month(spark, sf):
    out = facts.collections_by_client_case(fx.payments(spark, sf), fx.cases(spark, sf))
    return money(out, "collections_actual")


@query(
    over_views(
        """
SELECT portfolio_id, as_of_month, months_on_book, CAST(amt AS DECIMAL(18,2)) AS collections_actual,
       CAST(cum AS DECIMAL(18,2)) AS collections_cumulative FROM life""",
        *_INVESTING_STEPS,
    )
)
def running_collections(spark, sf):
    out = facts.running_collections(_aged_months(spark, sf))
    return money(out, "collections_actual", "collections_cumulative").select(
        "portfolio_id", "as_of_month", "months_on_book", "collections_actual",
        "collections_cumulative",
    )


@query(
    over_views(
        """
SELECT a.portfolio_id, a.as_of_month, a.months_on_book, c.forecast_pct
FROM aged a LEFT JOIN v_curve c
  ON a.portfolio_id = c.portfolio_id AND a.months_on_book = c.months_on_book""",
        ("m", PORTFOLIO_MONTHS),
        ("aged", AGED_MONTHS),
    )
)
def join_left_multikey(spark, sf):
    return facts.join_forecast(_aged_months(spark, sf), fx.forecast_curve(spark, sf)).select(
        "portfolio_id", "as_of_month", "months_on_book", "forecast_pct"
    )


@query(
    over_views(
        """
SELECT l.portfolio_id, l.as_of_month, l.months_on_book,
       CAST(l.amt AS DECIMAL(18,2)) AS collections_actual,
       CAST(l.gross_face_value * c.forecast_pct AS DECIMAL(18,2)) AS collections_forecast,
       greatest(CAST(0 AS DECIMAL(18,2)),
                CAST(l.gross_face_value * c.forecast_pct - l.cum AS DECIMAL(18,2))) AS erc_remaining,
       CASE WHEN l.gross_face_value > 0 THEN CAST(l.cum / l.gross_face_value AS DECIMAL(9,6)) END
         AS recovery_rate_to_date,
       l.purchase_price,
       CASE WHEN l.purchase_price > 0 THEN CAST(l.cum / l.purchase_price AS DECIMAL(9,6)) END
         AS money_multiple
FROM life l LEFT JOIN v_curve c
  ON l.portfolio_id = c.portfolio_id AND l.months_on_book = c.months_on_book""",
        *_INVESTING_STEPS,
    )
)
def fct_investing(spark, sf):
    out = facts.investing_performance(
        fx.payments(spark, sf),
        fx.cases(spark, sf),
        fx.portfolios(spark, sf),
        fx.forecast_curve(spark, sf),
    )
    return conform(out, INVESTING_FACT, "batch-1").select(*out.columns)


@query(
    over_views(
        """
SELECT l.portfolio_id, l.as_of_month, concat_ws(',',
    CASE WHEN l.big AND 9000000000000000 * 2 * CAST(c.forecast_pct AS DOUBLE) >= 1e16
         THEN 'collections_forecast_fits_type' END,
    CASE WHEN l.big AND 9000000000000000 * 2 * CAST(c.forecast_pct AS DOUBLE) - CAST(l.cum AS DOUBLE) >= 1e16
         THEN 'erc_remaining_fits_type' END,
    CASE WHEN l.big AND CAST(l.cum AS DOUBLE) >= 1000 THEN 'money_multiple_fits_type' END) AS failures
FROM (SELECT *, portfolio_id = 'PF_01' AS big FROM life) l
LEFT JOIN v_curve c ON l.portfolio_id = c.portfolio_id AND l.months_on_book = c.months_on_book""",
        *_INVESTING_STEPS,
    )
)
def conform_investing(spark, sf):
    """PF_01 bought for 1.00 with a face value near the limit of its type: what no longer fits is
    named row by row, and nothing becomes zero or NULL without a name."""
    huge = F.col("portfolio_id") == "PF_01"
    money_type = "decimal(18,2)"
    portfolios = fx.portfolios(spark, sf).withColumns(
        {
            "gross_face_value": F.when(huge, F.lit("9000000000000000.00").cast(money_type))
            .otherwise(F.col("gross_face_value")).cast(money_type),
            "purchase_price": F.when(huge, F.lit("1.00").cast(money_type))
            .otherwise(F.col("purchase_price")).cast(money_type),
        }
    )
    pct = F.col("forecast_pct")
    curve = fx.forecast_curve(spark, sf).withColumn(
        "forecast_pct", F.when(huge, pct * 2).otherwise(pct).cast("decimal(9,6)")
    )
    out = facts.investing_performance(
        fx.payments(spark, sf), fx.cases(spark, sf), portfolios, curve
    )
    return conform(out, INVESTING_FACT, "batch-1").select(
        "portfolio_id", "as_of_month", F.concat_ws(",", FAILURES).alias("failures")
    )


@query(
    over_views(
        """
SELECT m.portfolio_id, count(*) AS months, CAST(sum(m.amt) AS DECIMAL(18,2)) AS collections_actual
FROM m ANTI JOIN v_portfolios f ON m.portfolio_id = f.portfolio_id GROUP BY m.portfolio_id""",
        ("m", PORTFOLIO_MONTHS),
    )
)
def unmatched_portfolios(spark, sf):
    out = facts.unmatched_portfolios(_portfolio_months(spark, sf), fx.portfolios(spark, sf))
    return money(out, "collections_actual")


SCD2_RATE_SQL = over_views(
    """
SELECT m.client_id, m.case_reference, m.as_of_month, c.commission_rate, c.sla_target_days
FROM m LEFT JOIN v_contracts c ON m.client_id = c.client_id AND c.valid_from <= m.as_of_month
     AND m.as_of_month < coalesce(c.valid_to, DATE '9999-12-31')""",
    ("m", CASE_MONTHS),
)


def _rated_months(spark, sf):
    months = facts.collections_by_client_case(fx.payments(spark, sf), fx.cases(spark, sf))
    return months.select("client_id", "case_reference", "as_of_month")


@query(SCD2_RATE_SQL)
def join_scd2_rate(spark, sf):
    return join_valid_version(
        _rated_months(spark, sf), fx.contracts(spark, sf), "client_id", "as_of_month"
    )


@query(SCD2_RATE_SQL)
def join_scd2_by_month(spark, sf):
    """The same answer by the way that large version tables take."""
    return join_version_by_month(
        _rated_months(spark, sf), fx.contracts(spark, sf), "client_id", "as_of_month"
    )


def _servicing(spark, sf, price_on="month_start"):
    return facts.servicing_performance(
        fx.payments(spark, sf), fx.cases(spark, sf), fx.contracts(spark, sf), price_on
    )


@query(over_views(SERVICING_SELECT))
def fct_servicing(spark, sf):
    return money(_servicing(spark, sf), "collections_actual")


@query(
    over_views(
        """
SELECT client_id, case_reference, as_of_month, CAST(sum(amount) AS DECIMAL(18,2)) AS collections_actual,
       commission_rate, CAST(sum(amount) * commission_rate AS DECIMAL(18,2)) AS commission_earned,
       sla_target_days, CAST(date_diff('day', placed_date, first_contact_date) AS INT) AS sla_actual_days,
       CASE WHEN first_contact_date IS NULL THEN 'PENDING'
            WHEN date_diff('day', placed_date, first_contact_date) <= sla_target_days THEN 'MET'
            ELSE 'BREACHED' END AS sla_met
FROM (SELECT k.client_id, k.case_reference, k.placed_date, k.first_contact_date, p.amount,
             CAST(date_trunc('month', p.payment_date) AS DATE) AS as_of_month,
             c.commission_rate, c.sla_target_days
      FROM v_payments p JOIN v_cases k ON p.case_reference = k.case_reference
      LEFT JOIN v_contracts c ON k.client_id = c.client_id AND c.valid_from <= p.payment_date
           AND p.payment_date < coalesce(c.valid_to, DATE '9999-12-31'))
GROUP BY client_id, case_reference, as_of_month, placed_date, first_contact_date,
         commission_rate, sla_target_days"""
    )
)
def fct_servicing_daily_rate(spark, sf):
    return money(_servicing(spark, sf, "payment_date"), "collections_actual")


@query(
    over_views(
        """
SELECT k.case_reference, k.client_id, c.sla_target_days,
       CAST(date_diff('day', k.placed_date, k.first_contact_date) AS INT) AS sla_actual_days,
       CASE WHEN k.first_contact_date IS NULL THEN 'PENDING'
            WHEN date_diff('day', k.placed_date, k.first_contact_date) <= c.sla_target_days THEN 'MET'
            ELSE 'BREACHED' END AS sla_met
FROM v_cases k LEFT JOIN v_contracts c ON k.client_id = c.client_id
     AND c.valid_from <= k.placed_date AND k.placed_date < coalesce(c.valid_to, DATE '9999-12-31')"""
    )
)
def sla_status(spark, sf):
    placed = fx.cases(spark, sf).select(
        "case_reference", "client_id", "placed_date", "first_contact_date"
    )
    days = F.datediff("first_contact_date", "placed_date")
    return join_valid_version(placed, fx.contracts(spark, sf), "client_id", "placed_date").select(
        "case_reference",
        "client_id",
        "sla_target_days",
        days.alias("sla_actual_days"),
        facts.sla_status(F.col("sla_target_days"), days).alias("sla_met"),
    )


CASE_VERSIONS = """
SELECT case_reference, portfolio_id, 'placed' AS stage, placed_date AS valid_from,
       first_contact_date AS valid_to
FROM v_cases WHERE first_contact_date IS NULL OR first_contact_date > placed_date
UNION ALL
SELECT case_reference, portfolio_id, 'contacted', first_contact_date, CAST(NULL AS DATE)
FROM v_cases WHERE first_contact_date IS NOT NULL"""


@query(
    over_views(
        """
SELECT case_reference, portfolio_id, stage, valid_from, valid_to FROM versions
WHERE valid_from <= DATE '1999-01-01' AND DATE '1999-01-01' < coalesce(valid_to, DATE '9999-12-31')""",
        ("versions", CASE_VERSIONS),
    )
)
def scd2_as_of_slice(spark, sf):
    return as_of_slice(fx.case_versions(spark, sf), SLICE_DAY)


@query(
    over_views(
        """
SELECT client_id, case_reference, as_of_month, collections_actual, commission_rate,
       commission_earned, sla_target_days, sla_actual_days, sla_met, 'batch-1' AS _batch_id,
       CASE WHEN commission_rate IS NULL THEN 'commission_rate_not_null,commission_earned_not_null'
            ELSE '' END AS failures
FROM s""",
        ("s", SERVICING_SELECT),
    )
)
def conform_contract(spark, sf):
    out = conform(_servicing(spark, sf), SERVICING_FACT, "batch-1")
    return out.withColumn("failures", F.concat_ws(",", FAILURES)).drop(
        "_ingested_at", FAILURES, "_dq_has_error"
    )


@query(over_views(SERVICING_SELECT))
def servicing_from_buckets(spark, sf):
    """The servicing fact from silver tables in buckets of a case: payments and placements are not shuffled."""
    silver = bucketed_silver(spark, sf)
    out = facts.servicing_performance(silver["payments"], silver["cases"], fx.contracts(spark, sf))
    return money(out, "collections_actual")
