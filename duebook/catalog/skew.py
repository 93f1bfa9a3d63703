"""Queries: skew measurement, salted join and salted aggregate."""

from __future__ import annotations

from pyspark.sql import functions as F

from duebook import fixtures as fx
from duebook.catalog.registry import money, query
from duebook.operators import skew
from duebook.oracles import over_views


@query(
    over_views(
        """
SELECT portfolio_id, count(*) AS rows,
       round(count(*) / (SELECT count(*) FROM v_cases_skewed)::DOUBLE, 6) AS share
FROM v_cases_skewed GROUP BY portfolio_id
ORDER BY rows DESC, portfolio_id ASC NULLS FIRST LIMIT 10"""
    )
)
def measure_skew(spark, sf):
    top = skew.measure_skew(fx.cases_skewed(spark, sf), "portfolio_id")
    return top.withColumn("share", F.round("share", 6))


@query(
    over_views(
        """
SELECT k.case_reference, k.portfolio_id, k.original_balance, f.gross_face_value
FROM v_cases_skewed k JOIN v_portfolios f ON k.portfolio_id = f.portfolio_id"""
    )
)
def salted_join(spark, sf):
    portfolios = fx.portfolios(spark, sf).select("portfolio_id", "gross_face_value")
    return skew.salted_join(
        fx.cases_skewed(spark, sf), portfolios, "portfolio_id", by=["case_reference"], least_share=0.1
    )


@query(
    over_views(
        """
SELECT portfolio_id, count(*) AS rows, round(count(*) / any_value(n)::DOUBLE, 6) AS share
FROM v_cases_skewed, (SELECT count(portfolio_id) AS n FROM v_cases_skewed)
WHERE portfolio_id IS NOT NULL GROUP BY portfolio_id HAVING count(*) >= 0.024 * any_value(n)"""
    )
)
def hot_keys(spark, sf):
    """Portfolios with 2.4 % of the cases and more, found by a sketch and counted exactly."""
    found = skew.hot_keys(fx.cases_skewed(spark, sf), "portfolio_id", 0.024)
    return found.withColumn("share", F.round("share", 6))


@query(
    over_views(
        """
SELECT portfolio_id, CAST(sum(original_balance) AS DECIMAL(18,2)) AS original_balance_sum,
       count(original_balance) AS original_balance_count,
       min(original_balance) AS original_balance_min, max(original_balance) AS original_balance_max,
       round(sum(original_balance)::DOUBLE / count(original_balance), 2) AS original_balance_avg
FROM v_cases_skewed GROUP BY portfolio_id"""
    )
)
def aggregate_skewed(spark, sf):
    out = skew.aggregate_skewed(fx.cases_skewed(spark, sf), "portfolio_id", "original_balance")
    average = F.round(F.col("original_balance_avg").cast("double"), 2)
    return money(out, "original_balance_sum").withColumn("original_balance_avg", average)
