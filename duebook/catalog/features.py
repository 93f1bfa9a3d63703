"""Queries: payment history, point-in-time features, labels, training sets, the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from duebook import fixtures as fx
from duebook.catalog.registry import (
    BACKFILL_DATES,
    FEATURES_AS_OF,
    bucketed_silver,
    money,
    query,
)
from duebook.operators.defects import generate_payments as make_payments
from duebook.operators.defects import inject_defects as plant_defects
from duebook.oracles import over_views
from duebook.plans import features, model
from duebook.sources.storage import stage

AS_OF = f"DATE '{FEATURES_AS_OF}'"


def _cases(spark, sf):
    return fx.cases(spark, sf).select("case_reference", "portfolio_id")


def _six_digits(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


GAPS = """
SELECT *, lag(payment_date) OVER (PARTITION BY case_reference ORDER BY payment_date, payment_id)
       AS prev_payment_date
FROM v_payments"""


@query(
    over_views(
        """
SELECT payment_id, case_reference, payment_date, prev_payment_date,
       CAST(date_diff('day', prev_payment_date, payment_date) AS INT) AS gap_days FROM g""",
        ("g", GAPS),
    )
)
def payment_gaps(spark, sf):
    return features.payment_gaps(fx.payments(spark, sf)).drop("amount", "channel")


@query(
    over_views(
        """
SELECT case_reference, round(avg(date_diff('day', prev_payment_date, payment_date)), 6)
         AS avg_days_between_payments,
       round(stddev_samp(date_diff('day', prev_payment_date, payment_date)), 6)
         AS stddev_days_between_payments
FROM g GROUP BY case_reference""",
        ("g", GAPS),
    )
)
def payment_gap_stats(spark, sf):
    out = features.gap_statistics(fx.payments(spark, sf))
    return _six_digits(out, "avg_days_between_payments", "stddev_days_between_payments")


@query(
    over_views(
        f"""
SELECT case_reference,
       CAST(sum(CASE WHEN payment_date >= {AS_OF} - 30 THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS amount_paid_30d,
       CAST(sum(CASE WHEN payment_date >= {AS_OF} - 90 THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS amount_paid_90d
FROM v_payments WHERE payment_date < {AS_OF} GROUP BY case_reference"""
    )
)
def trailing_window_sums(spark, sf):
    out = features.trailing_sums(fx.payments(spark, sf), FEATURES_AS_OF)
    return money(out, "amount_paid_30d", "amount_paid_90d")


@query(
    over_views(
        """
SELECT case_reference, count(DISTINCT date_trunc('month', payment_date)) AS distinct_months_paid
FROM v_payments GROUP BY case_reference"""
    )
)
def distinct_months_paid(spark, sf):
    return features.distinct_months_paid(fx.payments(spark, sf))


@query(
    over_views(
        f"""
SELECT k.case_reference, k.portfolio_id, {AS_OF} AS as_of_date, t.payment_count,
       CAST(t.total_paid AS DECIMAL(18,2)) AS total_paid, t.last_payment_date
FROM v_cases k LEFT JOIN (
  SELECT case_reference, count(*) AS payment_count, sum(amount) AS total_paid,
         max(payment_date) AS last_payment_date
  FROM v_payments GROUP BY case_reference) t ON k.case_reference = t.case_reference"""
    )
)
def features_naive(spark, sf):
    out = features.features_naive(fx.payments(spark, sf), _cases(spark, sf), FEATURES_AS_OF)
    return money(out, "total_paid")


def _dates(days) -> str:
    return ", ".join(f"(DATE '{d}')" for d in days)


def _training_sql(days, label: bool) -> str:
    """Features per case and day, straight from the definition."""
    shown_label = ", coalesce(l.paid, 0) > 0 AS label_paid_90d" if label else ""
    return over_views(
        f"""
SELECT k.case_reference, k.portfolio_id, d.as_of_date,
       coalesce(a.n, 0) AS payments_count_lifetime,
       CAST(coalesce(a.total, 0) AS DECIMAL(18,2)) AS amount_paid_lifetime,
       a.last_payment_date,
       CAST(coalesce(a.paid_30, 0) AS DECIMAL(18,2)) AS amount_paid_30d,
       CAST(coalesce(a.paid_90, 0) AS DECIMAL(18,2)) AS amount_paid_90d,
       coalesce(a.months, 0) AS distinct_months_paid,
       round(a.gap_avg, 6) AS avg_days_between_payments,
       round(a.gap_sd, 6) AS stddev_days_between_payments,
       CAST(date_diff('day', a.last_payment_date, d.as_of_date) AS INT) AS days_since_last_payment,
       coalesce(a.n, 0) > 0 AS has_ever_paid{shown_label}
FROM v_cases k CROSS JOIN days d
LEFT JOIN history a ON a.case_reference = k.case_reference AND a.as_of_date = d.as_of_date
LEFT JOIN horizon l ON l.case_reference = k.case_reference AND l.as_of_date = d.as_of_date""",
        ("days", f"SELECT * FROM (VALUES {_dates(days)}) t(as_of_date)"),
        ("g", GAPS),
        (
            "history",
            """
SELECT g.case_reference, d.as_of_date, count(*) AS n, sum(g.amount) AS total,
       max(g.payment_date) AS last_payment_date,
       sum(CASE WHEN g.payment_date >= d.as_of_date - 30 THEN g.amount ELSE 0 END) AS paid_30,
       sum(CASE WHEN g.payment_date >= d.as_of_date - 90 THEN g.amount ELSE 0 END) AS paid_90,
       count(DISTINCT date_trunc('month', g.payment_date)) AS months,
       avg(date_diff('day', g.prev_payment_date, g.payment_date)) AS gap_avg,
       stddev_samp(date_diff('day', g.prev_payment_date, g.payment_date)) AS gap_sd
FROM g JOIN days d ON g.payment_date < d.as_of_date GROUP BY ALL""",
        ),
        (
            "horizon",
            """
SELECT p.case_reference, d.as_of_date, sum(p.amount) AS paid
FROM v_payments p JOIN days d
  ON p.payment_date >= d.as_of_date AND p.payment_date < d.as_of_date + 90 GROUP BY ALL""",
        ),
    )


def _shown(out):
    out = money(out, "amount_paid_lifetime", "amount_paid_30d", "amount_paid_90d")
    return _six_digits(out, "avg_days_between_payments", "stddev_days_between_payments")


@query(_training_sql([FEATURES_AS_OF], label=False))
def features_pit(spark, sf):
    return _shown(
        features.features_pit(fx.payments(spark, sf), _cases(spark, sf), FEATURES_AS_OF)
    )


@query(_training_sql([FEATURES_AS_OF], label=False))
def features_from_buckets(spark, sf):
    """The same features from silver tables in buckets of a case, without a shuffle."""
    silver = bucketed_silver(spark, sf)
    cases = silver["cases"].select("case_reference", "portfolio_id")
    return _shown(features.features_pit(silver["payments"], cases, FEATURES_AS_OF))


@query(
    over_views(
        f"""
SELECT k.case_reference, {AS_OF} AS as_of_date, coalesce(p.paid, 0) > 0 AS label_paid_90d
FROM v_cases k LEFT JOIN (SELECT case_reference, sum(amount) AS paid FROM v_payments
  WHERE payment_date >= {AS_OF} AND payment_date < {AS_OF} + 90 GROUP BY 1) p
  ON k.case_reference = p.case_reference"""
    )
)
def label_90d(spark, sf):
    return features.forward_label(fx.payments(spark, sf), _cases(spark, sf), FEATURES_AS_OF)


@query(_training_sql([FEATURES_AS_OF], label=True))
def training_set(spark, sf):
    return _shown(
        features.training_set(fx.payments(spark, sf), _cases(spark, sf), FEATURES_AS_OF)
    )


def _backfill(spark, sf):
    return features.training_set_backfill(
        fx.payments(spark, sf), _cases(spark, sf), BACKFILL_DATES
    )


@query(_training_sql(BACKFILL_DATES, label=True))
def training_set_backfill(spark, sf):
    return _shown(_backfill(spark, sf))


@query(
    over_views(
        f"""
SELECT 'point_in_time' AS build, CAST(0 AS BIGINT) AS rows_added, CAST(0 AS BIGINT) AS rows_removed
UNION ALL
SELECT 'naive', count(*), count(*) FROM v_cases WHERE case_reference IN (
  SELECT case_reference FROM v_payments WHERE payment_date >= {AS_OF})"""
    )
)
def leakage_check(spark, sf):
    return features.leakage_check(fx.payments(spark, sf), _cases(spark, sf), FEATURES_AS_OF)


@query(
    over_views(
        f"""
SELECT CASE WHEN d.as_of_date < {AS_OF} THEN 'train' ELSE 'test' END AS part, d.as_of_date,
       count(*) AS n_cases, count(*) FILTER (l.paid > 0) AS n_paid
FROM v_cases k CROSS JOIN days d
LEFT JOIN (SELECT p.case_reference, d.as_of_date, sum(p.amount) AS paid
           FROM v_payments p JOIN days d
             ON p.payment_date >= d.as_of_date AND p.payment_date < d.as_of_date + 90
           GROUP BY ALL) l ON l.case_reference = k.case_reference AND l.as_of_date = d.as_of_date
GROUP BY ALL""",
        ("days", f"SELECT * FROM (VALUES {_dates(BACKFILL_DATES)}) t(as_of_date)"),
    )
)
def temporal_split(spark, sf):
    train, test = model.temporal_split(_backfill(spark, sf), FEATURES_AS_OF)
    parts = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    return parts.groupBy("part", "as_of_date").agg(
        F.count(F.lit(1)).alias("n_cases"), F.count_if(features.LABEL).alias("n_paid")
    )


@query(
    over_views(
        f"""
SELECT count(*) FILTER (as_of_date < {AS_OF}) AS train_rows,
       count(*) FILTER (as_of_date >= {AS_OF}) AS test_rows,
       count(*) FILTER (as_of_date < {AS_OF} AND paid) AS train_paid,
       count(*) FILTER (as_of_date >= {AS_OF} AND paid) AS test_paid,
       true AS better_than_chance, true AS gate_follows_auc
FROM (SELECT d.as_of_date, coalesce(l.paid > 0, false) AS paid
      FROM v_cases k CROSS JOIN days d
      LEFT JOIN (SELECT p.case_reference, d.as_of_date, sum(p.amount) AS paid
                 FROM v_payments p JOIN days d
                   ON p.payment_date >= d.as_of_date AND p.payment_date < d.as_of_date + 90
                 GROUP BY ALL) l
        ON l.case_reference = k.case_reference AND l.as_of_date = d.as_of_date)""",
        ("days", f"SELECT * FROM (VALUES {_dates(BACKFILL_DATES)}) t(as_of_date)"),
    )
)
def train_propensity(spark, sf):
    """Training reads its table many times, so it is written first, one folder per day.

    The score itself is the trees' affair; SQL states the rows and the paying cases of each part.
    """
    written = stage(_backfill(spark, sf), "training", ["as_of_date"])
    fitted = model.train_propensity(written, FEATURES_AS_OF)
    paid = written.agg(
        F.count_if(F.col(features.LABEL) & (F.col("as_of_date") < F.lit(FEATURES_AS_OF))),
        F.count_if(F.col(features.LABEL) & (F.col("as_of_date") >= F.lit(FEATURES_AS_OF))),
    ).first()
    gate = fitted.looks_leaky == (fitted.auc > model.SUSPICIOUS_AUC)
    row = (fitted.train_rows, fitted.test_rows, *paid, 0.5 < fitted.auc <= 1, gate)
    return spark.createDataFrame(
        [row],
        "train_rows bigint, test_rows bigint, train_paid bigint, test_paid bigint, "
        "better_than_chance boolean, gate_follows_auc boolean",
    )


def _part(digest: str, part: int) -> str:
    return f"CAST('0x' || substr({digest}, {1 + 7 * part}, 7) AS BIGINT)"


@query(
    over_views(
        f"""
SELECT case_reference,
       CASE WHEN {_part('one', 0)} % 10000 < 4000 THEN 'PORTFOLIO_000' ELSE portfolio_id END AS portfolio_id,
       CASE WHEN {_part('one', 1)} % 10000 >= 500 THEN national_id END AS national_id,
       CASE WHEN {_part('one', 2)} % 10000 >= 1000 THEN debtor_email END AS debtor_email,
       original_balance,
       CAST(CASE WHEN {_part('one', 3)} % 10000 < 100 THEN original_balance * 100 ELSE current_balance END
            + surcharge AS DECIMAL(18,2)) AS current_balance,
       CASE WHEN {_part('two', 0)} % 10000 < 50 THEN DATE '1970-01-01' ELSE default_date END AS default_date,
       CASE WHEN {_part('two', 1)} % 10000 < 20 THEN 'XXX' ELSE currency END AS currency
FROM k JOIN (VALUES ('first', 0), ('copy', 0), ('near', 1)) c(kind, surcharge)
  ON kind = 'first' OR (kind = 'copy' AND {_part('two', 2)} % 10000 < 200)
     OR (kind = 'near' AND {_part('two', 3)} % 10000 < 100)""",
        (
            "k",
            """
SELECT *, md5('a:' || case_reference) AS one, md5('b:' || case_reference) AS two
FROM v_cases JOIN v_debtors USING (debtor_key)""",
        ),
    )
)
def inject_defects(spark, sf):
    clean = fx.cases(spark, sf).join(fx.debtors(spark, sf), "debtor_key")
    return plant_defects(
        clean.select(
            "case_reference", "portfolio_id", "national_id", "debtor_email", "original_balance",
            "current_balance", "default_date", "currency",
        )
    )


@query(
    over_views(
        f"""
SELECT payment_id, case_reference,
       default_date + CAST(CASE WHEN {_part('digest', 1)} % 10000 < 300
         THEN -1 - ({_part('digest', 0)} % 900) % 60 ELSE {_part('digest', 0)} % 900 END AS INT) AS payment_date,
       CAST(CAST(1000 + {_part('digest', 2)} % 80000 AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2)) AS amount,
       CASE {_part('digest', 3)} % 3 WHEN 0 THEN 'BANK_TRANSFER' WHEN 1 THEN 'CARD'
            ELSE 'DIRECT_DEBIT' END AS channel
FROM (SELECT *, case_reference || '_P' || CAST(n AS VARCHAR) AS payment_id,
             md5(case_reference || '_P' || CAST(n AS VARCHAR)) AS digest
      FROM (SELECT case_reference, default_date,
                   unnest(range(1, {_part("md5('n:' || case_reference)", 0)} % 6 + 2)) AS n
            FROM v_cases))"""
    )
)
def generate_payments(spark, sf):
    return make_payments(fx.cases(spark, sf))
