"""Queries: data-quality rules, deduplication, table checks."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook import fixtures as fx
from duebook.catalog.facts import _servicing
from duebook.catalog.registry import RULES_AS_OF, query
from duebook.contracts import INVESTING_FACT, SERVICING_FACT, conform
from duebook.operators import health
from duebook.operators.quality import (
    FAILURES,
    Rule,
    apply_rules,
    case_rules,
    dedupe_latest,
    error_rate,
    flag_failures,
    observed_metrics,
    payment_rules,
    rule_metrics,
    split,
)
from duebook.oracles import SERVICING_SELECT, over_views
from duebook.plans import facts
from duebook.plans.ingest import silver_cases as type_and_flag
from duebook.plans.ingest import trusted_metrics
from duebook.plans.publish import publish_fact
from duebook.sources.storage import (
    changed_partitions,
    refresh_digests,
    replace_partition,
    shared_folder,
    stage,
    staged,
    total_fingerprint,
)
from duebook.sources.storage import snapshot_fingerprint as fingerprint
from duebook.sources.upsert import upsert

CASES_WITH_DEBTORS = "SELECT * FROM v_cases_raw JOIN v_debtors USING (debtor_key)"

CASE_FAILURES = """
SELECT *, concat_ws(',',
  CASE WHEN case_reference IS NULL OR length(trim(case_reference)) = 0 THEN 'case_reference_present' END,
  CASE WHEN NOT coalesce(current_balance >= 0, false) THEN 'balance_non_negative' END,
  CASE WHEN NOT coalesce(current_balance <= original_balance * 3, false) THEN 'balance_not_above_original' END,
  CASE WHEN NOT coalesce(currency IN ('PLN', 'EUR', 'SEK', 'GBP'), false) THEN 'currency_supported' END,
  CASE WHEN NOT coalesce(default_date <= DATE '2002-01-01', false) THEN 'default_date_not_future' END,
  CASE WHEN national_id IS NULL AND debtor_email IS NULL AND debtor_phone IS NULL
       THEN 'national_id_or_contact_present' END) AS failures,
  case_reference IS NULL OR length(trim(case_reference)) = 0
  OR NOT coalesce(current_balance >= 0, false)
  OR NOT coalesce(currency IN ('PLN', 'EUR', 'SEK', 'GBP'), false)
  OR NOT coalesce(default_date <= DATE '2002-01-01', false) AS rejected
FROM k"""

_JUDGED = (("k", CASES_WITH_DEBTORS), ("judged", CASE_FAILURES))
PERSONAL = ("national_id", "debtor_name", "debtor_email", "debtor_phone", "debtor_address")
_SHOWN = "case_reference, current_balance, currency, default_date, failures"


def _shown(df):
    return df.withColumn("failures", F.concat_ws(",", FAILURES)).select(*_SHOWN.split(", "))


def _judged(spark, sf):
    return flag_failures(fx.cases_with_debtors(spark, sf), case_rules(RULES_AS_OF))


@query(over_views(f"SELECT {_SHOWN} FROM judged", *_JUDGED))
def dq_evaluate(spark, sf):
    return _shown(_judged(spark, sf))


@query(over_views(f"SELECT {_SHOWN} FROM judged WHERE NOT rejected", *_JUDGED))
def dq_clean(spark, sf):
    return _shown(split(_judged(spark, sf))[0])


@query(over_views(f"SELECT {_SHOWN} FROM judged WHERE rejected", *_JUDGED))
def dq_quarantine(spark, sf):
    return _shown(split(_judged(spark, sf))[1])


@query(
    over_views(
        """
SELECT count(*) AS rows_total,
       count(*) FILTER (failures LIKE '%case_reference_present%') AS failed_case_reference_present,
       count(*) FILTER (failures LIKE '%balance_non_negative%') AS failed_balance_non_negative,
       count(*) FILTER (failures LIKE '%balance_not_above_original%') AS failed_balance_not_above_original,
       count(*) FILTER (failures LIKE '%currency_supported%') AS failed_currency_supported,
       count(*) FILTER (failures LIKE '%default_date_not_future%') AS failed_default_date_not_future,
       count(*) FILTER (failures LIKE '%national_id_or_contact_present%') AS failed_national_id_or_contact_present,
       count(*) FILTER (rejected) AS rows_quarantined
FROM judged""",
        *_JUDGED,
    )
)
def dq_metrics(spark, sf):
    return rule_metrics(fx.cases_with_debtors(spark, sf), case_rules(RULES_AS_OF))


@query(
    over_views(
        """
SELECT rows_total, rows_quarantined, rows_quarantined / rows_total AS rate, threshold,
       rows_quarantined / rows_total <= threshold AS passed,
       CASE WHEN rows_quarantined / rows_total <= threshold THEN '' ELSE 'above the limit' END AS reason
FROM (SELECT count(*) AS rows_total, count(*) FILTER (rejected) AS rows_quarantined FROM judged)
     CROSS JOIN (VALUES (CAST(0.001 AS DOUBLE)), (CAST(0.1 AS DOUBLE))) t(threshold)""",
        *_JUDGED,
    )
)
def dq_breaker(spark, sf):
    """The breaker's verdicts on what the job that wrote the judged cases observed."""
    rules = case_rules(RULES_AS_OF)
    rows, observed = observed_metrics(_judged(spark, sf), rules)
    metrics = trusted_metrics(observed, stage(rows.drop(*PERSONAL), "breaker"), rules)
    counts = spark.createDataFrame([(metrics["rows_total"], metrics["rows_quarantined"])], "rows_total long, rows_quarantined long")
    return error_rate(counts, 0.001).unionByName(error_rate(counts, 0.1))


@query(
    over_views(
        """
SELECT payment_id, payment_date, amount,
       amount > 0 AND payment_date <= DATE '2000-06-30' AS clean,
       concat_ws(',', CASE WHEN NOT coalesce(amount > 0, false) THEN 'payment_amount_positive' END,
         CASE WHEN NOT coalesce(payment_date <= DATE '2000-06-30', false) THEN 'payment_date_not_future' END,
         CASE WHEN NOT coalesce(payment_date >= DATE '2000-01-01', false) THEN 'payment_date_plausible' END)
       AS failures
FROM v_payments_raw"""
    )
)
def dq_payments(spark, sf):
    rules = payment_rules(RULES_AS_OF.replace(year=2000, month=6, day=30))
    flagged = flag_failures(fx.payments_raw(spark, sf), rules)
    return flagged.select(
        "payment_id",
        "payment_date",
        "amount",
        (~F.col("_dq_has_error")).alias("clean"),
        F.concat_ws(",", FAILURES).alias("failures"),
    )


@query(over_views("SELECT * FROM v_payments"), name="dedupe_latest")
def latest_payments(spark, sf):
    raw = fx.payments_raw(spark, sf).drop("line_no")
    return dedupe_latest(raw, ["payment_id"], ["payment_date", "amount", "channel"])


@query(
    over_views(
        """
SELECT case_reference, original_balance, TRY_CAST(balance_text AS DECIMAL(18,2)) AS current_balance,
       TRY_CAST(date_text AS DATE) AS default_date, currency,
       concat_ws(',',
         CASE WHEN balance_text IS NOT NULL AND TRY_CAST(balance_text AS DECIMAL(18,2)) IS NULL
              THEN 'current_balance_readable' END,
         CASE WHEN date_text IS NOT NULL AND TRY_CAST(date_text AS DATE) IS NULL
              THEN 'default_date_readable' END) AS failures
FROM (SELECT *, CASE WHEN CAST(substr(case_reference, 6) AS BIGINT) % 700 = 11 THEN 'n/a'
                     ELSE CAST(current_balance AS VARCHAR) END AS balance_text,
                CASE WHEN CAST(substr(case_reference, 6) AS BIGINT) % 900 = 17 THEN '2001-13-45'
                     ELSE CAST(default_date AS VARCHAR) END AS date_text FROM v_cases_raw)"""
    )
)
def silver_cases(spark, sf):
    typed = type_and_flag(fx.bronze_cases(spark, sf))
    return typed.select(
        "case_reference",
        "original_balance",
        "current_balance",
        "default_date",
        "currency",
        F.concat_ws(",", FAILURES).alias("failures"),
    )


@query(
    over_views(
        "SELECT case_reference, count(*) AS rows FROM v_cases_raw GROUP BY 1 HAVING count(*) > 1"
    )
)
def check_grain_unique(spark, sf):
    return health.duplicate_keys(fx.cases_raw(spark, sf), ["case_reference"])


@query(
    over_views(
        """
SELECT count(*) FILTER (original_balance < 0 OR current_balance < 0) AS rows_negative
FROM v_cases_raw"""
    )
)
def check_no_negative_money(spark, sf):
    return health.negative_money(
        fx.cases_raw(spark, sf), ["original_balance", "current_balance"]
    )


@query(
    over_views(
        """
SELECT 'cases' AS table_name, count(*) > 0 AS passed FROM v_cases
UNION ALL SELECT 'payments', count(*) > 0 FROM v_payments_raw
UNION ALL SELECT 'payments after 2100', count(*) > 0 FROM v_payments_raw
WHERE payment_date >= DATE '2100-01-01'"""
    )
)
def check_not_empty(spark, sf):
    raw = fx.payments_raw(spark, sf)
    tables = {
        "cases": fx.cases(spark, sf),
        "payments": raw,
        "payments after 2100": raw.where("payment_date >= DATE'2100-01-01'"),
    }
    rows = [(name, health.not_empty(df)) for name, df in tables.items()]
    return spark.createDataFrame(rows, "table_name string, passed boolean")


@query(
    over_views(
        """
SELECT * FROM (VALUES ('just loaded', true, true), ('day old', true, true), ('stale', true, false),
                      ('unstamped', false, false)) t(table_name, loaded, fresh)
WHERE EXISTS (SELECT 1 FROM v_payments)"""
    )
)
def check_freshness(spark, sf):
    """The servicing fact as it is 1, 26 and 27 hours after its load, and without a load time."""
    loaded = datetime(2024, 7, 1, 6)
    fact = conform(_servicing(spark, sf), SERVICING_FACT, "batch-1").withColumn(
        "_ingested_at", F.lit(loaded)
    )
    seen = {
        "just loaded": (fact, 1),
        "day old": (fact, health.MAX_AGE_HOURS),
        "stale": (fact, health.MAX_AGE_HOURS + 1),
        "unstamped": (fact.drop("_ingested_at"), 1),
    }
    found = [
        health.freshness(df, now=loaded + timedelta(hours=hours)).select(
            F.lit(name).alias("table_name"),
            F.col("latest").isNotNull().alias("loaded"),
            F.coalesce(F.col("age_hours") <= health.MAX_AGE_HOURS, F.lit(False)).alias("fresh"),
        )
        for name, (df, hours) in seen.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    over_views(
        """
SELECT * FROM (VALUES
  ('investing', 'readable', true, ''), ('investing', 'not_empty', true, ''),
  ('investing', 'no_personal_data', true, ''), ('investing', 'fresh', true, ''),
  ('servicing', 'readable', true, ''), ('servicing', 'not_empty', true, ''),
  ('servicing', 'no_personal_data', true, ''), ('servicing', 'fresh', true, ''),
  ('unpublished', 'readable', false, 'no such table')
) t(table_name, check_name, passed, detail)
UNION ALL
SELECT 'investing', 'no_negative_money', count(*) = 0,
       CASE WHEN count(*) = 0 THEN '' ELSE concat(CAST(count(*) AS VARCHAR), ' rows are negative') END
FROM (SELECT portfolio_id, date_trunc('month', payment_date) AS mth, sum(amount) AS amt
      FROM v_payments JOIN v_cases USING (case_reference) GROUP BY ALL) WHERE amt < 0
UNION ALL
SELECT 'investing', 'grain_unique', count(*) = 0,
       CASE WHEN count(*) = 0 THEN '' ELSE concat(CAST(count(*) AS VARCHAR), ' keys are not unique') END
FROM (SELECT portfolio_id FROM v_portfolios GROUP BY 1 HAVING count(*) > 1)
UNION ALL
SELECT 'servicing', 'grain_unique', count(*) = 0,
       CASE WHEN count(*) = 0 THEN '' ELSE concat(CAST(count(*) AS VARCHAR), ' keys are not unique') END
FROM (SELECT client_id, case_reference, as_of_month FROM s GROUP BY ALL HAVING count(*) > 1)""",
        ("s", SERVICING_SELECT),
    )
)
def table_health(spark, sf):
    investing = facts.investing_performance(
        fx.payments(spark, sf),
        fx.cases(spark, sf),
        fx.portfolios(spark, sf),
        fx.forecast_curve(spark, sf),
    )
    folder = shared_folder(spark, "health")
    suffix = folder.rsplit("-", 1)[1]
    named = {name: f"{name}_{suffix}" for name in ("investing", "servicing")}
    servicing = _servicing(spark, sf)
    for name, df, contract in (
        ("investing", investing, INVESTING_FACT),
        ("servicing", servicing, SERVICING_FACT),
    ):
        publish_fact(
            df, contract, "batch-1", named[name], f"{named[name]}_quarantine", folder=folder
        )
    specs = [
        health.TableSpec(
            named["investing"], ("portfolio_id", "as_of_month"),
            ("erc_remaining", "collections_actual"),
        ),
        health.TableSpec(named["servicing"], ("client_id", "case_reference", "as_of_month")),
        health.TableSpec(f"unpublished_{suffix}", ("portfolio_id",)),
    ]
    return health.table_health(spark, specs).withColumn(
        "table_name", F.regexp_replace("table_name", f"_{suffix}$", "")
    )


_VALUES = ", ".join(
    f"coalesce(concat(length(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)), 'N')"
    for c in ("case_reference", "line_no", "payment_id", "payment_date", "amount", "channel")
)


@query(
    over_views(
        f"""
SELECT count(*) AS rows, concat_ws('-',
         CAST(sum(CAST(CAST('0x' || substr(digest, 1, 15) AS BIGINT) AS DECIMAL(38,0))) AS VARCHAR),
         CAST(sum(CAST(CAST('0x' || substr(digest, 16, 15) AS BIGINT) AS DECIMAL(38,0))) AS VARCHAR)
       ) AS content_hash, CAST(NULL AS VARCHAR) AS latest_batch
FROM (SELECT md5(concat_ws('|', {_VALUES})) AS digest FROM v_payments_raw)"""
    )
)
def snapshot_fingerprint(spark, sf):
    return fingerprint(fx.payments_raw(spark, sf))


_MONTHLY_VALUES = ", ".join(
    f"coalesce(concat(length(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)), 'N')"
    for c in ("payment_id", "case_reference", "payment_date", "amount", "channel", "payment_month")
)
_CHANGED = "payment_date >= DATE '1998-10-01'"


@query(
    over_views(
        f"""
SELECT scope, payment_month, count(*) AS rows, concat_ws('-',
         CAST(sum(CAST(CAST('0x' || substr(digest, 1, 15) AS BIGINT) AS DECIMAL(38,0))) AS VARCHAR),
         CAST(sum(CAST(CAST('0x' || substr(digest, 16, 15) AS BIGINT) AS DECIMAL(38,0))) AS VARCHAR)
       ) AS content_hash, any_value(change) AS change
FROM (SELECT scope, CASE WHEN scope = 'month' THEN payment_month END AS payment_month, digest,
             CASE WHEN scope = 'month' AND changed THEN 'changed' ELSE '' END AS change
      FROM (SELECT payment_month, changed, md5(concat_ws('|', {_MONTHLY_VALUES})) AS digest
            FROM (SELECT payment_id, case_reference, payment_date, channel,
                         CASE WHEN {_CHANGED} THEN CAST(amount + 1 AS DECIMAL(18,2)) ELSE amount END AS amount,
                         strftime(payment_date, '%Y-%m') AS payment_month, {_CHANGED} AS changed FROM v_payments))
           CROSS JOIN (VALUES ('month'), ('table')) t(scope))
GROUP BY scope, payment_month"""
    )
)
def digests_by_month(spark, sf):
    """Digests of monthly payments before and after corrections: only the corrected months are read again."""
    folder = shared_folder(spark, "digests")
    suffix = folder.rsplit("-", 1)[1]
    table, before, after = (f"{n}_{suffix}" for n in ("payments", "digests", "digests_after"))
    month = F.date_format("payment_date", "yyyy-MM")
    columns = ["payment_id", "case_reference", "payment_date", "amount", "channel"]
    payments = fx.payments(spark, sf).select(*columns, month.alias("payment_month"), F.lit(1).alias("arrived"))
    # the payments are one row a payment already
    upsert(payments, table, ["payment_id"], "payment_month", ["arrived"], f"{folder}/{table}", reduced=True)
    shown = f"{table}_shown"
    spark.table(table).drop("arrived").createOrReplaceTempView(shown)
    for name in (before, after):
        refresh_digests(spark, shown, name, "payment_month", path=f"{folder}/{name}")
    corrected = payments.where(_CHANGED).withColumns({"amount": F.col("amount") + 1, "arrived": F.lit(2)})
    corrected = corrected.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    with staged(corrected, "corrections") as rows:
        done = upsert(rows, table, ["payment_id"], "payment_month", ["arrived"], reduced=True)
    spark.table(table).drop("arrived").createOrReplaceTempView(shown)
    refresh_digests(spark, shown, after, "payment_month", done.partitions, path=f"{folder}/{after}")
    found = spark.table(after)
    changes = changed_partitions(spark.table(before), found, "payment_month")
    months = found.join(changes, "payment_month", "left").select(
        F.lit("month").alias("scope"),
        "payment_month",
        "rows",
        F.concat_ws("-", F.col("sum_0").cast("string"), F.col("sum_1").cast("string")).alias("content_hash"),
        F.coalesce("change", F.lit("")).alias("change"),
    )
    whole = total_fingerprint(found).select(
        F.lit("table").alias("scope"), F.lit(None).cast("string").alias("payment_month"), "rows", "content_hash",
        F.lit("").alias("change"),
    )
    return months.unionByName(whole)


@query(
    over_views(
        """
SELECT 'first' AS _batch_id, case_reference, 'large' AS failures
FROM v_cases WHERE original_balance < 100000
UNION ALL
SELECT 'second', case_reference, 'large' FROM v_cases WHERE original_balance < 200000"""
    )
)
def quarantine_append(spark, sf):
    """Two batches of rejects; the second is written twice and must not double."""
    folder = shared_folder(spark, "quarantine")
    table = "quarantine_" + folder.rsplit("-", 1)[1]
    cases = fx.cases(spark, sf).select("case_reference", "original_balance")
    for batch, least in (("first", 100_000), ("second", 200_000), ("second", 200_000)):
        _, rejected, _ = apply_rules(cases, [Rule("large", f"original_balance >= {least}")])
        replace_partition(rejected, table, "_batch_id", batch, path=folder)
    return spark.table(table).select(
        "_batch_id", "case_reference", F.concat_ws(",", FAILURES).alias("failures")
    )
