"""Queries: landing CSV, malformed rows, drift, ingest, sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook import fixtures as fx
from duebook.catalog.privacy import last_four_sql, pseudonym_sql
from duebook.catalog.registry import PEPPER, RULES_AS_OF, query
from duebook.contracts import PAYMENTS, PLACEMENTS, RAW_CASES
from duebook.operators.quality import FAILURES
from duebook.oracles import over_views
from duebook.plans.ingest import ingest_cases as run_ingest
from duebook.plans.ingest import ingest_payments as run_payments
from duebook.plans.ingest import ingest_placements as run_placements
from duebook.sources import landing
from duebook.sources.storage import shared_folder, write_csv, write_table

COLUMNS = RAW_CASES.fieldNames()
NUMBER = "CAST(substr(case_reference, 6) AS BIGINT)"

BRONZE = f"""
SELECT case_reference, portfolio_id, national_id, debtor_name, debtor_email, debtor_phone,
       debtor_address, postcode_area, CAST(NULL AS VARCHAR) AS date_of_birth,
       CAST(original_balance AS VARCHAR) AS original_balance,
       CASE WHEN {NUMBER} % 700 = 11 THEN 'n/a' ELSE CAST(current_balance AS VARCHAR) END AS current_balance,
       CASE WHEN {NUMBER} % 900 = 17 THEN '2001-13-45' ELSE CAST(default_date AS VARCHAR) END AS default_date,
       'CONSUMER_LOAN' AS product_type, currency
FROM v_cases_raw JOIN v_debtors USING (debtor_key)"""

_LINE = " || ',' || ".join(f"coalesce({c}, '')" for c in COLUMNS)

LINES = f"""
SELECT *, CASE WHEN {NUMBER} % 97 = 3 THEN case_reference || ',' || portfolio_id
               WHEN {NUMBER} % 89 = 5 THEN {_LINE} || ',surplus' ELSE {_LINE} END AS line,
       {NUMBER} % 97 = 3 OR {NUMBER} % 89 = 5 AS broken
FROM bronze"""

_BROKEN_FEED = (("bronze", BRONZE), ("lines", LINES))


def _write_broken_feed(spark, sf):
    """Case files in which some lines have too few or too many fields."""
    number = fx.case_number()
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in COLUMNS])
    broken = (
        F.when(number % 97 == 3, F.concat_ws(",", "case_reference", "portfolio_id"))
        .when(number % 89 == 5, F.concat(line, F.lit(",surplus")))
        .otherwise(line)
    )
    path = shared_folder(spark, "landing")
    # One column whose name is the header line: the separator never occurs, so the lines
    # are written as they are, below a proper header in every file.
    (
        fx.bronze_cases(spark, sf)
        .select(broken.alias(",".join(COLUMNS)))
        .write.option("header", True)
        .option("sep", "\x01")
        .option("quote", "\x00")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


@query(over_views(f"SELECT *, 'batch-1' AS _batch_id FROM ({BRONZE})"))
def scan_landing_csv(spark, sf):
    path = shared_folder(spark, "landing")
    write_csv(fx.bronze_cases(spark, sf), path)
    landed = landing.read_landing(spark, path, RAW_CASES, "batch-1")
    readable, _ = landing.split_malformed(landed)
    return readable.drop("_ingested_at", "_source_file", "_arrived_at")


@query(
    over_views(
        """
SELECT case_reference, broken AS malformed, CASE WHEN broken THEN line END AS raw_line
FROM lines""",
        *_BROKEN_FEED,
    )
)
def capture_malformed_rows(spark, sf):
    landed = landing.read_landing(spark, _write_broken_feed(spark, sf), RAW_CASES, "batch-1")
    readable, malformed = landing.split_malformed(landed)
    shown = ["case_reference", "malformed", "raw_line"]
    good = readable.withColumns(
        {"malformed": F.lit(False), "raw_line": F.lit(None).cast("string")}
    )
    bad = malformed.withColumns({"malformed": F.lit(True), "raw_line": F.col(landing.CORRUPT)})
    return good.select(*shown).unionByName(bad.select(*shown))


@query(
    over_views(
        f"""
SELECT case_reference, 'batch-1' AS _batch_id, true AS has_time, true AS has_file
FROM ({BRONZE})"""
    )
)
def audit_columns(spark, sf):
    """Load time and file name differ in every run, so only their presence is shown."""
    path = shared_folder(spark, "landing")
    write_csv(fx.bronze_cases(spark, sf), path)
    landed = landing.read_landing(spark, path, RAW_CASES, "batch-1")
    recent = F.current_timestamp() - F.expr("INTERVAL 1 HOUR")
    return landed.select(
        "case_reference",
        "_batch_id",
        (F.col("_ingested_at") > recent).alias("has_time"),
        F.col("_source_file").rlike("/landing-[0-9a-f]+/part-.*[.]csv$").alias("has_file"),
    )


FEED_OF = {0: "unchanged", 1: "additive", 2: "missing", 3: "rename", 4: "type_change"}


@query(
    over_views(
        f"""
SELECT d.feed, d.change, d.column_name, d.expected_type, d.found_type, d.refused, n.rows
FROM (VALUES ('additive', 'added', 'originator_score', NULL, 'string', false, 1),
             ('missing', 'missing', 'currency', 'string', NULL, true, 2),
             ('rename', 'added', 'debtor_mobile', NULL, 'string', true, 3),
             ('rename', 'missing', 'debtor_phone', 'string', NULL, true, 3),
             ('type_change', 'type_changed', 'current_balance', 'string', 'decimal(18,2)', true, 4))
     d(feed, change, column_name, expected_type, found_type, refused, bucket)
JOIN (SELECT {NUMBER} % 5 AS bucket, count(*) AS rows FROM v_cases_raw GROUP BY 1) n
  ON d.bucket = n.bucket"""
    )
)
def schema_drift_report(spark, sf):
    """Five originators, each with its own kind of drift, and the rows that arrive with it.

    Text files show drift of names in their headers; drift of types shows in a typed file.
    """
    bronze = fx.bronze_cases(spark, sf)
    folder = shared_folder(spark, "feeds")
    text_feeds, counts = {}, []
    for bucket, kind in FEED_OF.items():
        rows = bronze.where(fx.case_number() % 5 == bucket)
        feed = rows if kind == "unchanged" else landing.drift_variant(rows, kind)
        path = f"{folder}/{kind}"
        if kind == "type_change":
            feed.write.parquet(path)
            written = spark.read.parquet(path)
            changes = landing.schema_changes(written.schema, RAW_CASES)
            typed = [(kind, *c, bool(landing.refused([c]))) for c in changes]
        else:
            write_csv(feed, path)
            text_feeds[kind] = path
            scans = [scan.select(landing.CORRUPT, scan.columns[0]) for _, scan in landing.scans_by_header(spark, path)]
            written = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
        counts.append(
            written.agg(F.count(F.lit(1)).alias("rows")).withColumn("feed", F.lit(kind))
        )
    reports = landing.drift_report(spark, text_feeds, RAW_CASES).drop("files")
    reports = reports.unionByName(
        spark.createDataFrame(typed, f"feed string, {landing.CHANGE_SCHEMA}, refused boolean")
    )
    return reports.join(reduce(DataFrame.unionByName, counts), "feed")


_INGEST_ANSWER = f"""
SELECT case_reference, portfolio_id, product_type, currency, postcode_area,
       national_id_pseudonym, debtor_email_pseudonym, debtor_phone_masked,
       original_balance, current_balance, default_date, failures,
       CASE WHEN rejected THEN 'quarantine' ELSE 'clean' END AS part
FROM judged"""

TYPED = f"""
SELECT DISTINCT case_reference, portfolio_id, product_type, currency, postcode_area,
       {pseudonym_sql("nullif(national_id, '')")} AS national_id_pseudonym,
       {pseudonym_sql("nullif(debtor_email, '')")} AS debtor_email_pseudonym,
       {last_four_sql("nullif(debtor_phone, '')")} AS debtor_phone_masked,
       national_id, debtor_email, debtor_phone,
       TRY_CAST(original_balance AS DECIMAL(18,2)) AS original_balance,
       TRY_CAST(current_balance AS DECIMAL(18,2)) AS current_balance,
       TRY_CAST(default_date AS DATE) AS default_date,
       current_balance = 'n/a' AS lost_balance, default_date = '2001-13-45' AS lost_date
FROM lines WHERE NOT broken"""

# A malformed line keeps the fields that could still be read: two of them where the line is
# too short, all of them where a surplus field follows.
JUDGED = """
SELECT *, concat_ws(',',
  CASE WHEN coalesce(lost_balance, false) THEN 'current_balance_readable' END,
  CASE WHEN coalesce(lost_date, false) THEN 'default_date_readable' END,
  CASE WHEN NOT coalesce(current_balance >= 0, false) THEN 'balance_non_negative' END,
  CASE WHEN NOT coalesce(current_balance <= original_balance * 3, false) THEN 'balance_not_above_original' END,
  CASE WHEN NOT coalesce(currency IN ('PLN', 'EUR', 'SEK', 'GBP'), false) THEN 'currency_supported' END,
  CASE WHEN NOT coalesce(default_date <= DATE '2002-01-01', false) THEN 'default_date_not_future' END,
  CASE WHEN national_id IS NULL AND debtor_email IS NULL AND debtor_phone IS NULL
       THEN 'national_id_or_contact_present' END) AS failures,
  coalesce(lost_balance, false) OR coalesce(lost_date, false)
  OR NOT coalesce(current_balance >= 0, false)
  OR NOT coalesce(currency IN ('PLN', 'EUR', 'SEK', 'GBP'), false)
  OR NOT coalesce(default_date <= DATE '2002-01-01', false) AS rejected
FROM typed"""


@query(
    over_views(
        _INGEST_ANSWER
        + """
UNION ALL
SELECT case_reference, portfolio_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       'row_well_formed', 'quarantine'
FROM lines WHERE broken""",
        *_BROKEN_FEED,
        ("typed", TYPED),
        ("judged", JUDGED),
    )
)
def ingest_cases(spark, sf):
    """Files to published tables; for malformed rows only the keys are compared."""
    folder = shared_folder(spark, "published")
    suffix = folder.rsplit("-", 1)[1]
    done = run_ingest(
        spark,
        _write_broken_feed(spark, sf),
        batch_id="batch-1",
        as_of=RULES_AS_OF,
        pepper=PEPPER,
        clean_table=f"cases_{suffix}",
        quarantine_table=f"cases_quarantine_{suffix}",
        table_folder=folder,
    )
    clean = spark.table(done.clean).withColumn("part", F.lit("clean"))
    rejects = spark.table(done.quarantine).withColumn("part", F.lit("quarantine"))
    both = clean.unionByName(rejects)
    malformed = F.array_contains(FAILURES, "row_well_formed")
    readable_only = [
        "product_type", "currency", "postcode_area", "national_id_pseudonym",
        "debtor_email_pseudonym", "debtor_phone_masked", "original_balance", "current_balance",
        "default_date",
    ]
    return both.select(
        "case_reference",
        "portfolio_id",
        *[F.when(~malformed, F.col(c)).alias(c) for c in readable_only],
        F.when(malformed, "row_well_formed").otherwise(F.concat_ws(",", FAILURES)).alias("failures"),
        "part",
    )


@query(over_views("SELECT payment_id, case_reference, payment_date, amount, channel FROM v_payments"))
def csv_roundtrip(spark, sf):
    path = shared_folder(spark, "csv")
    write_csv(fx.payments(spark, sf).select(*PAYMENTS.fieldNames()), path)
    landed = landing.read_landing(spark, path, PAYMENTS, "batch-1")
    readable, _ = landing.split_malformed(landed)
    return readable.select(*PAYMENTS.fieldNames())


@query(over_views("SELECT * FROM v_cases"))
def table_roundtrip(spark, sf):
    path = shared_folder(spark, "table")
    table = "cases_" + path.rsplit("-", 1)[1]
    write_table(fx.cases(spark, sf), table, path=path)
    return spark.table(table)


_LATE = f"{NUMBER} % 10 = 3"
_MOVED = f"{NUMBER} % 11 = 2"
_REFUSED = f"{NUMBER} % 97 = 5"


def _publish_batches(spark, run, batches, name):
    """Each (batch, rows) lands in a folder of its own and is ingested; the last batch runs again."""
    folder = shared_folder(spark, "published")
    suffix = folder.rsplit("-", 1)[1]
    table, rejects = f"{name}_{suffix}", f"{name}_quarantine_{suffix}"
    for batch, rows in batches:
        write_csv(rows, f"{folder}/landing-{batch}")
    for batch, _ in [*batches, batches[-1]]:
        run(
            spark,
            f"{folder}/landing-{batch}",
            batch_id=batch,
            as_of=RULES_AS_OF,
            table=table,
            quarantine_table=rejects,
            table_folder=folder,
        )
    clean = spark.table(table).withColumn("part", F.lit("clean"))
    rejected = spark.table(rejects).withColumn("part", F.lit("quarantine"))
    return clean.unionByName(rejected, allowMissingColumns=True)


@query(
    over_views(
        f"""
SELECT payment_id, case_reference, payment_date, amount, channel, strftime(payment_date, '%Y-%m') AS payment_month,
       CASE WHEN changed THEN 'second' ELSE 'first' END AS _batch_id,
       CASE WHEN payment_date >= DATE '2000-01-01' THEN '' ELSE 'payment_date_plausible' END AS failures,
       'clean' AS part
FROM (SELECT payment_id, case_reference, channel,
             CASE WHEN {_MOVED} THEN payment_date + 40 ELSE payment_date END AS payment_date,
             CASE WHEN {_MOVED} THEN CAST(amount + 1 AS DECIMAL(18,2)) ELSE amount END AS amount,
             {_LATE} OR {_MOVED} OR {_REFUSED} AS changed FROM v_payments)
UNION ALL
SELECT payment_id, case_reference, payment_date, -amount, channel, NULL, 'first',
       'payment_amount_positive' || CASE WHEN payment_date >= DATE '2000-01-01' THEN ''
                                         ELSE ',payment_date_plausible' END, 'quarantine'
FROM v_payments WHERE {_REFUSED} AND NOT {_LATE}"""
    )
)
def ingest_payments(spark, sf):
    """A first batch with refused amounts; a second with late rows, corrections that change the month, and the
    refused ones put right; and the second once more."""
    payments = fx.payments(spark, sf).select(*PAYMENTS.fieldNames())
    late, moved, refused = (F.expr(c) for c in (_LATE, _MOVED, _REFUSED))
    first = payments.where(~late).withColumn("amount", F.when(refused, -F.col("amount")).otherwise(F.col("amount")))
    second = payments.where(late | moved | refused).withColumns(
        {
            "payment_date": F.when(moved, F.date_add("payment_date", 40)).otherwise(F.col("payment_date")),
            "amount": F.when(moved, F.col("amount") + 1).otherwise(F.col("amount")),
        }
    )
    both = _publish_batches(spark, run_payments, [("first", first), ("second", second)], "payments")
    return both.select(
        *PAYMENTS.fieldNames(), "payment_month", "_batch_id", F.concat_ws(",", FAILURES).alias("failures"), "part"
    )


@query(
    over_views(
        f"""
SELECT case_reference, client_id, placed_date,
       CASE WHEN {_MOVED} THEN placed_date + 3 ELSE first_contact_date END AS first_contact_date,
       strftime(placed_date, '%Y-%m') AS placed_month,
       CASE WHEN {_LATE} OR {_MOVED} THEN 'second' ELSE 'first' END AS _batch_id, '' AS failures, 'clean' AS part
FROM v_cases"""
    )
)
def ingest_placements(spark, sf):
    """Placements whose first contact becomes known, and late ones, in a second batch that runs twice."""
    placements = fx.cases(spark, sf).select(*PLACEMENTS.fieldNames())
    late, moved = F.expr(_LATE), F.expr(_MOVED)
    known = F.when(moved, F.date_add("placed_date", 3)).otherwise(F.col("first_contact_date"))
    second = placements.where(late | moved).withColumn("first_contact_date", known)
    batches = [("first", placements.where(~late)), ("second", second)]
    both = _publish_batches(spark, run_placements, batches, "placements")
    return both.select(
        *PLACEMENTS.fieldNames(), "placed_month", "_batch_id", F.concat_ws(",", FAILURES).alias("failures"), "part"
    )
