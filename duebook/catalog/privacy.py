"""Queries: pseudonyms, masks, the column policy, masked views and row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from duebook import fixtures as fx
from duebook.catalog.registry import PEPPER, query
from duebook.functions.privacy import last_four, padded_keys, pseudonym
from duebook.operators import privacy
from duebook.oracles import over_views
from duebook.sources.storage import shared_folder, write_table


def pseudonym_sql(column: str) -> str:
    inner, outer = (key.hex() for key in padded_keys(PEPPER))
    text = rf"lower(regexp_replace({column}, '^\s+|\s+$', '', 'g'))"
    digest = f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({text}))))"
    return f"CASE WHEN length({text}) > 0 THEN 'px_' || substr({digest}, 1, 32) END"


def last_four_sql(column: str) -> str:
    kept = f"regexp_replace({column}, '[^A-Za-z0-9]', '', 'g')"
    return (
        f"CASE WHEN {column} IS NOT NULL THEN '***' || "
        f"CASE WHEN length({kept}) >= 4 THEN right({kept}, 4) ELSE '' END END"
    )


POLICY_SQL = f"""
SELECT debtor_key, postcode_area,
       {pseudonym_sql('national_id')} AS national_id_pseudonym,
       {pseudonym_sql('debtor_email')} AS debtor_email_pseudonym,
       {last_four_sql('debtor_phone')} AS debtor_phone_masked
FROM v_debtors"""


@query(over_views(f"SELECT debtor_key, {pseudonym_sql('national_id')} AS person FROM v_debtors"))
def pseudonymise(spark, sf):
    return fx.debtors(spark, sf).select(
        "debtor_key", pseudonym(F.col("national_id"), PEPPER).alias("person")
    )


@query(over_views(f"SELECT debtor_key, {last_four_sql('debtor_phone')} AS phone FROM v_debtors"))
def mask_last4(spark, sf):
    return fx.debtors(spark, sf).select(
        "debtor_key", last_four(F.col("debtor_phone")).alias("phone")
    )


@query(over_views(POLICY_SQL))
def apply_pii_policy(spark, sf):
    return privacy.apply_policy(fx.debtors(spark, sf), PEPPER)


@query(
    over_views(
        """
SELECT 'analyst' AS reader, debtor_key, postcode_area, CAST(NULL AS VARCHAR) AS national_id_pseudonym,
       CAST(NULL AS VARCHAR) AS debtor_email_pseudonym,
       '***' || right(regexp_replace(debtor_phone_masked, '[^0-9]', '', 'g'), 4) AS debtor_phone_masked
FROM p
UNION ALL
SELECT 'engineer', debtor_key, postcode_area, national_id_pseudonym, debtor_email_pseudonym,
       '***' || right(regexp_replace(debtor_phone_masked, '[^0-9]', '', 'g'), 4)
FROM p""",
        ("p", POLICY_SQL),
    )
)
def column_mask_view(spark, sf):
    folder = shared_folder(spark, "masked")
    suffix = folder.rsplit("-", 1)[1]
    table = f"debtors_{suffix}"
    write_table(privacy.apply_policy(fx.debtors(spark, sf), PEPPER), table, path=folder)
    analyst = privacy.create_masked_view(spark, table, f"analyst_{suffix}", [])
    engineer = privacy.create_masked_view(
        spark, table, f"engineer_{suffix}", [privacy.PSEUDONYM_GROUP]
    )
    return analyst.withColumn("reader", F.lit("analyst")).unionByName(
        engineer.withColumn("reader", F.lit("engineer"))
    )


@query(
    over_views(
        """
SELECT 'ana' AS reader, case_reference, client_id FROM v_cases
WHERE client_id IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT 'head', case_reference, client_id FROM v_cases"""
    )
)
def row_filter_view(spark, sf):
    cases = fx.cases(spark, sf).select("case_reference", "client_id")
    entitlements = spark.createDataFrame(
        [
            ("ana", "client-building"),
            ("ana", "client-machinery"),
            ("head", privacy.ALL_CLIENTS_GROUP),
        ],
        "principal string, group_name string",
    )
    views = [
        privacy.visible_rows(cases, entitlements, who).withColumn("reader", F.lit(who))
        for who in ("ana", "head", "nobody")
    ]
    return views[0].unionByName(views[1]).unionByName(views[2])


@query(
    over_views(
        """
SELECT debtor_key, debtor_phone AS for_operations,
       '***' || right(regexp_replace(debtor_phone, '[^0-9]', '', 'g'), 4) AS for_analysts,
       CAST(NULL AS VARCHAR) AS id_for_analysts, national_id AS id_for_engineers
FROM v_debtors"""
    )
)
def sql_mask_function(spark, sf):
    privacy.create_access_functions(spark)
    return fx.debtors(spark, sf).selectExpr(
        "debtor_key",
        "mask_phone(debtor_phone, true) AS for_operations",
        "mask_phone(debtor_phone, false) AS for_analysts",
        "mask_pseudonym(national_id, false) AS id_for_analysts",
        "mask_pseudonym(national_id, true) AS id_for_engineers",
    )


@query(
    over_views(
        """
SELECT case_reference, client_id, 'own' AS rights FROM v_cases WHERE client_id = 'BUILDING'
UNION ALL SELECT case_reference, client_id, 'all' FROM v_cases"""
    )
)
def sql_row_filter_function(spark, sf):
    privacy.create_access_functions(spark)
    cases = fx.cases(spark, sf).select("case_reference", "client_id")
    own = cases.where("client_row_filter(client_id, array('client-building', 'other'))")
    everyone = cases.where("client_row_filter(client_id, array('servicing-all-clients'))")
    return own.withColumn("rights", F.lit("own")).unionByName(
        everyone.withColumn("rights", F.lit("all"))
    )
