"""Reference answers as SQL text over the benchmark tables, for checking the operators.

``VIEWS`` are the receivables-shaped inputs; every answer is those views plus one SELECT.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "v_cases": """
SELECT concat('CASE_', lpad(CAST(o_orderkey AS STRING), CAST(greatest(9, length(CAST(o_orderkey AS STRING))) AS INT), '0')) AS case_reference,
       concat('PF_', lpad(CAST(c_nationkey AS STRING), CAST(greatest(2, length(CAST(c_nationkey AS STRING))) AS INT), '0')) AS portfolio_id,
       c_mktsegment AS client_id, c_custkey AS debtor_key,
       CAST(o_totalprice AS DECIMAL(18,2)) AS original_balance,
       CASE WHEN o_orderkey % 100 = 7 THEN CAST(-10 AS DECIMAL(18,2))
            WHEN o_orderkey % 100 = 13 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS DECIMAL(18,2))
            WHEN o_orderkey % 250 = 99 THEN CAST(NULL AS DECIMAL(18,2))
            ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS current_balance,
       CASE WHEN o_orderkey % 200 = 21 THEN DATE '1970-01-01'
            WHEN o_orderkey % 333 = 5 THEN DATE '2099-01-01'
            ELSE CAST(o_orderdate AS DATE) END AS default_date,
       CASE WHEN o_orderkey % 500 = 3 THEN 'XXX' WHEN o_orderkey % 3 = 0 THEN 'PLN'
            WHEN o_orderkey % 3 = 1 THEN 'EUR' ELSE 'SEK' END AS currency,
       CAST(o_orderdate AS DATE) AS placed_date,
       CASE WHEN o_orderstatus = 'P' THEN CAST(NULL AS DATE)
            ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INT) END AS first_contact_date
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v_payments_raw": """
SELECT concat('CASE_', lpad(CAST(l_orderkey AS STRING), CAST(greatest(9, length(CAST(l_orderkey AS STRING))) AS INT), '0')) AS case_reference,
       l_linenumber AS line_no,
       concat('CASE_', lpad(CAST(l_orderkey AS STRING), CAST(greatest(9, length(CAST(l_orderkey AS STRING))) AS INT), '0'), '_P', CAST(l_linenumber AS STRING)) AS payment_id,
       CAST(l_shipdate AS DATE) AS payment_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
       CASE l_returnflag WHEN 'A' THEN 'BANK_TRANSFER' WHEN 'N' THEN 'CARD' ELSE 'DIRECT_DEBIT' END AS channel
FROM lineitem""",
    "v_payments": """
SELECT case_reference, payment_id, payment_date, amount, channel FROM (
  SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY payment_date DESC, amount DESC, channel DESC) AS rn
  FROM v_payments_raw) t WHERE rn = 1""",
    "v_portfolios": """
SELECT portfolio_id, DATE '1996-01-01' + CAST(CAST(substr(portfolio_id, 4) AS INT) * 20 AS INT) AS purchase_date,
       CASE WHEN portfolio_id = 'PF_23' THEN CAST(0 AS DECIMAL(18,2))
            ELSE CAST(sum(original_balance) * CAST(0.12 AS DECIMAL(9,6)) AS DECIMAL(18,2)) END AS purchase_price,
       CAST(sum(original_balance) AS DECIMAL(18,2)) AS gross_face_value
FROM v_cases WHERE portfolio_id <> 'PF_24' GROUP BY portfolio_id""",
    "v_curve": """
SELECT portfolio_id, CAST(o_orderkey AS INT) AS months_on_book,
       CAST((o_orderkey + 1) * CAST(0.012500 AS DECIMAL(9,6)) AS DECIMAL(9,6)) AS forecast_pct
FROM v_portfolios CROSS JOIN orders WHERE o_orderkey < 60""",
    "v_contracts": """
SELECT DISTINCT c_mktsegment AS client_id, CAST(0.150000 AS DECIMAL(9,6)) AS commission_rate,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN CAST(NULL AS INT) ELSE 30 END AS sla_target_days,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN DATE '1997-01-15' ELSE DATE '1990-01-01' END AS valid_from,
       DATE '1998-06-10' AS valid_to FROM customer
UNION ALL
SELECT DISTINCT c_mktsegment, CAST(0.100000 AS DECIMAL(9,6)),
       CASE WHEN c_mktsegment = 'FURNITURE' THEN CAST(NULL AS INT) ELSE 20 END,
       DATE '1998-06-10', CAST(NULL AS DATE) FROM customer""",
    "v_debtors": """
SELECT c_custkey AS debtor_key,
       CASE WHEN c_custkey % 20 = 0 THEN CAST(NULL AS STRING) WHEN c_custkey % 20 = 1 THEN '   '
            WHEN c_custkey % 20 = 2 THEN concat(' ', lpad(CAST(c_custkey * 7919 AS STRING), CAST(greatest(11, length(CAST(c_custkey * 7919 AS STRING))) AS INT), '0'), ' ')
            ELSE lpad(CAST(c_custkey * 7919 AS STRING), CAST(greatest(11, length(CAST(c_custkey * 7919 AS STRING))) AS INT), '0') END AS national_id,
       c_name AS debtor_name,
       CASE WHEN c_custkey % 10 = 4 THEN CAST(NULL AS STRING)
            ELSE concat('Debtor', CAST(c_custkey AS STRING), '@Example.invalid') END AS debtor_email,
       CASE WHEN c_custkey % 50 = 9 THEN '12'
            ELSE concat('+48 ', lpad(CAST((c_custkey * 104729) % 1000000000 AS STRING), CAST(greatest(9, length(CAST((c_custkey * 104729) % 1000000000 AS STRING))) AS INT), '0')) END AS debtor_phone,
       concat('Street ', CAST(c_custkey AS STRING)) AS debtor_address,
       lpad(CAST(c_custkey % 100 AS STRING), CAST(greatest(2, length(CAST(c_custkey % 100 AS STRING))) AS INT), '0') AS postcode_area
FROM customer""",
    "v_cases_raw": """
SELECT * FROM v_cases UNION ALL
SELECT * FROM v_cases WHERE CAST(substr(case_reference, 6) AS BIGINT) % 50 = 0""",
    "v_cases_skewed": """
SELECT case_reference,
       CASE WHEN CAST(substr(case_reference, 6) AS BIGINT) % 10 < 4 THEN 'PF_00'
            WHEN CAST(substr(case_reference, 6) AS BIGINT) % 100 = 77 THEN CAST(NULL AS STRING)
            ELSE portfolio_id END AS portfolio_id, original_balance
FROM v_cases""",
}

_CHAIN = ",\n".join(f"{name} AS ({body}\n)" for name, body in VIEWS.items())


def over_views(select: str, *more: tuple[str, str]) -> str:
    """``select`` over the views, with further named subqueries of its own."""
    extra = "".join(f",\n{name} AS ({body}\n)" for name, body in more)
    return f"WITH {_CHAIN}{extra}\n{select}"


SERVICING_SELECT = """
SELECT m.client_id, m.case_reference, m.as_of_month,
       CAST(m.amt AS DECIMAL(18,2)) AS collections_actual, c.commission_rate,
       CAST(m.amt * c.commission_rate AS DECIMAL(18,2)) AS commission_earned,
       c.sla_target_days,
       CAST(date_diff('day', m.placed_date, m.first_contact_date) AS INT) AS sla_actual_days,
       CASE WHEN m.first_contact_date IS NULL THEN 'PENDING'
            WHEN date_diff('day', m.placed_date, m.first_contact_date) <= c.sla_target_days THEN 'MET'
            ELSE 'BREACHED' END AS sla_met
FROM (SELECT k.client_id, k.case_reference, CAST(date_trunc('month', p.payment_date) AS DATE) AS as_of_month,
             k.placed_date, k.first_contact_date, sum(p.amount) AS amt
      FROM v_payments p JOIN v_cases k ON p.case_reference = k.case_reference
      GROUP BY ALL) m
LEFT JOIN v_contracts c ON m.client_id = c.client_id AND c.valid_from <= m.as_of_month
     AND m.as_of_month < coalesce(c.valid_to, DATE '9999-12-31')"""
