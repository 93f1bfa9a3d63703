"""Measure the alternatives the design decided against; prints one JSON line of seconds.

Native pseudonym against a row-at-a-time Python function, all rules in one pass against one pass
per rule, a skewed join and sum with and without salt, and a backfill of 100 and 200 dates. The input is the payments and cases
of $BENCH_SF_DIR, spread over $BENCH_CPUS files and repeated $BENCH_COPIES times.
"""

from __future__ import annotations

import hashlib
import hmac
import json
import os
import time
from datetime import date, timedelta

from pyspark.sql import functions as F

from bench import session
from duebook import fixtures as fx
from duebook.catalog.registry import PEPPER, RULES_AS_OF
from duebook.functions.privacy import pseudonym
from duebook.operators import skew
from duebook.operators.quality import case_rules, rule_metrics
from duebook.plans import features
from duebook.sources.storage import shared_folder


def python_pseudonym(value):
    if value is None or not value.strip():
        return None
    digest = hmac.new(PEPPER.encode(), value.strip().lower().encode(), hashlib.sha256)
    return "px_" + digest.hexdigest()[:32]


def seconds(action) -> float:
    """Best of two runs; the first also pays for compilation."""
    times = []
    for _ in range(2):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def run(df):
    return lambda: df.write.format("noop").mode("overwrite").save()


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "8"))
    spark = session(cpus)

    def written(df, name, copies=copies):
        path = shared_folder(spark, f"compare-{name}")
        many = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        many.repartition(int(cpus)).write.parquet(path)
        return spark.read.parquet(path)

    payments = written(fx.payments_raw(spark, sf_dir), "payments")
    cases = written(fx.cases_with_debtors(spark, sf_dir), "cases")
    skewed = written(fx.cases_skewed(spark, sf_dir), "skewed")
    portfolios = fx.portfolios(spark, sf_dir).select("portfolio_id", "gross_face_value")
    rules = case_rules(RULES_AS_OF)
    row_wise = F.udf(python_pseudonym, "string")

    def one_pass_per_rule():
        for rule in rules:
            cases.where(~F.coalesce(F.expr(rule.passes), F.lit(False))).count()

    def backfill(n):
        dates = [date(1996, 1, 1) + timedelta(days=5 * i) for i in range(n)]
        rows = features.training_set_backfill(few, owned, dates)
        return run(rows.groupBy("as_of_date").agg(F.sum("amount_paid_90d"), F.count_if(features.LABEL)))

    few = written(fx.payments(spark, sf_dir), "once", 1)
    owned = written(fx.cases(spark, sf_dir).select("case_reference"), "owned", 1)
    merged = portfolios.hint("merge")
    result = {
        "pseudonym_native": seconds(run(payments.select(pseudonym(F.col("payment_id"), PEPPER)))),
        "pseudonym_python": seconds(run(payments.select(row_wise("payment_id")))),
        "rules_one_pass": seconds(lambda: rule_metrics(cases, rules).collect()),
        "rules_pass_per_rule": seconds(one_pass_per_rule),
        "join_plain": seconds(run(skewed.join(merged, "portfolio_id"))),
        "join_salted": seconds(
            run(skew.salted_join(skewed, merged, "portfolio_id", by=["case_reference"]))
        ),
        "join_salted_hot_key": seconds(
            run(skew.salted_join(skewed, merged, "portfolio_id", hot=["PF_00"], by=["case_reference"]))
        ),
        "sum_plain": seconds(run(skewed.groupBy("portfolio_id").agg(F.sum("original_balance")))),
        "sum_salted": seconds(run(skew.aggregate_skewed(skewed, "portfolio_id", "original_balance"))),
        "backfill_100_dates": seconds(backfill(100)),
        "backfill_200_dates": seconds(backfill(200)),
        "payments": payments.count(),
        "cases": cases.count(),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
