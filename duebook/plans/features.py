"""Point-in-time features, forward label and training sets.

Everything known about a case at ``as_of`` comes from payments dated strictly before it; the
label looks at ``[as_of, as_of + 90 days)``. Both are computed in one pass over payments:

1. payments are summed per (case, day), which Spark combines on the map side;
2. the days of a case are shuffled together once, and the gap to the previous payment day,
   the sums and the label are computed on that one partitioning.

A case therefore never brings more rows into its window than there are calendar days, even
if it holds a third of all payments. Several payments on one day have gaps of zero days
between them, so the gap statistics follow from the distinct days and the payment count.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duebook.functions.dates import month_of
from duebook.operators.joins import as_of_slice, join_large, valid_at

LABEL_HORIZON_DAYS = 90
LABEL = "label_paid_90d"

#: What a payment day changes at a date: counts, sums, and the ends of the history.
_CHANGES = {
    "n": "bigint",
    "paid": "decimal(28,2)",
    "paid_30": "decimal(28,2)",
    "paid_90": "decimal(28,2)",
    "months": "bigint",
    "squares": "bigint",
    "horizon": "decimal(28,2)",
    "first": "date",
    "last": "date",
}

_ZERO_WHEN_NEVER_PAID = [
    "payments_count_lifetime",
    "amount_paid_lifetime",
    "amount_paid_30d",
    "amount_paid_90d",
    "distinct_months_paid",
]


def payment_days(payments: DataFrame) -> DataFrame:
    """One row per case and day, with the day before it on which the case paid."""
    days = payments.groupBy("case_reference", "payment_date").agg(
        F.count(F.lit(1)).alias("n_payments"), F.sum("amount").alias("amount")
    )
    history = Window.partitionBy("case_reference").orderBy("payment_date")
    return days.withColumn("previous_date", F.lag("payment_date").over(history))


def _gap_sums(within: Column) -> tuple[Column, Column, Column]:
    """Number of gaps, sum of gaps and sum of squared gaps over the days ``within``."""
    gap = F.datediff("payment_date", "previous_date").cast("bigint")
    day = F.when(within, F.col("payment_date"))
    count = F.sum(F.when(within, F.col("n_payments"))) - 1
    total = F.datediff(F.max(day), F.min(day))
    squares = F.coalesce(F.sum(F.when(within, gap * gap)), F.lit(0))  # NULL on a first day
    return count, total, squares


def _gap_statistics(within: Column) -> list[Column]:
    """Mean and sample deviation of the gaps, from exact integer sums."""
    count, total, squares = _gap_sums(within)
    n = count.cast("decimal(19,0)")
    spread = n * squares - total.cast("decimal(19,0)") * total
    variance = spread.cast("double") / (count.cast("double") * (count - 1))
    return [
        F.when(count >= 1, total / count.cast("double")).alias("avg_days_between_payments"),
        F.when(count >= 2, F.sqrt(variance)).alias("stddev_days_between_payments"),
    ]


def gap_statistics(payments: DataFrame) -> DataFrame:
    return (
        payment_days(payments)
        .groupBy("case_reference")
        .agg(*_gap_statistics(F.col("payment_date").isNotNull()))
    )


def payment_gaps(payments: DataFrame) -> DataFrame:
    """Every payment with the case's previous payment date and the days in between.

    Payments of one day are ordered by ``payment_id``, which must be unique within a case:
    the first of them follows the previous payment day, the others follow each other at
    zero days. Only one row per case and day goes through the window; the payments
    themselves meet it in an equi join that adaptive execution can split.
    """
    days = payments.groupBy("case_reference", "payment_date").agg(
        F.min("payment_id").alias("_first_id")
    )
    history = Window.partitionBy("case_reference").orderBy("payment_date")
    days = days.select(
        F.col("case_reference").alias("_case"),
        F.col("payment_date").alias("_day"),
        "_first_id",
        F.lag("payment_date").over(history).alias("_previous"),
    )
    same_day = F.col("case_reference").eqNullSafe(F.col("_case")) & F.col(
        "payment_date"
    ).eqNullSafe(F.col("_day"))
    previous = F.when(F.col("payment_id") == F.col("_first_id"), F.col("_previous")).otherwise(
        F.col("payment_date")
    )
    return (
        join_large(payments, days, same_day)
        .withColumn("prev_payment_date", previous)
        .withColumn("gap_days", F.datediff("payment_date", "prev_payment_date"))
        .drop("_case", "_day", "_first_id", "_previous")
    )


def lifetime_totals(payments: DataFrame) -> DataFrame:
    """Totals per case with no bound in time: the leaky version, kept for comparison."""
    return payments.groupBy("case_reference").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.sum("amount").alias("total_paid"),
        F.max("payment_date").alias("last_payment_date"),
    )


def features_naive(payments: DataFrame, cases: DataFrame, as_of: date) -> DataFrame:
    totals = lifetime_totals(payments)
    joined = join_large(cases, totals, "case_reference", "left")
    return joined.withColumn("as_of_date", F.lit(as_of))


def trailing_sums(payments: DataFrame, as_of: date) -> DataFrame:
    """Amount per case in the last 30 and 90 days before ``as_of``; 0 if it paid earlier."""
    return (
        payments.where(F.col("payment_date") < F.lit(as_of))
        .groupBy("case_reference")
        .agg(*[_trailing(F.lit(as_of), n) for n in (30, 90)])
    )


def _trailing(as_of: Column, days: int, known: Column | None = None) -> Column:
    recent = F.col("payment_date") >= F.date_sub(as_of, days)
    recent = recent if known is None else known & recent
    # Sums skip NULL, so the many older payments cost no decimal addition.
    paid = F.coalesce(F.sum(F.when(recent, F.col("amount"))), F.lit(0))
    return paid.alias(f"amount_paid_{days}d")


def distinct_months_paid(payments: DataFrame) -> DataFrame:
    return payments.groupBy("case_reference").agg(
        F.countDistinct(month_of("payment_date")).alias("distinct_months_paid")
    )


def _measures(as_of: Column) -> list[Column]:
    known = F.col("payment_date") < as_of
    last = F.max(F.when(known, F.col("payment_date")))
    new_month = known & ~F.coalesce(
        month_of("payment_date") == month_of("previous_date"), F.lit(False)
    )
    return [
        F.coalesce(F.sum(F.when(known, F.col("n_payments"))), F.lit(0)).alias(
            "payments_count_lifetime"
        ),
        F.sum(F.when(known, F.col("amount"))).alias("amount_paid_lifetime"),
        last.alias("last_payment_date"),
        _trailing(as_of, 30, known),
        _trailing(as_of, 90, known),
        F.count_if(new_month).alias("distinct_months_paid"),
        *_gap_statistics(known),
        F.sum(F.when(~known, F.col("amount"))).alias("_paid_in_horizon"),
    ]


def _finish(joined: DataFrame) -> DataFrame:
    """Zeros only where zero is the truth: recency and gaps stay NULL if unknown."""
    filled = joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in _ZERO_WHEN_NEVER_PAID}
    )
    return filled.withColumns(
        {
            "days_since_last_payment": F.datediff("as_of_date", "last_payment_date"),
            "has_ever_paid": F.col("payments_count_lifetime") > 0,
            LABEL: F.coalesce(F.col("_paid_in_horizon"), F.lit(0)) > 0,
        }
    ).drop("_paid_in_horizon")


def _features_and_label(
    payments: DataFrame, cases: DataFrame, as_of: date, seen_until: date
) -> DataFrame:
    days = payment_days(payments.where(F.col("payment_date") < F.lit(seen_until)))
    per_case = days.groupBy("case_reference").agg(*_measures(F.lit(as_of)))
    known_cases = as_of_slice(cases, as_of).withColumn("as_of_date", F.lit(as_of))
    return _finish(join_large(known_cases, per_case, "case_reference", "left"))


def features_pit(payments: DataFrame, cases: DataFrame, as_of: date) -> DataFrame:
    """Features of every case at ``as_of``. The date bound reaches the scan."""
    return _features_and_label(payments, cases, as_of, as_of).drop(LABEL)


def forward_label(payments: DataFrame, cases: DataFrame, as_of: date) -> DataFrame:
    """Did the case pay anything in the 90 days from ``as_of`` on? One row per case."""
    until = as_of + timedelta(days=LABEL_HORIZON_DAYS)
    paid_on = F.col("payment_date")
    paid = (
        payments.where((paid_on >= F.lit(as_of)) & (paid_on < F.lit(until)))
        .groupBy("case_reference")
        .agg(F.sum("amount").alias("_paid"))
    )
    known_cases = as_of_slice(cases, as_of).select("case_reference").distinct()
    return join_large(known_cases, paid, "case_reference", "left").select(
        "case_reference",
        F.lit(as_of).alias("as_of_date"),
        (F.coalesce(F.col("_paid"), F.lit(0)) > 0).alias(LABEL),
    )


def training_set(payments: DataFrame, cases: DataFrame, as_of: date) -> DataFrame:
    """Features and label of one day from a single scan of the payments."""
    until = as_of + timedelta(days=LABEL_HORIZON_DAYS)
    return _features_and_label(payments, cases, as_of, until)


def training_set_backfill(
    payments: DataFrame, cases: DataFrame, as_of_dates: Sequence[date]
) -> DataFrame:
    """Training rows for many days at once: one row per valid case and day.

    Between two dates a case's measures change only by the days that become known, that grow too old for a
    trailing window, or that come into the label's horizon. Every payment day is turned into those few changes,
    and running sums over a case's changes give the measures of all dates: the work is payment days plus
    dates, not their product. The results are joined to the cases as one list per case. A case that has
    changed once has measures at every later date, so its list ends with the last date, its entry for any
    date is found by its place, and it is taken apart as the rows are made.
    """
    dates = sorted(set(as_of_dates))
    every_date = F.array(*[F.lit(d) for d in dates])
    until = dates[-1] + timedelta(days=LABEL_HORIZON_DAYS)
    days = payment_days(payments.where(F.col("payment_date") < F.lit(until)))
    per_date = _measures_by_date(days, dates)
    measures = [c for c in per_date.columns if c not in ("case_reference", "as_of_date")]
    per_case = per_date.groupBy("case_reference").agg(
        F.array_sort(F.collect_list(F.struct("as_of_date", *measures))).alias("_by_date")
    )
    first = len(dates) - F.coalesce(F.size("_by_date"), F.lit(0))
    by_date = F.transform(
        every_date,
        lambda d, i: F.struct(d.alias("as_of_date"), F.get("_by_date", i - first).alias("_found")),
    )
    dated = join_large(cases, per_case, "case_reference", "left").select(
        *[F.col(c) for c in cases.columns], F.inline(by_date)
    )
    if "valid_from" in cases.columns:
        dated = dated.where(valid_at(F.col("as_of_date")))
    return _finish(
        dated.withColumns({m: F.col(f"_found.{m}") for m in measures}).drop("_found")
    )


def _calendar(spark: SparkSession, dates: Sequence[date]) -> DataFrame:
    """For each day on which something can change: the places of the dates at which it does.

    ``known``: the first date after the day. ``out_30``, ``out_90``: the first for which it is too old.
    ``near``: the first whose horizon holds it. A place behind the last date means never. Its size is
    the span of the dates: earlier days stand at the first day, where they are already too old.
    """
    span = (dates[-1] - dates[0]).days + LABEL_HORIZON_DAYS
    first = dates[0] - timedelta(days=91)
    rows = []
    for i in range(span + 92):
        day = first + timedelta(days=i)
        after = [day, day + timedelta(days=30), day + timedelta(days=90), day - timedelta(days=LABEL_HORIZON_DAYS)]
        rows.append((day, *(bisect_right(dates, d) for d in after)))
    return spark.createDataFrame(rows, "_day date, known int, out_30 int, out_90 int, near int")


def _measures_by_date(days: DataFrame, dates: Sequence[date]) -> DataFrame:
    """:func:`_measures` of every case and date from its first change on, from running sums of changes."""
    first_day = F.lit(dates[0] - timedelta(days=91))
    calendar = F.broadcast(_calendar(days.sparkSession, dates))  # one row per day of the dates' span
    placed = days.join(calendar, F.greatest("payment_date", first_day) == F.col("_day"))
    amount, minus = F.col("amount"), -F.col("amount")
    gap = F.datediff("payment_date", "previous_date").cast("bigint")
    new_month = ~F.coalesce(month_of("payment_date") == month_of("previous_date"), F.lit(False))

    def change(place: str, happens: Column, **values: Column) -> Column:
        fields = [F.col(place).alias("place")]
        for name, kind in _CHANGES.items():
            fields.append(values.get(name, F.lit(None)).cast(kind).alias(name))
        return F.when(happens & (F.col(place) < len(dates)), F.struct(*fields))

    known, out_30, out_90, near = (F.col(c) for c in ("known", "out_30", "out_90", "near"))
    in_30, in_90, ahead = out_30 > known, out_90 > known, near < known
    changes = F.array_compact(
        F.array(
            change(
                "known",
                F.lit(True),
                n=F.col("n_payments"),
                paid=amount,
                paid_30=F.when(in_30, amount),
                paid_90=F.when(in_90, amount),
                months=new_month.cast("bigint"),
                squares=gap * gap,
                horizon=F.when(ahead, minus),
                first=F.col("payment_date"),
                last=F.col("payment_date"),
            ),
            change("out_30", in_30, paid_30=minus),
            change("out_90", in_90, paid_90=minus),
            change("near", ahead, horizon=amount),
        )
    )
    sums = [c for c in _CHANGES if c not in ("first", "last")]
    events = (
        placed.select("case_reference", F.inline(changes))
        .groupBy("case_reference", "place")
        .agg(*[F.sum(c).alias(c) for c in sums], F.min("first").alias("first"), F.max("last").alias("last"))
    )
    by_place = Window.partitionBy("case_reference").orderBy("place")
    so_far = by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = {c: F.coalesce(F.sum(c).over(so_far), F.lit(0)).alias(c) for c in sums}
    running = events.select(
        "case_reference",
        "place",
        F.coalesce(F.lead("place").over(by_place), F.lit(len(dates))).alias("_next"),
        *total.values(),
        F.min("first").over(so_far).alias("first"),
        F.max("last").over(so_far).alias("last"),
    )
    count = F.col("n") - 1
    n, gaps = count.cast("decimal(19,0)"), F.datediff("last", "first")
    spread = n * F.col("squares") - gaps.cast("decimal(19,0)") * gaps
    variance = spread.cast("double") / (count.cast("double") * (count - 1))
    every_date = F.array(*[F.lit(d) for d in dates])
    held = F.slice(every_date, F.col("place") + 1, F.col("_next") - F.col("place"))
    return running.select(
        "case_reference",
        F.explode(held).alias("as_of_date"),
        F.col("n").alias("payments_count_lifetime"),
        F.col("paid").alias("amount_paid_lifetime"),
        F.col("last").alias("last_payment_date"),
        F.col("paid_30").alias("amount_paid_30d"),
        F.col("paid_90").alias("amount_paid_90d"),
        F.col("months").alias("distinct_months_paid"),
        F.when(count >= 1, gaps / count.cast("double")).alias("avg_days_between_payments"),
        F.when(count >= 2, F.sqrt(variance)).alias("stddev_days_between_payments"),
        F.col("horizon").alias("_paid_in_horizon"),
    )


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows by which two frames differ as bags, with how many more copies ``after`` has.

    Each side is reduced to (row, copies) on the map side and one signed sum compares them:
    a single shuffle, where subtracting both ways needs four.
    """
    columns = before.columns
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(
        after.withColumn("_sign", F.lit(1))
    )
    return signed.groupBy(*columns).agg(F.sum("_sign").alias("copies")).where("copies <> 0")


def leakage_check(payments: DataFrame, cases: DataFrame, as_of: date) -> DataFrame:
    """Do the features of ``as_of`` change when later payments are added?

    One row per feature build, with the rows that appear and the rows that disappear. The
    point-in-time build must show 0 of both; the naive one shows how many cases would have leaked.
    """
    history = payments.where(F.col("payment_date") < F.lit(as_of))
    none = F.lit(0).cast("bigint")
    checks = [
        changed_rows(build(history, cases, as_of), build(payments, cases, as_of))
        .agg(
            F.coalesce(F.sum(F.greatest("copies", none)), none).alias("rows_added"),
            F.coalesce(F.sum(F.greatest(-F.col("copies"), none)), none).alias("rows_removed"),
        )
        .select(F.lit(name).alias("build"), "rows_added", "rows_removed")
        for name, build in (("point_in_time", features_pit), ("naive", features_naive))
    ]
    return checks[0].unionByName(checks[1])
