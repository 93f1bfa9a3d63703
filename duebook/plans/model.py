"""Propensity model: split by time, gradient-boosted trees, evaluation and leak gate.

Trees see a number only through the bin it falls into, so cases with the same bins are the same case to them. The
bins are cut from all training rows, rows are counted by their bins and label, and boosting and evaluation read
each combination once, weighted by its rows. Both read the table often: what they read is bounded by the
combinations of bins that occur, and the table itself is read twice whatever the number of rounds.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.plans.features import LABEL
from duebook.sources.storage import staged

# The model's inputs, its boosting rounds and the score that suggests a leak.
MODEL_FEATURES = [
    "payments_count_lifetime",
    "amount_paid_lifetime",
    "amount_paid_30d",
    "amount_paid_90d",
    "distinct_months_paid",
    "days_since_last_payment",
    "avg_days_between_payments",
]
BOOSTING_ROUNDS = 50
SUSPICIOUS_AUC = 0.95

# Bins of a number (what the trees take by default), the share of the rows by which the place of a
# cut may be off, and the combinations of bins that one task of the boosting reads.
BINS = 32
RANK_ERROR = 1e-4
TASK_ROWS = 50_000

# Trees refuse missing numbers. An unknown recency or gap is no case that just paid: it is put
# above every possible number of days, so that one split can set these cases apart.
UNKNOWN_DAYS = 1e7


@dataclass(frozen=True)
class Propensity:
    model: PipelineModel
    auc: float
    train_rows: int
    test_rows: int

    @property
    def looks_leaky(self) -> bool:
        return self.auc > SUSPICIOUS_AUC


def temporal_split(training_set: DataFrame, cutoff: date) -> tuple[DataFrame, DataFrame]:
    """(before the cutoff, from it on). Never random: one debtor must not be on both sides."""
    before = F.col("as_of_date") < F.lit(cutoff)
    return training_set.where(before), training_set.where(~before)


def bin_cuts(ranked: list[float], bins: int = BINS) -> list[float]:
    """Where a number is cut into at most ``bins`` bins of like size; ``ranked``: its values at even ranks.

    Cuts lie halfway between values. Few values have a bin each; others are cut at the value that comes nearest
    to an even share. A number with one value has all of it in one bin.
    """
    counts = sorted(Counter(ranked).items())
    halfway = [(x + y) / 2 for (x, _), (y, _) in zip(counts, counts[1:])]
    if len(counts) <= bins:
        return halfway or [counts[0][0] if counts else 0.0]
    cuts, seen, share = [], 0, len(ranked) / bins
    for (_, n), (_, following), cut in zip(counts, counts[1:], halfway):
        seen += n
        target = share * (len(cuts) + 1)
        if abs(seen - target) < abs(seen + following - target) and len(cuts) < bins - 1:
            cuts.append(cut)
    return cuts


def binned(training: DataFrame) -> Bucketizer:
    """Bins of the model's inputs, from all rows of ``training``. Tasks end in any order, so that a cut may move by
    ``RANK_ERROR`` from run to run."""
    steps = round(1 / RANK_ERROR)
    ranked = training.approxQuantile(MODEL_FEATURES, [i / steps for i in range(steps + 1)], RANK_ERROR)
    return Bucketizer(
        splitsArray=[[-float("inf"), *bin_cuts(x), float("inf")] for x in ranked],
        inputCols=MODEL_FEATURES,
        outputCols=[f"{c}_bin" for c in MODEL_FEATURES],
    )


def counted_by_bins(rows: DataFrame, bins: Bucketizer, cutoff: date) -> DataFrame:
    """``n_rows`` before the cutoff (``is_train``) and from it on, for each label and combination of bins.

    The bins travel as one number, and come back as numbers: the bucketizer marks its own as categories, which
    have no order.
    """
    names = bins.getOutputCols()
    combination = sum((F.col(c).cast("bigint") * BINS**i for i, c in enumerate(names)), F.lit(0))
    counted = (
        bins.transform(rows)
        .groupBy(
            (F.col("as_of_date") < F.lit(cutoff)).alias("is_train"),
            LABEL,
            combination.alias("_combination"),
        )
        .agg(F.count(F.lit(1)).cast("double").alias("n_rows"))
    )
    digits = {
        c: (F.floor(F.col("_combination") / BINS**i) % BINS).cast("double")
        for i, c in enumerate(names)
    }
    return counted.withColumns(digits).drop("_combination")


def train_propensity(
    training_set: DataFrame, cutoff: date, rounds: int = BOOSTING_ROUNDS
) -> Propensity:
    """Fit and score. ``training_set`` should be a written table: it is read twice.

    Only the label and the model's inputs are read, and the label becomes a number because
    the trees refuse a boolean.
    """
    narrow = training_set.select(
        "as_of_date",
        F.col(LABEL).cast("int").alias(LABEL),
        *[
            F.coalesce(F.col(c).cast("double"), F.lit(UNKNOWN_DAYS)).alias(c)
            for c in MODEL_FEATURES
        ],
    )
    bins = binned(temporal_split(narrow, cutoff)[0])
    trees = GBTClassifier(
        labelCol=LABEL, featuresCol="features", weightCol="n_rows", maxBins=BINS, maxIter=rounds, seed=17
    )
    assembler = VectorAssembler(inputCols=bins.getOutputCols(), outputCol="features")
    with staged(counted_by_bins(narrow, bins, cutoff), "training-bins", ["is_train"]) as counted:
        parts = {}
        for is_train in (True, False):
            part = counted.where(F.col("is_train") == is_train)
            n_combinations, n_rows = part.agg(
                F.count(F.lit(1)), F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint")
            ).first()
            tasks = -(-n_combinations // TASK_ROWS) or 1
            parts[is_train] = assembler.transform(part.repartition(tasks)), n_rows
        fitted = trees.fit(parts[True][0])
        auc = BinaryClassificationEvaluator(
            labelCol=LABEL, weightCol="n_rows", metricName="areaUnderROC"
        ).evaluate(fitted.transform(parts[False][0]))
    return Propensity(
        PipelineModel(stages=[bins, assembler, fitted]), auc, parts[True][1], parts[False][1]
    )
