from datetime import date

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from duebook.plans import features, model

CUTOFF = date(2023, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    """20,000 cases a day with an amount that no two share; those who paid more, and more often, pay again."""
    amount = (F.hash("id", "as_of_date").cast("double") + 2.0**31) / 2.0**32
    often = F.pmod(F.col("id"), F.lit(4))
    days = F.explode(F.array(F.lit(date(2022, 1, 1)), F.lit(CUTOFF)))
    inputs = {c: F.lit(None).cast("double") for c in model.MODEL_FEATURES}
    inputs |= {"payments_count_lifetime": often, "amount_paid_lifetime": amount, "amount_paid_90d": amount / 2}
    paid = often / 8 + amount / 2 > F.pmod(F.hash(F.lit("p"), "id"), F.lit(1000)) / 1000
    dated = spark.range(20_000).withColumn("as_of_date", days)
    return dated.withColumns(inputs | {features.LABEL: paid}).localCheckpoint()


def test_trees_read_combinations_of_bins_not_rows(rows, monkeypatch):
    read = []
    fit = GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, data: read.append(data) or fit(self, data.localCheckpoint()))
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, data: read.append(data.count()) or self._fit(data))
    fitted = model.train_propensity(rows, CUTOFF, rounds=1)
    assert read[0] <= 2 * 4 * model.BINS + 8
    assert fitted.train_rows == fitted.test_rows == 20_000 and 0.6 < fitted.auc < 1
    scored = fitted.model.transform(rows.withColumns({c: F.coalesce(c, F.lit(model.UNKNOWN_DAYS)) for c in model.MODEL_FEATURES}))
    assert scored.select("prediction").count() == 40_000


def test_counted_bins_give_the_trees_of_all_rows(rows):
    whole = rows.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(model.UNKNOWN_DAYS)) for c in model.MODEL_FEATURES}
    ).withColumn(features.LABEL, F.col(features.LABEL).cast("int"))
    train, _ = model.temporal_split(whole, CUTOFF)
    counted = model.train_propensity(rows, CUTOFF, rounds=3).model
    bins = counted.stages[0]
    assembler = VectorAssembler(inputCols=bins.getOutputCols(), outputCol="features")
    # plain numbers: the bucketizer marks its bins as categories without an order
    numbers = {c: F.col(c) + 0 for c in bins.getOutputCols()}
    every_row = assembler.transform(bins.transform(train).withColumns(numbers))
    plain = GBTClassifier(labelCol=features.LABEL, maxBins=model.BINS, maxIter=3, seed=17).fit(every_row)
    high = lambda m: [r[0][1] for r in m.transform(every_row.orderBy("id")).select("probability").collect()]
    assert high(counted.stages[-1]) == pytest.approx(high(plain), abs=1e-6)
    sizes = [r["count"] for r in bins.transform(train).groupBy("amount_paid_lifetime_bin").count().collect()]
    assert len(sizes) == model.BINS and min(sizes) > 0.9 * 20_000 / model.BINS


def test_cuts_lie_between_values():
    assert model.bin_cuts([3.0, 1.0, 1.0, 2.0]) == [1.5, 2.5]
    assert model.bin_cuts([7.0, 7.0]) == [7.0] and model.bin_cuts([]) == [0.0]
    assert len(model.bin_cuts([float(i) for i in range(1000)])) == model.BINS - 1
    often = model.bin_cuts([0.0] * 900 + [float(i) for i in range(1, 101)])
    assert often[0] == 0.5 and len(often) < model.BINS
