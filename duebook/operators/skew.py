"""Measuring a skewed key and spreading it over several tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.operators.joins import join_large

SALT = "_salt"


def measure_skew(df: DataFrame, key: str, top_n: int = 10) -> DataFrame:
    """The ``top_n`` most frequent keys with their share of all rows. NULL is a key too."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return (
        counts.orderBy(F.desc("rows"), F.asc_nulls_first(key))
        .limit(top_n)
        .withColumn("share", F.col("rows") / total)
    )


def hot_keys(df: DataFrame, key: str, least_share: float, tracked: int = 10_000) -> DataFrame:
    """Every non-NULL key with at least ``least_share`` of the non-NULL rows: ``rows`` and ``share``, exact.

    A mergeable frequent-items sketch of at most ``tracked`` keys per task finds the candidates in one pass
    without a shuffle of rows; a key's estimate can be off by some 5 / ``tracked`` of all rows, so the
    candidates hold every key that is asked for. Only they are counted, exactly, in a second pass. There are
    at most 1 / ``least_share`` of them, so they are small enough to name in a plan.
    """
    if not 10 / tracked <= least_share <= 1:
        raise ValueError(f"{tracked} tracked keys find shares from {10 / tracked} to 1")
    present = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"))
    candidates = min(tracked, int(2 / least_share) + 1)
    sketch = F.expr(f"approx_top_k(_key, {candidates}, {tracked})")
    found = present.agg(sketch.alias("found")).first().found or []
    named = [entry["item"] for entry in found]
    counts = present.groupBy(F.when(F.col("_key").isin(named), F.col("_key")).alias(key)).agg(
        F.count(F.lit(1)).alias("rows")
    )
    total = F.sum("rows").over(Window.partitionBy())  # over the candidates' counts and one for the rest
    shares = counts.withColumn("share", F.col("rows") / total)
    return shares.where(F.col(key).isNotNull() & (F.col("share") >= least_share))


def _spread(df: DataFrame, n_salts: int, by: Sequence[str] | None) -> Column:
    """A bucket that is the same when a task is run again.

    The row hash separates different rows; the partition number separates identical copies,
    which would all share one hash. Neither depends on the order of rows in a partition.
    """
    row_hash = F.xxhash64(*[F.col(c) for c in by or df.columns])
    bucket = F.pmod(row_hash, F.lit(n_salts)) + F.pmod(F.spark_partition_id(), F.lit(n_salts))
    return F.pmod(bucket, F.lit(n_salts)).cast("int")


def add_salt(
    df: DataFrame,
    n_salts: int = 16,
    key: str | None = None,
    hot: Sequence | None = None,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``_salt``. With ``hot`` only those keys are spread and all others get salt 0.

    ``by`` names the columns to hash. The default hashes every column, which forces all of
    them to be read; name one column with many values to keep the scan narrow.
    """
    spread = _spread(df, n_salts, by)
    if hot is not None:
        spread = F.when(F.col(key).isin(*hot), spread).otherwise(F.lit(0))
    return df.withColumn(SALT, spread)


def explode_salt(
    df: DataFrame, n_salts: int = 16, key: str | None = None, hot: Sequence | None = None
) -> DataFrame:
    """Repeat each row once per salt (with ``hot``: only the rows of those keys)."""
    every = F.sequence(F.lit(0), F.lit(n_salts - 1))
    if hot is not None:
        every = F.when(F.col(key).isin(*hot), every).otherwise(F.array(F.lit(0)))
    return df.withColumn(SALT, F.explode(every))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    n_salts: int = 16,
    hot: Sequence | None = None,
    by: Sequence[str] | None = None,
    least_share: float | None = None,
) -> DataFrame:
    """Inner join on ``key`` with each hot key of ``big`` spread over ``n_salts`` tasks.

    Joins on the two columns (key, salt), not on a concatenated text, so NULL keys match
    nothing. Name the ``hot`` keys when they are known: then only their rows in ``small``
    are repeated. With ``least_share`` they are found: keys with that share of the rows of ``big``.
    """
    if hot is None and least_share is not None:
        hot = [row[key] for row in hot_keys(big, key, least_share).collect()]
        if not hot:
            return join_large(big, small, key)
    left = add_salt(big.where(F.col(key).isNotNull()), n_salts, key, hot, by)
    right = explode_salt(small.where(F.col(key).isNotNull()), n_salts, key, hot)
    return left.join(right, [key, SALT]).drop(SALT)


def aggregate_skewed(df: DataFrame, key: str, value: str, n_salts: int = 16) -> DataFrame:
    """sum, count, min, max and avg per key in two stages: per (key, salt), then per key."""
    partial = (
        add_salt(df.select(key, value), n_salts)
        .groupBy(key, SALT)
        .agg(
            F.sum(value).alias("_sum"),
            F.count(value).alias("_count"),
            F.min(value).alias("_min"),
            F.max(value).alias("_max"),
        )
    )
    total, count = F.sum("_sum"), F.sum("_count")
    return partial.groupBy(key).agg(
        total.alias(f"{value}_sum"),
        count.alias(f"{value}_count"),
        F.min("_min").alias(f"{value}_min"),
        F.max("_max").alias(f"{value}_max"),
        F.try_divide(total, count).alias(f"{value}_avg"),
    )
