"""Small helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.sources.storage import shared_folder

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame) -> DataFrame:
    """The whole row as one struct column ``row``: no other name can then clash with a new column."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` names it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Written once to the folder all executors share and read from there: recomputed by nobody."""
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def words_of(text: Column) -> Column:
    """Runs of characters other than white space; none for a NULL text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
