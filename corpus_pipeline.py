"""From raw documents to token ids: quality rules, near copies, personal data, mixing, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm import host_rules, near_copies, personal_data, pieces, source_mix
from duebook.llm.catalog import TOKENIZERS
from duebook.llm.common import staged, table, unpacked
from duebook.session import bound_batches


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, unchanged.

    The measures are written beside the rows: hosts and verdicts both read them, and a filter on the
    verdict cannot be pushed below them, where it would compute every measure again.
    """
    measures = staged(host_rules.measured(docs, F.col("row")), "quality-measures")
    return unpacked(host_rules.judged(measures).where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five words, similarity 0.8)."""
    bound_batches(spark)
    return near_copies.one_of_each(docs)


def private_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind."""
    return personal_data.redacted(personal_data.detected(docs))


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, shuffled within the shards of the mix."""
    rows = source_mix.sized(docs, F.col("row"))
    return source_mix.drawn_rows(source_mix.mixed(rows)).select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether they decode to it."""
    bound_batches(spark)
    coded = pieces.encoded(docs, f"{TOKENIZERS}/piece_bpe_32k.model")
    return coded.select("row.doc_id", "row.source", "row.lang", "n_tokens", "round_trip", "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("private_spans", private_spans),
    ("target_mix", target_mix),
    ("token_ids", token_ids),
]

#: Sketches, a trained tagger and hash draws: SQL cannot state these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
