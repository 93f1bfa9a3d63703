"""Quality rules judged by document and by host (the document's ``source``).

Each document is measured in its own row with array functions: no shuffle, whatever its length.
Rule failures are then counted by host, each host's failure rate is shrunk towards the rate of all
hosts with a beta prior fitted to the hosts, and the verdict is joined back to the documents.

Edge cases. A NULL text has no words, so it fails the length rule. Hosts are compared NULL-safely: the
documents without a source form one host. Repeated rows are judged as they stand, each on its own.
An empty table gives an empty result. Only ``text`` and ``source`` are read from the row, so further
columns, also those named like a measure, pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.llm.common import WORD, bind, packed, staged, words_of

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 8
#: A host fails if its shrunken failure rate is more than so many standard deviations of the fitted prior
#: above the prior's mean, and at the latest above this share.
HOST_DEVIATIONS = 1.0
HOST_LIMIT = 0.5


def _pairs(hashes: Column, n: Column, step: int) -> Column:
    """Hash of every element together with the one ``step`` places later; ``n`` results."""
    n = F.greatest(n, F.lit(0))
    return F.zip_with(
        F.slice(hashes, 1, n), F.slice(hashes, 1 + step, n), lambda a, b: F.xxhash64(a, b)
    )


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more: sorted starts, each adding what is new."""

    def twice(pairs: Column) -> Column:
        def same(x: Column, i: Column) -> Column:
            return F.coalesce(F.get(pairs, i)["h"] == x["h"], F.lit(False))

        found = F.filter(pairs, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return F.array_sort(F.transform(found, lambda x: x["i"]))

    def length(starts: Column) -> Column:
        m = F.size(starts) - 1
        steps = F.zip_with(
            F.slice(starts, 1, m), F.slice(starts, 2, m), lambda a, b: F.least(b - a, F.lit(WINDOW))
        )
        return F.aggregate(steps, F.lit(WINDOW), lambda total, x: total + x)

    numbered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return bind(bind(numbered, twice), length)


def measured(docs: DataFrame, keep: Column) -> DataFrame:
    """``row`` (what ``keep`` names), ``host`` and the measures of every document.

    Repeats are found on 64-bit hashes of eight words; two different windows of one text share a
    hash with a chance of about 1 in 10^11 for a text of 20,000 words.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    n = F.col("n_words")
    # Each level is used twice by the next one, so Spark keeps these projections apart.
    return (
        packed(docs)
        .select(
            keep.alias("row"), F.col("row.source").alias("host"), text.alias("text"),
            words_of(text).alias("words"),
        )
        .withColumn("n_words", F.size("words"))
        .withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)))
        .withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("h2", _pairs(F.col("h1"), n - 1, 1))
        .withColumn("h4", _pairs(F.col("h2"), n - 3, 2))
        .withColumn("h8", _pairs(F.col("h4"), n - 7, 4))
        .select(
            "row",
            "host",
            n.cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", "")))
            .cast("long").alias("n_symbols"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.when(F.size(F.array_distinct("h8")) < F.size("h8"), _covered(F.col("h8")))
            .otherwise(0).cast("long").alias("n_repeat_words"),
        )
    )


def base_failed() -> Column:
    """Under 20 words, or over 30 % of the words in repeated windows."""
    n = F.col("n_words")
    return (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)


def rule_failed() -> Column:
    """Any rule that counts against the host: the base rules and three looser ones."""
    n = F.col("n_words")
    return (
        base_failed()
        | (10 * F.col("n_symbols") > n)
        | (100 * F.col("n_dup_lines") > 30 * F.col("n_lines"))
        | (F.col("word_chars") > 15 * n)
    )


def host_verdicts(
    measures: DataFrame, limit: float = HOST_LIMIT, deviations: float = HOST_DEVIATIONS
) -> DataFrame:
    """One row per host: documents, failures, shrunken rate, and whether the host fails.

    The prior is fitted by moments: mean ``m`` over all documents, and the variance ``v`` between
    the hosts' rates beyond what chance explains; its strength is ``m(1-m)/v - 1`` documents, held
    between 1 and 10,000 (hosts that do not differ are shrunk fully).

    The limit follows the prior: ``m + deviations * sqrt(m(1-m) / (strength + 1))``, at most ``limit``.
    A host of few documents stays near ``m`` and needs far more failures than one of many to pass it;
    where hosts differ by no more than chance, none does.
    """
    # used three times below, and the texts are measured only once for it
    hosts = staged(
        measures.groupBy("host").agg(
            F.count("*").alias("docs"), F.sum(rule_failed().cast("long")).alias("failures")
        ),
        "host-counts",
    )
    rate = F.col("failures") / F.col("docs")
    prior = (
        hosts.agg(
            (F.sum("failures") / F.sum("docs")).alias("m"),
            F.var_pop(rate).alias("between"),
            F.avg(1 / F.col("docs")).alias("per_doc"),
        )
        .withColumn("spread", F.col("m") * (1 - F.col("m")))
        .withColumn("v", F.col("between") - F.col("spread") * F.col("per_doc"))
        .select(
            "m",
            F.when(F.col("v") <= F.col("spread") / 10001, 10000.0)
            .otherwise(F.greatest(F.col("spread") / F.col("v") - 1, F.lit(1.0)))
            .alias("strength"),
        )
    )
    shrunk = (F.col("failures") + F.col("m") * F.col("strength")) / (
        F.col("docs") + F.col("strength")
    )
    deviation = F.sqrt(F.col("m") * (1 - F.col("m")) / (F.col("strength") + 1))
    bound = F.least(F.col("m") + deviations * deviation, F.lit(limit))
    return (
        hosts.withColumn("m", prior.select("m").scalar())
        .withColumn("strength", prior.select("strength").scalar())
        .select("host", "docs", "failures", shrunk.alias("host_rate"), bound.alias("host_limit"))
        .withColumn("host_failed", F.col("host_rate") > F.col("host_limit"))
    )


def judged(
    measures: DataFrame, limit: float = HOST_LIMIT, deviations: float = HOST_DEVIATIONS
) -> DataFrame:
    """The measures with ``base_failed``, ``host_rate`` and ``kept``.

    A document goes if it fails a base rule, or if it fails any rule and its host fails too: the
    verdict on a host never condemns a document that passes every rule.
    """
    # a written table has a known size: a small one is broadcast, so the texts are not shuffled
    hosts = staged(host_verdicts(measures, limit, deviations), "host-verdicts").select(
        F.col("host").alias("judged_host"), "host_rate", "host_failed"
    )
    return (
        measures.join(hosts, F.col("host").eqNullSafe(F.col("judged_host")), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~(F.col("base_failed") | (F.col("host_failed") & rule_failed())))
        .drop("judged_host", "host_failed")
    )
