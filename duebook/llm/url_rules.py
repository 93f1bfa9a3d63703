"""URL filter: pattern rules found through their rarest literal token.

A rule is a pattern over ``host + path``: literal text with ``*`` for any characters. Its literal tokens
(runs of letters and digits that a match must contain whole) are looked up in the token counts of
all URLs, and the rule is filed under the one that fewest URLs hold. A URL fetches the rules filed under
its own tokens, and only those run their regular expression; rules without a whole token are filed
under the empty token, which every URL holds.

A *site* rule (``net/``, ``example.net/en/``) fits its host and all subdomains of it where the path
begins like the rule's; a *pattern* rule (``|``-less, ``*`` allowed) fits anywhere. Among fitting site
rules the longest decides. Only where none fits, the pattern rules decide: a fitting ``allow`` beats a
fitting ``block``, and without any the URL is allowed.

Edge cases. A NULL URL, or one without ``://``, has an empty host and path and no tokens; no site rule
fits it and it is allowed. Equal URLs are judged once and each row gets the verdict. Two rules of one
length that both fit: the smaller text, then ``allow``. An empty table, or no rules at all, is fine.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duebook.llm.common import lower_ascii


@dataclass(frozen=True)
class Rule:
    """``kind`` is ``site`` or ``pattern``; ``verdict`` is ``allow`` or ``block``."""

    text: str
    verdict: str
    kind: str = "pattern"


#: The site rules of the query, and its patterns for pages that are not prose.
SITE_RULES = (
    Rule("net/", "block", "site"),
    Rule("example.net/en/", "allow", "site"),
    Rule("example.com/de/", "block", "site"),
    Rule("org/fr/", "allow", "site"),
)
PATTERN_RULES = (
    Rule("/login/", "block"),
    Rule("/cart/", "block"),
    Rule("/search/*/page/", "block"),
    Rule("/tag/", "block"),
    Rule("blog.*/es/", "block"),
    Rule("/wp-admin/", "block"),
    Rule("/docs/", "allow"),
    Rule(".zip", "block"),
)
TOKEN = r"[a-z0-9]+"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def expression(rule: Rule) -> str:
    """The rule as a regular expression over host and path."""
    body = ".*".join(re.escape(x) for x in rule.text.split("*"))
    return rf"\A(?:[^/]*\.)?{body}" if rule.kind == "site" else body


def literal_tokens(rule: Rule) -> list[str]:
    """Tokens that every match holds whole: bounded by other literal characters or the rule's anchor.

    A site rule begins at a host label, so its first token is whole; an end is whole only before
    a literal character that is no token character.
    """
    found = []
    for match in re.finditer(TOKEN, rule.text.lower()):
        begin, end = match.span()
        starts = rule.text[begin - 1] != "*" if begin else rule.kind == "site"
        if starts and end < len(rule.text) and rule.text[end] != "*":
            found.append(match.group())
    return sorted(set(found))


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = [
        (r.text, r.verdict, r.kind, expression(r), literal_tokens(r)) for r in dict.fromkeys(rules)
    ]
    schema = "rule string, verdict string, kind string, regex string, tokens array<string>"
    return spark.createDataFrame(rows, schema)


def filed(rules: DataFrame, url_tokens: DataFrame) -> DataFrame:
    """Every rule under its rarest token: the one that fewest URLs of the corpus hold."""
    tokens = rules.select("*", F.explode_outer("tokens").alias("token"))
    held = url_tokens.join(
        tokens.where("token IS NOT NULL").select("token").distinct(), "token", "left_semi"
    )
    counts = held.groupBy("token").agg(F.count("*").alias("urls"))
    rarest = Window.partitionBy("kind", "rule", "verdict").orderBy(
        F.coalesce("urls", F.lit(0)), "token"
    )
    return (
        tokens.join(counts, "token", "left")
        .withColumn("place", F.row_number().over(rarest))
        .where("place = 1")
        .select("rule", "verdict", "kind", "regex", F.coalesce("token", F.lit("")).alias("token"))
    )


def judged(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``pages`` (any columns, one of them ``url``) as ``row`` with host, path, rule and verdict."""
    spark = pages.sparkSession
    urls = pages.select("url").where(F.col("url").contains("://")).distinct()
    urls = urls.select("url", F.concat(host_of(F.col("url")), path_of(F.col("url"))).alias("address"))
    words = F.regexp_extract_all(lower_ascii(F.col("address")), F.lit(f"({TOKEN})"))
    tokens = urls.select("url", "address", F.explode(F.array_distinct(words)).alias("token"))
    every = urls.select("url", "address", F.lit("").alias("token"))
    index = filed(rule_table(spark, rules), tokens)
    hits = (
        tokens.union(every)
        .join(index, "token")
        .where(F.expr("address rlike regex"))
        .groupBy("url")
        .agg(
            F.min(
                F.when(
                    F.col("kind") == "site",
                    F.struct((-F.length("rule")).alias("rank"), "rule", "verdict"),
                )
            ).alias("site"),
            F.min(F.when(F.col("kind") == "pattern", F.col("verdict"))).alias("pattern"),
        )
        .select(F.col("url").alias("hit_url"), "site", "pattern")
    )
    return (
        pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("row"))
        .join(hits, F.col("row.url") == F.col("hit_url"), "left")
        .select(
            "row",
            host_of(F.col("row.url")).alias("host"),
            path_of(F.col("row.url")).alias("path"),
            F.col("site.rule").alias("rule"),
            F.coalesce("site.verdict", "pattern", F.lit("allow")).alias("verdict"),
        )
    )
