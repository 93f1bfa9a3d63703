"""Mixing sources to target weights by a multivariate hypergeometric splitting tree.

Words of a source are laid on one line in a hash order of its documents and cut into blocks of equal
length. The target of a source is a quota of its blocks: whole epochs over all of them and one partial
epoch. A binary tree over the output shards splits the quotas: each node draws, source after source,
how many of its blocks go left (hypergeometric, without replacement), until every shard holds an exact
count per source. Block instances are numbered by a permutation of each epoch, so consecutive ranges
of numbers give the shards disjoint, permuted blocks; each shard is then shuffled by a hash.

Only the quotas per source and shard are a table of their own (sources x shards rows). Blocks are never
listed: a document finds its blocks, their permuted numbers and their shards by arithmetic.

Edge cases. A NULL or empty text has no words and is never taken. A NULL source is a source of its own,
sorted last. Documents longer than a block are taken in parts. Equal rows share one order key and get
interchangeable places. Without any word every target is 0; an empty table gives an empty result. All
draws come from hashes of ids and a seed, so a rerun gives the same mix.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duebook.llm.common import WORD, bind, packed, staged


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in code point order; ``share`` is of all words."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    most: float = 2.0
    block_words: int = 1024
    blocks_at_least: int = 256
    tree_levels: int = 5
    bucket_docs: int = 1024
    seed: int = 17


#: Multipliers of the block permutation: primes above any number of blocks, hence coprime to it.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563)
MOST_BLOCKS = 1 << 30


def sized(docs: DataFrame, keep: Column) -> DataFrame:
    """``row`` (what ``keep`` names), ``source``, ``doc_id`` and ``size`` in words."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return packed(docs).select(
        keep.alias("row"),
        F.col("row.source").alias("source"),
        F.col("row.doc_id").alias("doc_id"),
        F.regexp_count(text, F.lit(f"{WORD}+")).cast("long").alias("size"),
    )


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _log_factorial(x: Column) -> Column:
    big = F.greatest(x, F.lit(1.0))
    stirling = (
        big * F.log(big) - big + F.log(2 * pi * big) / 2 + 1 / (12 * big) - 1 / (360 * big**3)
    )
    return F.when(x <= 20, F.log(F.factorial(F.least(x, F.lit(20.0)).cast("int")).cast("double"))).otherwise(stirling)


def _log_choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``good`` items are among ``drawn`` out of ``total``: the inverse of the
    distribution function at ``u``, summed over 8 standard deviations around the mean."""
    rest = F.greatest(total - 1, F.lit(1.0))
    safe = F.greatest(total, F.lit(1.0))
    mean = drawn * good / safe
    spread = 8 * F.sqrt(mean * (1 - good / safe) * (total - drawn) / rest) + 1
    low = F.greatest(F.lit(0.0), drawn + good - total, F.floor(mean - spread).cast("double"))
    high = F.least(drawn, good, F.ceil(mean + spread).cast("double"))

    def walk(ends: Column) -> Column:
        a, b = ends["a"], ends["b"]
        first = F.exp(
            _log_choose(good, a) + _log_choose(total - good, drawn - a) - _log_choose(total, drawn)
        )
        start = F.struct(
            u.alias("left"), first.alias("p"), a.alias("x"), F.lit(False).alias("found")
        )

        def step(s: Column, x: Column) -> Column:
            x = x.cast("double")
            after = (
                s["p"] * (good - x) * (drawn - x) / ((x + 1) * (total - good - drawn + x + 1))
            )
            return F.struct(
                (s["left"] - s["p"]).alias("left"),
                F.when(x < b, after).otherwise(0.0).alias("p"),
                F.when(s["found"], s["x"]).otherwise(x).alias("x"),
                (s["found"] | (s["left"] <= s["p"])).alias("found"),
            )

        return F.aggregate(F.sequence(a.cast("long"), b.cast("long")), start, step)["x"]

    return F.when(low >= high, high).otherwise(
        bind(F.struct(low.alias("a"), high.alias("b")), walk)
    )


def _split(counts: Column, node: Column, level: int, seed: int) -> Column:
    """Counts that go to the left child: half of the node's blocks, drawn without replacement."""

    def draw(state: Column, good: Column) -> Column:
        u = _uniform(F.lit(seed), F.lit(level), node, F.size(state["taken"]))
        return bind(
            F.struct(hypergeometric(state["total"], good, state["open"], u).alias("x")),
            lambda d: F.struct(
                (state["total"] - good).alias("total"),
                (state["open"] - d["x"]).alias("open"),
                F.concat(state["taken"], F.array(d["x"])).alias("taken"),
            ),
        )

    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    start = F.struct(
        total.alias("total"),
        F.floor(total / 2).cast("double").alias("open"),
        F.array().cast("array<double>").alias("taken"),
    )
    return F.aggregate(counts, start, draw)["taken"]


def targets(totals: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row: ``sources``, an array of (at, source, words, docs, weight, target), in order.

    The list of sources comes with a weight for each, so it is of a size that people configure.
    Sources are filled in the order in which they reach their cap; each takes its share of what is
    left, which is the same as resharing the excess until nobody is above the cap.
    """
    weights = F.array(*(F.lit(float(w)) for w in mix.weights))
    ordered = F.array_sort(
        F.collect_list(F.struct(F.col("source").isNull().alias("none"), "source", "words", "docs"))
    )

    def fill(state: Column, x: Column) -> Column:
        share = F.when(state["weight"] > 0, state["left"] * x["weight"] / state["weight"])
        take = F.least(F.coalesce(share, F.lit(0.0)), x["cap"])
        return F.struct(
            F.greatest(state["left"] - take, F.lit(0.0)).alias("left"),
            (state["weight"] - x["weight"]).alias("weight"),
            F.concat(
                state["done"], F.array(F.struct(x["at"].alias("at"), take.alias("target")))
            ).alias("done"),
        )

    numbered = F.transform(
        "sources",
        lambda x, i: F.struct(
            i.alias("at"),
            x["source"].alias("source"),
            x["words"].alias("words"),
            x["docs"].alias("docs"),
            F.get(weights, i % len(mix.weights)).alias("weight"),
            (mix.most * x["words"].cast("double")).alias("cap"),
        ),
    )
    by_cap = F.array_sort(
        F.transform(
            "sources",
            lambda x: F.struct(
                (x["cap"] / x["weight"]).alias("full"),
                x["at"].alias("at"),
                x["weight"].alias("weight"),
                x["cap"].alias("cap"),
            ),
        )
    )
    start = F.struct(
        (mix.share * F.col("all_words")).cast("double").alias("left"),
        F.aggregate("sources", F.lit(0.0), lambda s, x: s + x["weight"]).alias("weight"),
        F.array().cast("array<struct<at:int,target:double>>").alias("done"),
    )
    return (
        totals.agg(ordered.alias("sources"), F.coalesce(F.sum("words"), F.lit(0)).alias("all_words"))
        .withColumn("sources", numbered)
        .withColumn("by_cap", by_cap)
        .withColumn("done", F.array_sort(F.aggregate("by_cap", start, fill)["done"]))
        .select(
            F.zip_with(
                "sources", "done", lambda x, d: x.withField("target", d["target"])
            ).alias("sources")
        )
    )


def plan(totals: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per source: target, blocks, epochs, and where each shard's block numbers begin."""
    words, blocks = F.col("words"), F.col("blocks")
    block = F.greatest(
        F.lit(1),
        F.least(F.lit(mix.block_words), F.floor(words / mix.blocks_at_least)),
        F.ceil(words / MOST_BLOCKS),
    ).cast("long")
    per_source = (
        targets(totals, mix)
        .select(F.inline("sources"))
        .withColumn("block", block)
        .withColumn("blocks", F.ceil(words / F.col("block")).cast("long"))
        .withColumn("asked", F.round("target").cast("long"))
        .withColumn("epochs", F.when(words > 0, F.floor(F.col("asked") / words)).otherwise(0).cast("long"))
        .withColumn("rest", F.col("asked") - F.col("epochs") * words)
        .withColumn("chosen", F.ceil(F.col("rest") / F.col("block")).cast("long"))
        .withColumn("quota", F.col("epochs") * blocks + F.col("chosen"))
        .select("at", "source", "words", "docs", "target", "block", "blocks", "epochs", "rest", "chosen", "quota")
    )
    nodes = per_source.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("at", F.col("quota").cast("double").alias("n")))),
            lambda x: x["n"],
        ).alias("counts")
    ).select(F.lit(0).cast("long").alias("node"), "counts")
    for level in range(mix.tree_levels):
        nodes = nodes.withColumn("left", _split(F.col("counts"), F.col("node"), level, mix.seed)).select(
            F.inline(
                F.array(
                    F.struct((2 * F.col("node")).alias("node"), F.col("left").alias("counts")),
                    F.struct(
                        (2 * F.col("node") + 1).alias("node"),
                        F.zip_with("counts", "left", lambda a, b: a - b).alias("counts"),
                    ),
                )
            )
        )
    shards = nodes.select("node", F.posexplode("counts").alias("at", "n"))
    before = F.sum("n").over(
        Window.partitionBy("at").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    )
    begins = (
        shards.withColumn("begin", F.coalesce(before, F.lit(0.0)).cast("long"))
        .groupBy("at")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("node", "begin"))), lambda x: x["begin"]
            ).alias("begins")
        )
    )
    return per_source.join(begins, "at")


def _number(block: Column, epoch: Column, mix: Mix) -> Column:
    """Permuted number of a block within an epoch; a shorter last block keeps the last number."""
    full = F.greatest(F.col("blocks") - 1, F.lit(1))
    pick = F.pmod(F.xxhash64(F.lit(mix.seed), F.col("at"), epoch), F.lit(len(PRIMES))).cast("int")
    factor = F.get(F.array(*(F.lit(p) for p in PRIMES)), pick).cast("long")
    shift = F.pmod(F.xxhash64(F.lit(mix.seed + 1), F.col("at"), epoch), full)
    return F.when(block >= F.col("blocks") - 1, F.col("blocks") - 1).otherwise(
        F.pmod(F.pmod(block * factor, full) + shift, full)
    )


def mixed(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``row``, ``size``, ``source_size``, ``target``, ``taken`` and ``parts`` of every document.

    A part is (shard, turn, epoch, begin, words): ``words`` words of the document from word ``begin``
    on; ``turn`` is its place in the shard's shuffle. ``rows`` comes from ``sized``.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    sources = staged(plan(totals, mix), "mix-plan")
    lines = sources.select(
        "at",
        F.col("source").alias("plan_source"),
        F.ceil(F.col("docs") / mix.bucket_docs).cast("long").alias("buckets"),
    )
    order = F.xxhash64(F.lit(mix.seed), "doc_id", "size")
    bucketed = (
        rows.join(lines, F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumn("order", order)
        .withColumn("bucket", F.pmod(F.xxhash64(F.lit(mix.seed + 2), "doc_id", "size"), "buckets"))
        .select("row", "at", "doc_id", "size", "order", "bucket")
    )
    offsets = (
        bucketed.groupBy("at", "bucket")
        .agg(F.sum("size").alias("bucket_size"))
        .select(
            F.col("at").alias("b_at"),
            F.col("bucket").alias("b_bucket"),
            (
                F.sum("bucket_size").over(
                    Window.partitionBy("at").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
                )
                - F.col("bucket_size")
            ).alias("offset"),
        )
    )
    inside = Window.partitionBy("at", "bucket").orderBy("order", "doc_id", "size")
    until = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = (
        bucketed.withColumn("until", until)
        .join(offsets, (F.col("at") == F.col("b_at")) & (F.col("bucket") == F.col("b_bucket")))
        .select("row", "at", "size", (F.col("offset") + F.col("until") - F.col("size")).alias("p"))
    )
    by_source = sources.select(
        F.col("at").alias("s_at"), F.col("words").alias("source_size"), "target",
        "block", "blocks", "epochs", "rest", "chosen", "begins",
    )
    block, size, p = F.col("block"), F.col("size"), F.col("p")

    def part(epoch: Column, b: Column) -> Column:
        def cut(number: Column) -> Column:
            whole = epoch < F.col("epochs")
            limit = (
                F.when(whole | (number < F.col("chosen") - 1), block)
                .when(number == F.col("chosen") - 1, F.col("rest") - number * block)
                .otherwise(0)
            )
            begin = F.greatest(p, b * block)
            words = F.least(p + size, b * block + limit) - begin
            at = epoch * F.col("blocks") + number
            return F.struct(
                (F.size(F.filter("begins", lambda x: x <= at)) - 1).alias("shard"),
                F.xxhash64(F.lit(mix.seed + 3), F.col("at"), epoch, b).alias("turn"),
                epoch.cast("int").alias("epoch"),
                (begin - p).alias("begin"),
                words.alias("words"),
            )

        return bind(_number(b, epoch, mix), cut)

    last = F.when(F.col("rest") > 0, F.col("epochs")).otherwise(F.col("epochs") - 1)
    spans = F.sequence(F.floor(p / block), F.floor((p + size - 1) / block))
    parts = F.when(
        (size > 0) & (last >= 0),
        F.filter(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0))),
                    lambda e: F.transform(spans, lambda b: part(e, b)),
                )
            ),
            lambda x: x["words"] > 0,
        ),
    )
    kind = "array<struct<shard:int,turn:bigint,epoch:int,begin:bigint,words:bigint>>"
    return (
        placed.join(by_source, F.col("at") == F.col("s_at"))
        .withColumn("parts", F.coalesce(parts, F.array().cast(kind)))
        .select(
            "row", "size", "source_size", "target",
            F.aggregate("parts", F.lit(0).cast("long"), lambda s, x: s + x["words"]).alias("taken"),
            "parts",
        )
    )


def drawn_rows(mixture: DataFrame) -> DataFrame:
    """The mix itself: the taken pieces of every document, grouped by shard and shuffled there.

    ``row.text`` becomes the piece and ``row.n_chars`` its length. Blocks of one epoch that follow each
    other in the document travel together to the shard of the first: a document taken whole stays whole.
    """
    joined = F.aggregate(
        F.array_sort(F.transform("parts", lambda x: F.struct(x["epoch"], x["begin"], x["words"], x["shard"], x["turn"]))),
        F.array().cast("array<struct<epoch:int,begin:bigint,words:bigint,shard:int,turn:bigint>>"),
        lambda done, x: F.when(
            (F.size(done) > 0)
            & (F.get(done, F.size(done) - 1)["epoch"] == x["epoch"])
            & (F.get(done, F.size(done) - 1)["begin"] + F.get(done, F.size(done) - 1)["words"] == x["begin"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        x["epoch"].alias("epoch"),
                        F.get(done, F.size(done) - 1)["begin"].alias("begin"),
                        (F.get(done, F.size(done) - 1)["words"] + x["words"]).alias("words"),
                        F.get(done, F.size(done) - 1)["shard"].alias("shard"),
                        F.get(done, F.size(done) - 1)["turn"].alias("turn"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    # each element: white space before a word, and the word
    pieces = F.split("row.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.when(F.col("words") == F.col("size"), F.col("row.text")).otherwise(
        F.array_join(F.slice(pieces, F.col("begin").cast("int") + 1, F.col("words").cast("int")), "")
    )
    return (
        mixture.select("row", "size", F.inline(joined))
        .withColumn("row", F.col("row").withField("text", text))
        .withColumn("row", F.col("row").withField("n_chars", F.length("row.text").cast("long")))
        .repartition("shard")
        .sortWithinPartitions("shard", "turn")
    )
