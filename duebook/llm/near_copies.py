"""Near copies: HyperMinHash sketches, banded, estimated, and confirmed on the full shingle sets.

1. *Sketch.* Every document becomes ``bands * rows`` registers. A register keeps the smallest hash of
   its bucket as leading zeros and ten mantissa bits. Each bucket draws from all shingles by a
   permutation of its own, so that short texts fill every bucket as well.
2. *Equal sets.* Documents with the same shingle set (128-bit digest and size) are one node, the
   smallest id; copies cost no pair, however many there are.
3. *Bands.* Nodes that agree in all registers of a band meet in a bucket. First, every node is paired
   with the lead of its bucket only: a line of pairs, not a square. Pairs pass the Jaccard estimate
   (agreements corrected for chance collisions of registers) and are confirmed on their full sets.
4. *Rest.* After joining what is confirmed, only nodes of one bucket in different components can still
   be linked. They are compared by sketch in tiles of bounded size, all of them, and the nodes with a
   likely partner once more on their full sets. So no link among candidates is lost, and no group is
   expanded into pairs.

At the threshold itself a pair misses all bands with a chance of about 10^-6 or less (38 bands of 5),
and the estimate drops it with about 10^-7 (five standard deviations).

Edge cases. A NULL or empty text, or one of white space, has no shingles and is linked with nothing;
its component is its own id. Rows that share an id but not a text are one node for linking. Rows without an
id are linked with nothing, have no component, and are kept. An empty table gives an empty result. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duebook.llm.common import staged
from duebook.llm.hashing import mix, shingle_sets

MANTISSA = 10


@dataclass(frozen=True)
class Likeness:
    """Documents are linked if ``100 * intersection >= percent * union`` of their shingle sets."""

    words: int = 5
    percent: int = 80
    bands: int = 38
    rows: int = 5
    deviations: float = 5.0
    tile: int = 512
    seed: int = 7

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def least_estimate(self) -> float:
        share = self.percent / 100
        return share - self.deviations * (share * (1 - share) / self.registers) ** 0.5


def _sketcher(like: Likeness):
    random = np.random.default_rng(like.seed)
    factor = random.integers(1, 1 << 31, like.registers, dtype=np.uint32) * 2 + 1
    shift = random.integers(0, 1 << 32, like.registers, dtype=np.uint32)

    def sketch(hashes: np.ndarray) -> np.ndarray:
        low = np.full(like.registers, 0xFFFFFFFF, np.uint32)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(short), 512):
            block = short[at : at + 512, None] * factor + shift
            np.minimum(low, block.min(axis=0), out=low)
        bits = low.astype(np.float64).view(np.uint64)
        exponent = (bits >> np.uint64(52)).astype(np.int64) - 1023
        mantissa = (bits >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
        zeros = np.where(low == 0, 32, 31 - exponent)
        return ((zeros << MANTISSA) | mantissa.astype(np.int64)).astype("<u2")

    return sketch


def sketched(docs: DataFrame, like: Likeness) -> DataFrame:
    """``doc_id``, ``text_hash``, set size, set digest and registers of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = _sketcher(like)
        for batch in batches:
            sizes, ones, twos, registers = [], [], [], []
            for own in shingle_sets(batch["text"], like.words):
                sizes.append(len(own))
                ones.append(int(mix(own).sum(dtype=np.uint64).astype(np.int64)))
                twos.append(int(mix(own + np.uint64(77)).sum(dtype=np.uint64).astype(np.int64)))
                registers.append(sketch(own).tobytes() if len(own) else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_hash"],
                    pa.array(sizes, pa.int64()),
                    pa.array(ones, pa.int64()),
                    pa.array(twos, pa.int64()),
                    pa.array(registers, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "d1", "d2", "registers"],
            )

    return keyed(docs).mapInArrow(
        run,
        "doc_id long, text_hash long, n_shingles long, d1 long, d2 long, registers binary",
    )


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )


def _banded(nodes: DataFrame, like: Likeness) -> DataFrame:
    """(band, bucket, node) for every band of every node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, like.bands + 1, dtype=np.uint64))
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.frombuffer(b"".join(batch["registers"].to_pylist()), "<u2")
            rows = rows.reshape(-1, like.bands, like.rows).astype(np.uint64)
            key = np.broadcast_to(salt, rows.shape[:2])
            for j in range(like.rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, j])
            offsets = np.arange(0, key.size + 1, like.bands, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["node"],
                    pa.ListArray.from_arrays(offsets, pa.array(key.ravel().view(np.int64))),
                ],
                names=["node", "buckets"],
            )

    banded = nodes.select("node", "registers").mapInArrow(run, "node long, buckets array<long>")
    return banded.select(F.posexplode("buckets").alias("band", "bucket"), "node")


def _buckets(nodes: DataFrame, like: Likeness) -> DataFrame:
    """(band, bucket, node, lead) of every bucket with two nodes or more.

    The lead is the node that meets most others over all its buckets: the text that a group's copies
    were made from is close to all of them, while two copies differ in the edits of both. Pairs with
    the lead then connect a group that pairs with just any member would leave in pieces.
    """
    bands = _banded(nodes, like)
    sizes = bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = staged(bands.join(sizes, "bucket"), "near-copy-buckets")
    met = shared.groupBy("node").agg(F.sum("n").alias("met"))
    leads = (
        shared.join(met, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("met", (-F.col("node")).alias("least"))).alias("most"))
        .select("bucket", (-F.col("most.least")).alias("lead"))
    )
    return staged(shared.select("band", "bucket", "node").join(leads, "bucket"), "near-copy-leads")


def _likeness(same: np.ndarray) -> np.ndarray:
    """Jaccard similarity from agreeing registers, less the agreements that chance brings.

    Unequal minima share a register if they have the same leading zeros (about one in three for
    sets of like size) and the same mantissa bits.
    """
    chance = 1 / (3 << MANTISSA)
    return (same.mean(axis=-1) - chance) / (1 - chance)


def _likely(pairs: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """Pairs (a, b) whose estimate leaves the threshold possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch[c].to_pylist()), "<u2").reshape(-1, like.registers)
                for c in ("ra", "rb")
            )
            likely = pa.array(_likeness(left == right) >= like.least_estimate)
            yield batch.select(["a", "b"]).filter(likely)

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("registers").alias(f"r{name}"))

    return (
        pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "rb")
        .mapInArrow(run, "a long, b long")
    )


def _texts(asked: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the nodes asked for."""
    rows = (
        nodes.join(asked.select("node").distinct(), "node", "left_semi")
        .select(F.col("node").alias("doc_id"), "text_hash")
        .join(keyed(docs), ["doc_id", "text_hash"])
        .dropDuplicates(["doc_id"])
    )
    return staged(rows.select(F.col("doc_id").alias("node"), "text"), "near-copy-texts")


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, like: Likeness) -> DataFrame:
    """Pairs that reach the threshold on their full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            left = shingle_sets(batch["text_a"], like.words)
            right = shingle_sets(batch["text_b"], like.words)
            for one, two in zip(left, right):
                both = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(100 * both >= like.percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    texts = _texts(pairs.select(F.explode(F.array("a", "b")).alias("node")), nodes, docs)

    def side(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))

    return (
        pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
        .mapInArrow(run, "a long, b long")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is its smallest node.

    Large-star and small-star steps in turn: every node hands its neighbours to its smallest one,
    until the edges are stars. Each round is written to the shared folder, so plans stay short.
    """

    def state(stars: DataFrame):
        return stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()

    edges = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = state(edges)
    while seen[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lower.select("a", F.col("m").alias("b")))
        )
        edges = staged(small.where("a <> b").distinct(), "edges")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _suspects(shared: DataFrame, labels: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """Nodes that may still be linked across components: (bucket, i, j, tile, node, component).

    Buckets are compared by sketch in tiles, their leads left out (they have been compared with
    everyone). A node is a suspect in a tile if a likely partner of another component is there and
    no earlier band brings the two together. Nodes leave a tile, never pairs.
    """
    rows = (
        shared.where("node <> lead")
        .join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    mixed = (
        rows.groupBy("bucket")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("n"))
        .where("least < most")
        .select("bucket", F.ceil(F.col("n") / like.tile).cast("int").alias("tiles"))
    )
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    tiled = (
        rows.join(mixed, "bucket")
        .withColumn("tile", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "band", "bucket", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
            "tile", "node", "component",
        )
        .join(nodes.select("node", "registers"), "node")
    )

    def run(group: pa.Table) -> pa.Table:
        comp, tile = group["component"].to_numpy(), group["tile"].to_numpy()
        rows = np.frombuffer(b"".join(group["registers"].to_pylist()), "<u2")
        rows = rows.reshape(-1, like.registers)
        one, two = group["i"][0].as_py(), group["j"][0].as_py()
        right = np.flatnonzero(tile == two)
        suspect = np.zeros(len(tile), bool)
        for x in np.flatnonzero(tile == one):
            others = right[comp[right] != comp[x]]
            same = rows[others] == rows[x]
            likely = _likeness(same) >= like.least_estimate
            others, same = others[likely], same[likely]
            first = same.reshape(len(same), like.bands, like.rows).all(axis=2).argmax(axis=1)
            others = others[first == group["band"][0].as_py()]
            suspect[others] = True
            suspect[x] |= len(others) > 0
        return group.filter(pa.array(suspect)).select(
            ["bucket", "i", "j", "tile", "node", "component"]
        )

    kind = "bucket long, i int, j int, tile int, node long, component long"
    return tiled.groupBy("bucket", "i", "j").applyInArrow(run, kind)


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of a tile's sets, from blocks of their incidence matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    number = np.cumsum(np.diff(values, prepend=values[:1]) != 0)
    counts = np.zeros((len(sets), len(sets)))
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
        a, b = np.searchsorted(number, [at, at + 4096])
        block = np.zeros((len(sets), 4096), np.float32)
        block[owner[a:b], number[a:b] - at] = 1
        counts += block @ block.T
    return np.rint(counts).astype(np.int64)


def _linked_across(suspects: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """Links between components among the suspects of each tile, confirmed on full sets: (a, b).

    Of the links that join the same components one is returned, so a tile gives fewer links than nodes.
    """

    def run(group: pa.Table) -> pa.Table:
        node, comp, tile = (group[c].to_numpy() for c in ("node", "component", "tile"))
        sets = list(shingle_sets(group["text"], like.words))
        sizes = np.array([len(s) for s in sets])
        both = common_counts(sets)
        linked = 100 * both >= like.percent * (sizes[:, None] + sizes - both)
        linked &= comp[:, None] != comp
        root = {c: c for c in comp.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        found: list[tuple[int, int]] = []
        for x, y in zip(*(k.tolist() for k in np.nonzero(np.triu(linked)))):
            one, two = find(int(comp[x])), find(int(comp[y]))
            if one != two:
                root[max(one, two)] = min(one, two)
                found.append((int(node[x]), int(node[y])))
        return pa.table(
            {"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())}
        )

    return (
        suspects.join(texts, "node").groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long")
    )


def grouped(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``node`` (whose set the row shares) and
    ``component_id`` of every row."""
    sketches = staged(sketched(docs, like), "sketches")
    linkable = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    nodes = staged(
        linkable.groupBy("d1", "d2", "n_shingles")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("first"),
            F.first("registers").alias("registers"),
        )
        .select(
            F.col("first.doc_id").alias("node"), F.col("first.text_hash").alias("text_hash"),
            "d1", "d2", "n_shingles", "registers",
        ),
        "near-copy-nodes",
    )
    # rows of one id with different sets: their nodes are linked by the id
    members = linkable.join(nodes.select("d1", "d2", "n_shingles", "node"), ["d1", "d2", "n_shingles"])
    ids = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    same_id = members.join(ids.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b"))

    shared = _buckets(nodes, like)
    pairs = (
        shared.where("node <> lead")
        .select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct()
    )
    likely = staged(_likely(pairs, nodes, like), "near-copy-pairs")
    edges = staged(_confirmed(likely, nodes, docs, like).union(same_id), "near-copy-links")
    labels = components(edges)

    suspects = staged(_suspects(shared, labels, nodes, like), "near-copy-suspects")
    if not suspects.isEmpty():
        more = _linked_across(suspects, _texts(suspects, nodes, docs), like)
        labels = components(
            labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)
        )
    return (
        sketches.join(
            nodes.select("d1", "d2", "n_shingles", "node"), ["d1", "d2", "n_shingles"], "left"
        )
        .withColumn("node", F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id")))
        .join(labels.withColumnRenamed("component", "found"), "node", "left")
        .select(
            "doc_id", "text_hash", "n_shingles", "node",
            F.when(F.col("n_shingles") > 0, F.coalesce("found", "node"))
            .otherwise(F.col("doc_id")).alias("component_id"),
        )
    )


def one_of_each(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``docs`` with one row of every component; rows without shingles or without an id all stay."""
    groups = grouped(docs, like)
    first = groups.where("doc_id IS NULL OR n_shingles = 0 OR doc_id = component_id")
    # several rows may carry the id of the component: the one with the smallest text hash stays
    stays = staged(
        first.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy(F.col("doc_id").alias("k_id")).agg(F.min("text_hash").alias("k_hash"))
        .withColumn("once", F.lit(True))
        .union(
            first.where("doc_id IS NULL OR n_shingles = 0")
            .select("doc_id", "text_hash", F.lit(False)).distinct()
        ),
        "near-copy-stays",
    )
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).withColumns(
        {"d_id": F.col("row.doc_id").cast("long"), "d_hash": F.xxhash64("row.text")}
    )
    same = F.col("d_id").eqNullSafe(F.col("k_id")) & (F.col("d_hash") == F.col("k_hash"))
    place = F.row_number().over(Window.partitionBy("d_id", "d_hash").orderBy(F.lit(0)))
    return (
        rows.join(stays, same)
        .withColumn("place", F.when(F.col("once"), place).otherwise(1))
        .where("place = 1")
        .select("row.*")
    )
