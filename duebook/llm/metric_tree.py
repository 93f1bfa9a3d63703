"""Exact top k by inner product with an M-tree: paged metric nodes and best-first search.

With one more component, sqrt(M^2 - |x|^2) for the longest vector's length M and 0 for a query, the
inner product decreases exactly as the Euclidean distance grows, so a metric tree can search it.

*Upper level*: a bounded sample of pivots (``Tree.pivots``) divides all vectors into cells with covering
radii. *Pages*: a cell is dealt into pages of about ``page`` vectors, so a cell of any size is many tasks'
work. *Nodes*: within its task, a page is loaded into nodes of at most ``node`` entries with a routing
object, a covering radius and every entry's distance to it. Queries first search one page of their own
cell, which gives a score to beat. With it they visit only cells, and there only nodes, whose radius
bound still allows that score, nearest first; in a node, entries whose stored distance rules them
out by the triangle inequality are skipped without being computed. Scores are exact integers.

Equal vectors are one entry with its k+1 smallest ids: of more copies none can reach a top k, so
nothing is lost. Every vector is indexed, and only the pivots are a sample.

Edge cases. Rows with a NULL id, a NULL vector, or a NULL or non-finite component take no part. Only
vectors of equal length are compared. Repeated rows count as rows of their own; a row is never its own
answer. Scores outside 64 bits are held at the limits. No candidates: no rows. An empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duebook.llm.common import staged

EXACT = float(1 << 53)
LOWEST = -(1 << 63)


@dataclass(frozen=True)
class Tree:
    k: int = 5
    pivots: int = 64
    page: int = 4096
    node: int = 64
    queries: int = 2048


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``v``, the floors of the scaled components, of the rows that take part."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"),
    )


def _key(v: Column) -> Column:
    return F.md5(F.array_join(v.cast("array<string>"), ","))


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: ``key``, ``dim``, ``v`` and its ``keep`` smallest ids."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return (
        rows.withColumn("place", place)
        .where(F.col("place") <= keep)
        .groupBy("v")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select(_key(F.col("v")).alias("key"), F.size("v").alias("dim"), "v", "ids")
    )


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column of one length as a matrix of integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that makes them all equally long."""
    x = x.astype(np.float64)
    rest = np.maximum(longest**2 - (x**2).sum(axis=1), 0)
    return np.column_stack([x, np.sqrt(rest)])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products, held within 64 bits."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    largest = float(np.abs(q.astype(np.float64)).max()) * float(np.abs(x.astype(np.float64)).max())
    if largest * q.shape[1] < EXACT:
        return np.rint(q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(exact, LOWEST, (1 << 63) - 1).astype(np.int64)


@dataclass
class Node:
    """Entries of one metric page, their distances to its routing object, and their largest."""

    members: np.ndarray
    parent_distance: np.ndarray
    radius: float


def nodes_of(points: np.ndarray, capacity: int) -> tuple[np.ndarray, list[Node]]:
    """Routing objects (indexes of points) and nodes; nodes that come out too full are cut."""
    count = max(1, -(-len(points) // capacity))
    routing = np.linspace(0, len(points) - 1, count).astype(np.int64)
    away = distances(points, points[routing])
    nearest = away.argmin(axis=1)
    objects, nodes = [], []
    for r in range(count):
        members = np.flatnonzero(nearest == r)
        members = members[np.argsort(away[members, r], kind="stable")]
        for at in range(0, len(members), 2 * capacity):
            own = members[at : at + 2 * capacity]
            nodes.append(Node(own, away[own, r], float(away[own, r].max())))
            objects.append(routing[r])
    return np.array(objects), nodes


def reach(norms: np.ndarray, longest: float, score: np.ndarray) -> np.ndarray:
    """The distance at which a query attains a score: what is farther away scores less."""
    return np.sqrt(np.maximum(norms**2 + longest**2 - 2 * score, 0)) + 1e-6 * (1 + longest + norms)


def search_page(
    q: np.ndarray, beat: np.ndarray, x: np.ndarray, first_id: np.ndarray, longest: float, tree: Tree
) -> tuple[np.ndarray, np.ndarray]:
    """Scores and entries (-1: none) of the best k+1 entries of a page for every query.

    Each query takes the nodes in the order of its own bounds; queries that are at the same node
    in the same turn are computed together. ``beat`` is a score that k+1 entries elsewhere reach.
    """
    want = tree.k + 1
    points = lifted(x, longest)
    targets = np.column_stack([q.astype(np.float64), np.zeros(len(q))])
    norms = np.sqrt((targets**2).sum(axis=1))
    objects, nodes = nodes_of(points, tree.node)
    away = distances(targets, points[objects])
    bound = np.maximum(away - np.array([n.radius for n in nodes]), 0)
    turns = np.argsort(bound, axis=1, kind="stable")
    best = np.full((len(q), want), float("-inf"))
    best_id = np.full((len(q), want), np.iinfo(np.int64).max)
    best_entry = np.full((len(q), want), -1)
    exact = np.full((len(q), want), LOWEST, np.int64)
    active = np.arange(len(q))
    for turn in range(len(nodes)):
        limit = reach(norms[active], longest, np.maximum(beat[active], best[active, -1]))
        near = bound[active, turns[active, turn]] <= limit
        active, limit = active[near], limit[near]
        if not len(active):
            break
        at = turns[active, turn]
        for number in np.unique(at):
            here = at == number
            who, node = active[here], nodes[number]
            gap = np.abs(away[who, number][:, None] - node.parent_distance)
            possible = gap <= limit[here][:, None]
            columns = np.flatnonzero(possible.any(axis=0))
            if not len(columns):
                continue
            entry = node.members[columns]
            score = products(q[who], x[entry])
            shown = np.where(possible[:, columns], score.astype(np.float64), float("-inf"))
            all_scores = np.concatenate([best[who], shown], axis=1)
            all_exact = np.concatenate([exact[who], score], axis=1)
            all_ids = np.concatenate(
                [best_id[who], np.broadcast_to(first_id[entry], shown.shape)], axis=1
            )
            all_entries = np.concatenate(
                [best_entry[who], np.broadcast_to(entry, shown.shape)], axis=1
            )
            all_entries[np.isneginf(all_scores)] = -1
            # doubles first (they rule entries out), whole numbers decide among large scores
            order = np.lexsort((all_ids, -all_scores), axis=1)
            if float(np.abs(score).max()) >= EXACT:
                order = np.lexsort((all_ids, ~all_exact, np.isneginf(all_scores)), axis=1)
            order = order[:, :want]
            best[who] = np.take_along_axis(all_scores, order, axis=1)
            exact[who] = np.take_along_axis(all_exact, order, axis=1)
            best_id[who] = np.take_along_axis(all_ids, order, axis=1)
            best_entry[who] = np.take_along_axis(all_entries, order, axis=1)
    return exact, best_entry


def _searched(visits: DataFrame, index: DataFrame, longest: float, tree: Tree) -> DataFrame:
    """The best entries of every visited page. Both sides of a task are bounded: a page, and a share
    of the queries that visit it (the page is read again for each share)."""
    place = ["dim", "cell", "page"]
    shares = visits.groupBy(*place).agg(F.ceil(F.count("*") / tree.queries).cast("int").alias("shares"))
    left = visits.join(shares, place).withColumn("share", F.pmod(F.xxhash64("key"), "shares").cast("int"))
    right = index.join(shares, place).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    names = ["key", "score", "first_id", "ids", "entry_key"]

    def run(asked: pa.Table, page: pa.Table) -> pa.Table:
        if not asked.num_rows or not page.num_rows:
            empty = [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string())]
            return pa.table(empty, names=names)
        dim = page["dim"][0].as_py()
        ids = page["ids"].combine_chunks()
        first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets.to_numpy()[0]]
        score, entry = search_page(
            matrix(asked["v"], dim), asked["beat"].to_numpy(), matrix(page["v"], dim), first, longest, tree
        )
        row, column = np.nonzero(entry >= 0)
        found = pa.array(entry[row, column])
        return pa.table(
            [
                asked["key"].combine_chunks().take(pa.array(row)),
                pa.array(score[row, column]),
                pa.array(first[entry[row, column]]),
                ids.take(found),
                page["key"].combine_chunks().take(found),
            ],
            names=names,
        )

    keys = [*place, "share"]
    return (
        left.select(*keys, "key", "v", "beat").groupBy(*keys)
        .cogroup(right.select(*keys, "key", "v", "ids").groupBy(*keys))
        .applyInArrow(run, "key string, score long, first_id long, ids array<long>, entry_key string")
    )


def _best(found: DataFrame, tree: Tree) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "first_id"))
    return found.withColumn("place", place).where(F.col("place") <= tree.k + 1)


def top_k(rows: DataFrame, asked: Column, tree: Tree = Tree()) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: for every row that ``asked`` selects, the k rows
    of highest inner product but itself, ties to the smaller id. ``rows`` comes from ``integers``."""
    vectors = staged(entries(rows, tree.k + 1), "tree-entries")
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest = float(vectors.agg(F.max(F.sqrt(squares))).first()[0] or 0.0)
    pivots = vectors.orderBy("key").limit(tree.pivots).select("dim", "v").collect()
    dims = sorted({p["dim"] for p in pivots})
    tops = {
        d: lifted(np.array([p["v"] for p in pivots if p["dim"] == d], np.int64).reshape(-1, d), longest)
        for d in dims
    }

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim = batch["dim"].to_numpy()
            cell, far = np.full(len(dim), -1, np.int32), np.zeros(len(dim))
            for d in set(dim.tolist()) & set(tops):
                own = np.flatnonzero(dim == d)
                away = distances(lifted(matrix(batch["v"].take(pa.array(own)), d), longest), tops[d])
                cell[own] = away.argmin(axis=1)
                far[own] = away.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["dim"], batch["v"], batch["ids"], pa.array(cell), pa.array(far)],
                names=["key", "dim", "v", "ids", "cell", "far"],
            )

    celled = vectors.mapInArrow(
        assign, "key string, dim int, v array<long>, ids array<long>, cell int, far double"
    )
    celled = staged(celled, "tree-cells")
    cells = staged(
        celled.groupBy("dim", "cell").agg(
            F.max("far").alias("radius"), F.ceil(F.count("*") / tree.page).cast("int").alias("pages")
        ),
        "tree-radii",
    )
    index = celled.join(cells.select("dim", "cell", "pages"), ["dim", "cell"]).withColumn(
        "page", F.pmod(F.xxhash64("key"), "pages").cast("int")
    )
    # at most one row for each pivot: cells without a pivot (a rare length) are always visited
    radii = {(r["dim"], r["cell"]): r["radius"] for r in cells.where("cell >= 0").collect()}

    wanted = rows.where(asked).withColumn("key", _key(F.col("v")))
    queries = wanted.groupBy("key").agg(F.first("v").alias("v")).withColumn("dim", F.size("v"))

    def route(only_own: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                beat = batch["beat"].to_numpy()
                dim = batch["dim"].to_numpy()
                near: list[list[int]] = [[-1]] * len(dim)
                for d in set(dim.tolist()) & set(tops):
                    own = np.flatnonzero(dim == d)
                    q = matrix(batch["v"].take(pa.array(own)), d).astype(np.float64)
                    away = distances(np.column_stack([q, np.zeros(len(q))]), tops[d])
                    radius = np.array([radii.get((d, c), -np.inf) for c in range(len(tops[d]))])
                    bound = np.where(np.isfinite(radius), np.maximum(away - radius, 0), np.inf)
                    if only_own:
                        chosen = bound == bound.min(axis=1, keepdims=True)
                        chosen &= np.cumsum(chosen, axis=1) == 1
                    else:
                        limit = reach(np.sqrt((q**2).sum(axis=1)), longest, beat[own])
                        chosen = bound <= limit[:, None]
                    for i, row in zip(own, chosen):
                        near[i] = [*np.flatnonzero(row).tolist(), *([] if only_own else [-1])]
                yield pa.RecordBatch.from_arrays(
                    [batch["key"], batch["dim"], batch["v"], batch["beat"], pa.array(near, pa.list_(pa.int32()))],
                    names=["key", "dim", "v", "beat", "cells"],
                )

        return run

    routed = "key string, dim int, v array<long>, beat double, cells array<int>"
    pages = cells.select("dim", "cell", "pages")
    seed_page = F.pmod(F.xxhash64("key"), F.col("pages")).cast("int")
    first_visits = (
        queries.withColumn("beat", F.lit(float("-inf"))).select("key", "dim", "v", "beat")
        .mapInArrow(route(True), routed)
        .withColumn("cell", F.explode("cells")).join(pages, ["dim", "cell"])
        .withColumn("page", seed_page)
    )
    first_visits = staged(first_visits, "tree-seeds")
    seeds = staged(_best(_searched(first_visits, index, longest, tree), tree), "tree-first")
    beats = seeds.where(F.col("place") == tree.k + 1).select("key", F.col("score").cast("double").alias("beat"))
    visits = (
        queries.join(beats, "key", "left")
        .withColumn("beat", F.coalesce("beat", F.lit(float("-inf")))).select("key", "dim", "v", "beat")
        .mapInArrow(route(False), routed)
        .withColumn("cell", F.explode("cells")).join(pages, ["dim", "cell"])
        .withColumn("page", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
        .join(first_visits.select("key", "dim", "cell", "page"), ["key", "dim", "cell", "page"], "left_anti")
    )
    visits = staged(visits, "tree-visits")
    found = _searched(visits, index, longest, tree).union(seeds.drop("place"))
    best = _best(found, tree)

    ids = F.col("ids")
    own = F.array_position(ids, F.col("query_id")).cast("int")
    others = F.when(
        (F.col("entry_key") == F.col("key")) & (own > 0),
        F.concat(F.slice(ids, 1, own - 1), F.slice(ids, own + 1, F.size(ids))),
    ).otherwise(ids)
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return (
        wanted.groupBy("key", F.col("vec_id").alias("query_id")).agg(F.count("*").cast("int").alias("times"))
        .join(best, "key")
        .select("query_id", "key", "times", "score", F.explode(others).alias("vec_id"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= tree.k)
        .withColumn("time", F.explode(F.sequence(F.lit(1), "times")))
        .select("query_id", "rank", "vec_id", "score")
    )
