"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and how often.

1. A task encodes its documents with both vocabularies, cuts them where tokens of both end, and collects one
   record per pair of identifiers and document. Full buffers become *runs*: sorted by radix of the first
   identifier, then side-major (first identifier, second, document), and packed with zstd. A run is a directory
   (its pairs, and how many documents have each) and the records behind it.
2. Directories alone are counted. A tree of k-way heap merges joins at most ``FAN_IN`` of them at a time,
   per radix, until one is left. The heap goes from first identifier to first identifier, so that all pairs of
   one are together and their maximum is known before the next. A frequent pair is one entry of a
   directory, however many documents have it.
3. The answers (count, and whether it is the highest of its first identifier) go down the same tree to the runs
   in the order of their directories, and each run streams them back over its records: one sum per document.

Documents, records and directories are in written tables between the steps. Nothing is limited: documents with
more links than a buffer holds become runs of several segments.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from duebook.llm.best_fit_packing import batches_of
from duebook.llm.common import packed, staged
from duebook.llm.word_cache import byte_level, byte_tokens, piece_level, piece_tokens

RADIX_BITS = 6
FAN_BITS = 6
FAN_IN = 1 << FAN_BITS
#: Links in a buffer before it becomes a run; a documented size, not a limit.
BUFFER = 1 << 22
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_BATCH_CHARACTERS = 1 << 20


def squeezed(values: np.ndarray) -> bytes:
    """Non-negative numbers in the narrowest unsigned type that holds them, packed with zstd."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + zstandard.compress(values.astype(kind).tobytes(), 1)


def loosened(content: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(content[1:]), f"<u{content[0]}").astype(np.int64)


def _rising(values: np.ndarray) -> bytes:
    """Sorted numbers, as differences."""
    return squeezed(np.diff(values, prepend=0))


class Layout(NamedTuple):
    """Bits of a key: radix of the first identifier, the rest of it, the second identifier, the document."""

    a_bits: int
    b_bits: int

    @property
    def doc_bits(self) -> int:
        return 63 - self.a_bits - self.b_bits

    @staticmethod
    def of(n_a: int, n_b: int) -> Layout:
        return Layout(max(RADIX_BITS, int(n_a - 1).bit_length()), max(1, int(n_b - 1).bit_length()))

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low = a & ((1 << RADIX_BITS) - 1)
        return (((low << (self.a_bits - RADIX_BITS)) | (a >> RADIX_BITS)) << self.b_bits) | b

    def identifiers(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        side, b = pair >> self.b_bits, pair & ((1 << self.b_bits) - 1)
        rest = self.a_bits - RADIX_BITS
        return ((side & ((1 << rest) - 1)) << RADIX_BITS) | (side >> rest), b

    def radix_borders(self, pairs: np.ndarray) -> np.ndarray:
        width = 1 << (self.a_bits - RADIX_BITS + self.b_bits)
        return np.searchsorted(pairs, np.arange((1 << RADIX_BITS) + 1, dtype=np.int64) * width)


class Aligned(NamedTuple):
    """Tokens of some documents, and the groups that common borders cut them into."""

    a: np.ndarray
    b: np.ndarray
    a_per_group: np.ndarray
    b_per_group: np.ndarray
    a_per_doc: np.ndarray
    b_per_doc: np.ndarray
    groups_per_doc: np.ndarray
    links_per_doc: np.ndarray


def _by_borders(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over consecutive stretches of ``counts`` entries, some of them empty."""
    ends = np.cumsum(counts)
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[ends - counts]


class Aligner:
    """Both encoders and what their identifiers stand for. NULL texts count as empty."""

    def __init__(self, byte_vocabulary: str, piece_model: str):
        self._a = byte_level(byte_vocabulary, special_as_text=True, prefix=" ")
        self._b = piece_level(piece_model)
        self._bytes = byte_tokens(byte_vocabulary), piece_tokens(piece_model)
        self._lengths = tuple(np.array([len(t) for t in tokens]) for tokens in self._bytes)
        self.layout = Layout.of(len(self._bytes[0]), len(self._bytes[1]))
        numbers = np.array([str(i) for i in range(max(map(len, self._bytes)))], object)
        self._texts = {mark: numbers + mark for mark in ",|;"}

    def _lossless(self, side: int, ids: np.ndarray, counts: np.ndarray, wanted: list[bytes]) -> np.ndarray:
        """Which documents the tokens give back byte for byte."""
        lengths = _by_borders(self._lengths[side][ids], counts)
        good = lengths == np.array([len(w) for w in wanted])
        whole = b"".join(map(self._bytes[side].__getitem__, ids.tolist()))
        if good.all() and whole == b"".join(wanted):
            return good
        ends = np.cumsum(lengths).tolist()
        found = (whole[a:b] for a, b in zip([0, *ends], ends))
        return np.array([f == w for f, w in zip(found, wanted)])

    def align(self, texts: Sequence[str]) -> Aligned:
        sides = [*self._a.encode(texts), *self._b.encode(texts)]
        wanted = [b" " + t.encode() for t in texts]
        good = np.array([t != "" for t in texts])
        for side in (0, 1):
            good &= self._lossless(side, sides[2 * side], sides[2 * side + 1], wanted)
        (a, n_a), (b, n_b) = (
            (ids[np.repeat(good, counts)], counts * good) for ids, counts in (sides[:2], sides[2:])
        )
        ends_a, ends_b = np.cumsum(self._lengths[0][a]), np.cumsum(self._lengths[1][b])
        partner = np.searchsorted(ends_b, ends_a)
        closes = ends_b[np.minimum(partner, len(ends_b) - 1)] == ends_a if len(b) else np.zeros(0, bool)
        a_per_group = np.diff(np.flatnonzero(closes), prepend=-1)
        b_per_group = np.diff(partner[closes], prepend=-1)
        groups = _by_borders(closes.astype(np.int64), n_a)
        links = _by_borders(a_per_group * b_per_group, groups)
        return Aligned(a.astype(np.int64), b.astype(np.int64), a_per_group, b_per_group, n_a, n_b, groups, links)

    def digests(self, x: Aligned) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every document as SHA-256 in hexadecimal; '' without tokens."""
        group_a = np.repeat(np.arange(len(x.a_per_group)), x.a_per_group)
        group_b = np.repeat(np.arange(len(x.b_per_group)), x.b_per_group)
        before_b = np.cumsum(x.b_per_group) - x.b_per_group
        place_a = np.arange(len(x.a)) + before_b[group_a]
        place_b = np.arange(len(x.b)) + np.cumsum(x.a_per_group)[group_b]
        parts = np.empty(len(x.a) + len(x.b), object)
        parts[place_a] = self._texts[","][x.a]
        parts[place_b] = self._texts[","][x.b]
        last_a, last_b = np.cumsum(x.a_per_group) - 1, np.cumsum(x.b_per_group) - 1
        parts[place_a[last_a]] = self._texts["|"][x.a[last_a]]
        parts[place_b[last_b]] = self._texts[";"][x.b[last_b]]
        ends = np.cumsum(x.a_per_doc + x.b_per_doc).tolist()
        texts = ("".join(parts[s:e].tolist())[:-1] for s, e in zip([0, *ends], ends))
        return [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as often as its count says."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def links_of(layout: Layout, x: Aligned, first: int, last: int, ordinal: int) -> np.ndarray:
    """Keys (pair, document) of all links of the documents ``first`` to ``last``, unsorted."""
    groups = np.cumsum(x.groups_per_doc)
    g0, g1 = groups[first] - x.groups_per_doc[first], groups[last - 1]
    n_a, n_b = x.a_per_group[g0:g1], x.b_per_group[g0:g1]
    a0, b0 = x.a_per_doc[:first].sum(), x.b_per_doc[:first].sum()
    a = x.a[a0 : a0 + n_a.sum()]
    per_token = np.repeat(n_b, n_a)
    b = x.b[b0 + _spread(np.repeat(np.cumsum(n_b) - n_b, n_a), per_token)]
    document = np.repeat(np.arange(ordinal, ordinal + last - first), x.links_per_doc[first:last])
    return (layout.pair(np.repeat(a, per_token), b) << layout.doc_bits) | document


def links_in_segments(
    layout: Layout, x: Aligned, doc: int, ordinal: int, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(sorted keys, how many links each stands for) of one document with very many links.

    Equal tokens of a group are one token with a weight. A segment takes the first identifiers in side-major
    order until about ``most`` combinations are together, or one identifier alone: no more than the
    document has tokens.
    """
    groups = np.cumsum(x.groups_per_doc)
    g0, g1 = groups[doc] - x.groups_per_doc[doc], groups[doc]
    a0, b0 = x.a_per_doc[:doc].sum(), x.b_per_doc[:doc].sum()

    def distinct(ids, per_group, side_of):
        group = np.repeat(np.arange(g1 - g0), per_group)
        keys, weights = np.unique((side_of(ids) << 32) | group, return_counts=True)
        return keys >> 32, keys & 0xFFFFFFFF, weights

    a_side, a_group, a_weight = distinct(
        x.a[a0 : a0 + x.a_per_doc[doc]], x.a_per_group[g0:g1], lambda ids: layout.pair(ids, 0) >> layout.b_bits
    )
    b_id, b_group, b_weight = distinct(x.b[b0 : b0 + x.b_per_doc[doc]], x.b_per_group[g0:g1], lambda ids: ids)
    order = np.argsort(b_group, kind="stable")
    b_id, b_weight = b_id[order], b_weight[order]
    b_count = np.bincount(b_group, minlength=g1 - g0)
    b_start = np.cumsum(b_count) - b_count
    combinations = np.cumsum(b_count[a_group])
    begin = 0
    while begin < len(a_side):
        done = combinations[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(combinations, done + most, side="right")))
        end = int(np.searchsorted(a_side, a_side[end - 1], side="right"))
        per = b_count[a_group[begin:end]]
        b = _spread(b_start[a_group[begin:end]], per)
        keys = (np.repeat(a_side[begin:end], per) << layout.b_bits) | b_id[b]
        weights = np.repeat(a_weight[begin:end], per) * b_weight[b]
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
        heads = np.flatnonzero(np.diff(keys, prepend=-1))
        yield (keys[heads] << layout.doc_bits) | ordinal, np.add.reduceat(weights, heads)
        begin = end


class _Runs:
    """The buffer of a task and the runs it is written out as."""

    def __init__(self, layout: Layout, part: int, most: int):
        self.layout, self.part, self.most = layout, part, most
        self.spill, self.ordinal = 0, 0
        self._keys: list[np.ndarray] = []
        self._size = 0
        self.rows: list[dict] = []

    def reserve(self, links: int) -> None:
        if self._size and self._size + links > self.most:
            self.close()

    def add(self, keys: np.ndarray) -> None:
        self._keys.append(keys)
        self._size += len(keys)

    def close(self) -> None:
        if self._size:
            keys = np.sort(np.concatenate(self._keys))
            heads = np.flatnonzero(np.diff(keys, prepend=-1))
            self.write(keys[heads], np.diff(heads, append=len(keys)), 0)
            self._keys, self._size = [], 0
        if self.ordinal:
            self.spill, self.ordinal = self.spill + 1, 0

    def write(self, keys: np.ndarray, weights: np.ndarray, segment: int) -> None:
        pairs = keys >> self.layout.doc_bits
        documents = keys & ((1 << self.layout.doc_bits) - 1)
        borders = self.layout.radix_borders(pairs).tolist()
        for radix, (start, end) in enumerate(zip(borders, borders[1:])):
            if start == end:
                continue
            own = pairs[start:end]
            heads = np.flatnonzero(np.diff(own, prepend=-1))
            self.rows.append(
                {
                    "part": self.part,
                    "spill": self.spill,
                    "segment": segment,
                    "radix": radix,
                    "pairs": _rising(own[heads]),
                    "counts": squeezed(np.diff(heads, append=len(own))),
                    "documents": squeezed(documents[start:end]),
                    "weights": squeezed(weights[start:end]),
                }
            )


_RUN = ("part", "spill", "segment", "radix")
_BLOBS = ("pairs", "counts", "documents", "weights")


def runs(
    docs: DataFrame, byte_vocabulary: str, piece_model: str, row: Column | None = None, buffer: int = BUFFER
) -> DataFrame:
    """Rows of two kinds: documents (``row``, ``ordinal`` in their run and :data:`MEASURES`,
    ``groups_sha256``) and slices of runs (``radix`` and the packed columns)."""
    text = F.coalesce("row.text", F.lit("")).alias("text")
    source = packed(docs).select(text, (F.col("row") if row is None else row).alias("row"))
    schema = StructType().add("row", source.schema["row"].dataType)  # NULL for a slice
    for name in (*_RUN, "ordinal", *MEASURES):
        schema.add(name, LongType())
    schema.add("groups_sha256", StringType())
    for name in _BLOBS:
        schema.add(name, BinaryType())
    names = schema.fieldNames()
    own = set(names[1:])

    def spill(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_vocabulary, piece_model)
        store = _Runs(aligner.layout, TaskContext.get().partitionId(), buffer)
        kind = None
        for frame in frames:
            texts, rows = frame.column("text").to_pylist(), frame.column("row")
            kind = rows.type
            for first, last in batches_of(texts, _BATCH_CHARACTERS):
                part = texts[first:last]
                yield _record(names, kind, rows.slice(first, last - first), _documents(aligner, store, part))
            if store.rows:
                yield _record(names, kind, None, _listed(store.rows, own))
                store.rows = []
        store.close()
        if store.rows:
            yield _record(names, kind, None, _listed(store.rows, own))

    return source.mapInArrow(spill, schema)


def _listed(rows: list[dict], names: set[str]) -> dict[str, list]:
    return {name: [r.get(name) for r in rows] for name in names}


def _record(names: list[str], kind: pa.DataType, rows: pa.Array | None, columns: dict) -> pa.RecordBatch:
    n = len(columns["part"])
    kinds = {name: pa.binary() for name in _BLOBS} | {"groups_sha256": pa.string()}
    arrays = [pa.nulls(n, kind) if rows is None else rows]
    for name in names[1:]:
        values = columns.get(name)
        wanted = kinds.get(name, pa.int64())
        arrays.append(pa.nulls(n, wanted) if values is None else pa.array(values, wanted))
    return pa.RecordBatch.from_arrays(arrays, names)


def _documents(aligner: Aligner, store: _Runs, texts: list[str]) -> dict:
    """The documents' columns; their links go to the buffer."""
    x = aligner.align(texts)
    spills, ordinals = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
    start = 0
    sums = np.cumsum(x.links_per_doc)
    while start < len(texts):
        done = sums[start - 1] if start else 0
        end = int(np.searchsorted(sums, done + store.most, side="right"))
        large = end == start  # one document with more links than a buffer
        if large:
            store.close()
            end = start + 1
        else:
            store.reserve(int(sums[end - 1] - done))
        spills[start:end] = store.spill
        ordinals[start:end] = np.arange(store.ordinal, store.ordinal + end - start)
        if large:
            segments = links_in_segments(store.layout, x, start, store.ordinal, store.most)
            for segment, (keys, weights) in enumerate(segments):
                store.write(keys, weights, segment)
        elif sums[end - 1] > done:
            store.add(links_of(store.layout, x, start, end, store.ordinal))
        store.ordinal += end - start
        if large:
            store.close()
        start = end
    return {
        "part": np.full(len(texts), store.part),
        "spill": spills,
        "ordinal": ordinals,
        "n_a": x.a_per_doc,
        "n_b": x.b_per_doc,
        "n_groups": x.groups_per_doc,
        "n_links": x.links_per_doc,
        "groups_sha256": aligner.digests(x),
    }


def merged(directories: Sequence[tuple[np.ndarray, np.ndarray]], b_bits: int) -> Iterator[tuple]:
    """(pairs, counts) of one first identifier after the other, from sorted directories, by a heap.

    The heap holds the next first identifier of every directory; all directories that have the least one
    give their stretch of it, and equal pairs are added up.
    """
    sides = [pairs >> b_bits for pairs, _ in directories]
    heap = [(int(side[0]), i, 0) for i, side in enumerate(sides) if len(side)]
    heapq.heapify(heap)
    while heap:
        least, stretches = heap[0][0], []
        while heap and heap[0][0] == least:
            _, i, start = heap[0]
            end = start + int(np.searchsorted(sides[i][start:], least, side="right"))
            stretches.append((directories[i][0][start:end], directories[i][1][start:end]))
            if end < len(sides[i]):
                heapq.heapreplace(heap, (int(sides[i][end]), i, end))
            else:
                heapq.heappop(heap)
        if len(stretches) == 1:
            yield stretches[0]
            continue
        pairs, place = np.unique(np.concatenate([p for p, _ in stretches]), return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, place, np.concatenate([c for _, c in stretches]))
        yield pairs, counts


def _opened(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    return [
        (np.cumsum(loosened(p.as_py())), loosened(c.as_py()))
        for p, c in zip(table.column("pairs"), table.column("counts"))
    ]


_DIRECTORY = "radix long, node long, segment long, pairs binary, counts binary"
_ANSWERS = "radix long, node long, segment long, answers binary"


def _up(layout: Layout) -> Callable:
    """The directories below one node of the tree as one."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        found = list(merged(_opened(table), layout.b_bits))
        pairs, counts = (np.concatenate(c) for c in zip(*found))
        columns = [[key[0].as_py()], [key[1].as_py()], [0], [_rising(pairs)], [squeezed(counts)]]
        return pa.table(columns, names=["radix", "node", "segment", "pairs", "counts"])

    return merge


def _root(layout: Layout) -> Callable:
    """Twice the count of each pair, and one more where no pair of its first identifier has a higher one."""

    def judge(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            answers = []
            for pairs, counts in _opened(frame):
                found = [2 * c + (c == c.max()) for _, c in merged([(pairs, counts)], layout.b_bits)]
                answers.append(squeezed(np.concatenate(found)))
            columns = [frame.column(c) for c in ("radix", "node", "pairs")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(answers)], ["radix", "node", "pairs", "answers"])

    return judge


def _down(parents: pa.Table, children: pa.Table) -> pa.Table:
    """The parent's answers in the order of each child's directory."""
    pairs = np.cumsum(loosened(parents.column("pairs")[0].as_py()))
    answers = loosened(parents.column("answers")[0].as_py())
    found = [
        squeezed(answers[np.searchsorted(pairs, np.cumsum(loosened(child.as_py())))])
        for child in children.column("pairs")
    ]
    names = ["radix", "node", "segment"]
    return pa.table([*(children.column(n) for n in names), pa.array(found)], names=[*names, "answers"])


def _back(key: tuple, answers: pa.Table, slices: pa.Table) -> pa.Table:
    """The sums of one run's documents, slice by slice."""
    by_slice = {
        (r, s): a.as_py()
        for r, s, a in zip(
            answers.column("radix").to_pylist(), answers.column("segment").to_pylist(), answers.column("answers")
        )
    }
    best, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = zip(slices.column("radix").to_pylist(), slices.column("segment").to_pylist())
    for i, place in enumerate(places):
        counts, documents, weights = (
            loosened(slices.column(c)[i].as_py()) for c in ("counts", "documents", "weights")
        )
        answer = np.repeat(loosened(by_slice[place]), counts)
        if documents.max() >= len(best):
            longer = int(documents.max()) + 1 - len(best)
            best, total = (np.append(v, np.zeros(longer, np.int64)) for v in (best, total))
        best += np.bincount(documents, weights * (answer & 1), len(best)).astype(np.int64)
        total += np.bincount(documents, weights * (answer >> 1), len(total)).astype(np.int64)
    n = len(best)
    columns = [np.full(n, key[0].as_py()), np.arange(n), best, total]
    return pa.table(columns, names=["run", "ordinal", "n_best", "count_sum"])


class Counted(NamedTuple):
    """``roots``: the judged directory of each radix. ``answers``: those of every slice of a run."""

    roots: DataFrame
    answers: DataFrame


def counted(slices: DataFrame, layout: Layout) -> Counted:
    """Counts of written slices (``radix, node, segment, pairs, counts``), up the tree and down again."""
    most = slices.agg(F.max("node").alias("node")).first().node or 0
    levels = [slices.select("radix", "node", "segment", "pairs", "counts")]
    for _ in range(max(1, -(-int(most).bit_length() // FAN_BITS))):
        parent = F.shiftright("node", FAN_BITS).alias("node")
        below = levels[-1].select("radix", parent, "pairs", "counts")
        joined = below.groupBy("radix", "node").applyInArrow(_up(layout), _DIRECTORY)
        levels.append(staged(joined, "alignment-directories"))
    top = "radix long, node long, pairs binary, answers binary"
    roots = staged(levels.pop().mapInArrow(_root(layout), top), "alignment-roots")
    answers = roots
    for level in reversed(levels):
        children = level.withColumn("parent", F.shiftright("node", FAN_BITS)).drop("counts")
        given = answers.groupBy("radix", "node").cogroup(children.groupBy("radix", "parent"))
        answers = staged(given.applyInArrow(_down, _ANSWERS), "alignment-answers")
        if level is not levels[0]:
            answers = answers.join(level.select("radix", "node", "pairs"), ["radix", "node"])
    return Counted(roots, answers)


def _written(
    docs: DataFrame, byte_vocabulary: str, piece_model: str, row: Column | None, buffer: int
) -> tuple[DataFrame, DataFrame, Layout]:
    """(documents, slices of runs, layout), written; ``node`` numbers the runs of all tasks."""
    layout = Layout.of(len(byte_tokens(byte_vocabulary)), len(piece_tokens(piece_model)))
    rows = staged(runs(docs, byte_vocabulary, piece_model, row, buffer), "alignment-runs")
    most = rows.agg(F.max("spill").alias("spill")).first().spill or 0
    node = F.shiftleft("part", int(most).bit_length()) + F.col("spill")
    slices = rows.where("radix IS NOT NULL").select(node.alias("node"), "radix", "segment", *_BLOBS)
    documents = rows.where("radix IS NULL").select(
        "row", node.alias("run"), "ordinal", *MEASURES, "groups_sha256"
    )
    return documents, slices, layout


def aligned(
    docs: DataFrame, byte_vocabulary: str, piece_model: str, row: Column | None = None, buffer: int = BUFFER
) -> DataFrame:
    """One row per document: ``row``, :data:`MEASURES`, ``n_best``, ``count_sum``, ``groups_sha256``.

    Texts that are NULL, empty, or that either vocabulary cannot give back byte for byte have no tokens: zeros
    and an empty digest. Equal rows are documents of their own. An empty table stays empty.
    """
    documents, slices, layout = _written(docs, byte_vocabulary, piece_model, row, buffer)
    answers = counted(slices, layout).answers
    sums = (
        answers.groupBy("node")
        .cogroup(slices.groupBy("node"))
        .applyInArrow(_back, "run long, ordinal long, n_best long, count_sum long")
    )
    zero = F.lit(0).cast("long")
    return documents.join(sums, ["run", "ordinal"], "left").select(
        "row", *MEASURES, *(F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")), "groups_sha256"
    )


def pair_counts(
    docs: DataFrame, byte_vocabulary: str, piece_model: str, buffer: int = BUFFER
) -> DataFrame:
    """``a_id``, ``b_id``, how many ``documents`` link them, and whether that is the ``best`` of ``a_id``."""
    nothing = F.lit(None).cast("int")
    _, slices, layout = _written(docs, byte_vocabulary, piece_model, nothing, buffer)

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for pairs, answers in zip(frame.column("pairs"), frame.column("answers")):
                a, b = layout.identifiers(np.cumsum(loosened(pairs.as_py())))
                answer = loosened(answers.as_py())
                columns = [pa.array(v) for v in (a, b, answer >> 1, (answer & 1).astype(bool))]
                yield pa.RecordBatch.from_arrays(columns, ["a_id", "b_id", "documents", "best"])

    roots = counted(slices, layout).roots
    return roots.mapInArrow(read, "a_id long, b_id long, documents long, best boolean")
