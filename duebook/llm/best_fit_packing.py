"""Best-fit packing: documents as token sequences of one length, with as few sequences as can be.

1. Every document is encoded and closed with the end identifier; longer ones are cut so that all pieces but
   the first are full. Each piece is numbered among the pieces of its length in its task, and written.
2. Counts per task and length give the base of every task, so that base plus number is the piece's rank
   among all of its length: no task ever sees all pieces of one length.
3. :mod:`duebook.llm.linear_grouping` plans on the counts per length alone (at most ``capacity`` rows).
4. A piece finds its sequence and offset by length and rank in that plan, whose size depends on the
   capacity and never on the documents.

A rerun of a task repeats the same numbers, because it reads the same split in the same order; what is ranked
is read from the written pieces only.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from duebook.llm.common import packed, staged
from duebook.llm.linear_grouping import Grouping, Range, plan
from duebook.llm.word_cache import WordCache, byte_level

#: Characters of text that are encoded at once; more only where one text is longer.
_BATCH_CHARACTERS = 1 << 22


def batches_of(texts: Sequence[str], most: int = _BATCH_CHARACTERS) -> Iterator[tuple[int, int]]:
    """(start, end) of stretches of texts that are encoded together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def numbered(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How many pieces of the same length came before each; ``seen`` is brought up to date."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    first = np.searchsorted(ordered, ordered)
    result = np.empty(len(lengths), np.int64)
    result[order] = np.arange(len(lengths)) - first + seen[ordered]
    seen += np.bincount(lengths, minlength=len(seen))
    return result


def _row(row: Column | None) -> Column:
    return (F.col("row") if row is None else row).alias("row")


def pieces(
    docs: DataFrame,
    vocabulary: str,
    row: Column | None = None,
    *,
    capacity: int = Grouping.capacity,
    end: int = 0,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of every document, whole texts: ``row`` (of the packed document), ``piece`` from 0, ``start``
    (identifiers of the document before it), ``length``, ``ids_crc32`` and, on request, ``ids``; beside
    them ``part`` and ``nth``, which rank the pieces of one length.

    A NULL or empty text is one piece that holds the end identifier alone. Equal rows are documents of
    their own. Special tokens in a text are read as the vocabulary's library reads them by default.
    """
    if capacity < 1:
        raise ValueError("a sequence needs room for one identifier")
    source = packed(docs).select(F.coalesce("row.text", F.lit("")).alias("text"), _row(row))
    schema = StructType([source.schema["row"]])
    for name in ("piece", "start", "length", "ids_crc32", "part", "nth"):
        schema.add(StructField(name, LongType(), False))
    if keep_ids:
        schema.add("ids", ArrayType(IntegerType()))
    return source.mapInArrow(_cutter(vocabulary, capacity, end, keep_ids), schema)


def _cutter(vocabulary: str, capacity: int, end: int, keep_ids: bool) -> Callable:
    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_level(vocabulary, special_as_text=False)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for frame in frames:
            texts, rows = frame.column("text").to_pylist(), frame.column("row")
            for first, last in batches_of(texts):
                yield _cut_batch(
                    encoder, texts[first:last], rows.slice(first, last - first),
                    capacity, end, keep_ids, part, seen,
                )

    return cut


def _cut_batch(
    encoder: WordCache,
    texts: list[str],
    rows: pa.Array,
    capacity: int,
    end: int,
    keep_ids: bool,
    part: int,
    seen: np.ndarray,
) -> pa.RecordBatch:
    found, counts = encoder.encode(texts)
    ends = np.cumsum(counts + 1)
    ids = np.full(ends[-1], end, "<u4")
    inside = np.ones(len(ids), bool)
    inside[ends - 1] = False
    ids[inside] = found

    totals = counts + 1
    n_pieces = -(-totals // capacity)
    document = np.repeat(np.arange(len(texts)), n_pieces)
    piece = np.arange(len(document)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
    first_length = totals - (n_pieces - 1) * capacity
    start = np.where(piece == 0, 0, first_length[document] + (piece - 1) * capacity)
    length = np.where(piece == 0, first_length[document], capacity)
    borders = np.append(np.cumsum(length) - length, len(ids))
    content = memoryview(ids).cast("B")
    crc = [zlib.crc32(content[4 * a : 4 * b]) for a, b in zip(borders, borders[1:])]
    columns = [
        rows.take(pa.array(document)),
        pa.array(piece),
        pa.array(start),
        pa.array(length),
        pa.array(crc, pa.int64()),
        pa.array(np.full(len(document), part, np.int64)),
        pa.array(numbered(length, seen)),
    ]
    names = ["row", "piece", "start", "length", "ids_crc32", "part", "nth"]
    if keep_ids:
        columns.append(pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(ids.view("<i4"))))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names)


def placed(pieces_: DataFrame, grouping: Grouping = Grouping()) -> DataFrame:
    """Written pieces with ``sequence_id`` and ``offset``: no gap before any, none over the capacity.

    ``pieces_`` must be a written table (it is read three times). An empty table stays empty.
    """
    counts = pieces_.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    totals = counts.groupBy("length").agg(F.sum("n").alias("n"))  # at most one row per length
    ranges = plan({r.length: r.n for r in totals.collect()}, grouping)
    ranked = pieces_.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    kept = [c for c in pieces_.columns if c not in ("part", "nth")]
    wanted = ranked.select(*kept, "rank")
    schema = StructType([wanted.schema[c] for c in kept])
    for name in ("sequence_id", "offset"):
        schema.add(StructField(name, LongType(), False))
    return wanted.mapInArrow(_finder(ranges), schema)


def _finder(ranges: list[Range]) -> Callable:
    table = np.array(sorted(r for r in ranges if r.sequences), np.int64).reshape(-1, 6)

    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = 48
        keys = (table[:, 0] << shift) | table[:, 1]
        for frame in frames:
            length = frame.column("length").to_numpy(zero_copy_only=False)
            rank = frame.column("rank").to_numpy(zero_copy_only=False)
            row = table[np.searchsorted(keys, (length << shift) | rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence = row[:, 4] + nth // np.maximum(row[:, 2], 1)
            offset = row[:, 5] + nth % np.maximum(row[:, 2], 1) * length
            names = [n for n in frame.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(frame.column(n) for n in names), pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    return find


def packed_documents(
    docs: DataFrame,
    vocabulary: str,
    row: Column | None = None,
    grouping: Grouping = Grouping(),
    end: int = 0,
    keep_ids: bool = False,
) -> DataFrame:
    """All documents cut, written once, and placed: columns of :func:`pieces` and :func:`placed`."""
    cut = pieces(docs, vocabulary, row, capacity=grouping.capacity, end=end, keep_ids=keep_ids)
    return placed(staged(cut, "packing-pieces"), grouping)


def sequences(placed_: DataFrame) -> DataFrame:
    """``sequence_id``, its ``ids`` from piece to piece and how many ``pieces`` it has, from pieces with ids.

    A sequence holds at most its capacity of identifiers, so no group is unbounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = placed_.groupBy("sequence_id").agg(ordered.alias("parts"))
    return grouped.select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.size("parts").alias("pieces")
    )
