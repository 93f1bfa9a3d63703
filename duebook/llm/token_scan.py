"""Token counts of flat token files, found by scanning for end-of-document identifiers.

A flat file is nothing but identifiers, one after another, each document ended by a separator: no
index says where documents begin. Files are read by byte range, in blocks of a fixed number of identifiers, so
a file of any length is the work of many tasks. Every block is searched at once (one vector comparison);
documents that run over block borders are put together by a prefix scan in two levels: over the blocks of a
range, then over the ranges of a file. It adds up identifiers before the block, separators before it, and
the place of the last separator before it.

Edge cases. A NULL or empty text is a document of 0 identifiers. Identifiers behind the last separator of
a file are a document that is not ``ended``. Empty files and tables give no rows. A separator written as
ordinary text is encoded as text and ends nothing. A file whose length is no whole number of identifiers is an
error. Files must stand in a store that pyarrow can open in tasks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duebook.llm.common import staged
from duebook.sources.landing import range_reader, landing_files
from duebook.sources.storage import shared_folder

#: Identifiers of a block, and blocks of a file before the next one is begun at the end of a document.
BLOCK = 16384
FILE_BLOCKS = 1024
#: Blocks of a range, ranges of a task, and how many blocks are held at once.
RANGE_BLOCKS = 512
TASK_RANGES = 8
HELD_BLOCKS = 32
KIND = "<u2"


def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base64 text."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def packed_files(docs: DataFrame, ranks: dict[bytes, int], pattern: str, separator: int) -> DataFrame:
    """Documents as flat token files, in blocks: (file, block, tokens, doc_ids).

    ``tokens`` alone is the file. ``doc_ids`` names the documents that end in the block, in order; the
    scan does not read it. A document lies in one file: the last block of a file is cut behind a
    separator, and a document without one in that block makes its file longer.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        coder = tiktoken.Encoding(
            "flat", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={}
        )
        task = TaskContext.get().partitionId()
        open_tokens = np.zeros(0, KIND)
        ids: list[int | None] = []
        ends: list[int] = []
        file = written = 0

        def block(size: int) -> pa.RecordBatch:
            nonlocal open_tokens, ids, ends, file, written
            named = int(np.searchsorted(ends, size, side="left")) if ends else 0
            full = written + 1 >= FILE_BLOCKS and named > 0
            if full:
                size = ends[named - 1] + 1
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{task:07d}-{file:05d}"]),
                    pa.array([written], pa.int32()),
                    pa.array([open_tokens[:size].tobytes()], pa.binary()),
                    pa.array([ids[:named]], pa.list_(pa.int64())),
                ],
                names=["file", "block", "tokens", "doc_ids"],
            )
            open_tokens, ids = open_tokens[size:], ids[named:]
            ends = [e - size for e in ends[named:]]
            file, written = (file + 1, 0) if full else (file, written + 1)
            return batch

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                new = [open_tokens]
                length = len(open_tokens)
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                    tokens = coder.encode_ordinary(text) if text else []
                    new.append(np.array([*tokens, separator], KIND))
                    length += len(tokens) + 1
                    ids.append(doc_id)
                    ends.append(length - 1)
                open_tokens = np.concatenate(new)
                while len(open_tokens) >= BLOCK:
                    yield block(BLOCK)
        if len(open_tokens):
            yield block(len(open_tokens))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "file string, block int, tokens binary, doc_ids array<long>"
    )


def write_files(blocks: DataFrame, folder: str) -> DataFrame:
    """Write packed blocks as flat files ``<file>.bin``; returns (file, block, doc_ids), also written.

    A task writes its files one after another. A file appears under its name when it is whole: a
    task that is run again, or twice at once, writes the same bytes under a hidden name of its own first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        store, place = range_reader(folder)
        store.create_dir(place)
        name, stream = None, None

        def close() -> None:
            if stream is not None:
                stream.close()
                store.move(f"{place}/_{attempt}-{name}.bin", f"{place}/{name}.bin")

        for batch in batches:
            for file, tokens in zip(batch["file"].to_pylist(), batch["tokens"]):
                if file != name:
                    close()
                    name, stream = file, store.open_output_stream(f"{place}/_{attempt}-{file}.bin")
                stream.write(tokens.as_buffer())
            yield batch.select(["file", "block", "doc_ids"])
        close()

    return staged(
        blocks.mapInArrow(run, "file string, block int, doc_ids array<long>"), "token-file-names"
    )


def flat_files(docs: DataFrame, ranks: dict[bytes, int], pattern: str, separator: int) -> tuple[str, DataFrame]:
    """Documents written as flat files: their folder, and the names of their documents by block."""
    folder = shared_folder(docs.sparkSession, "token-files")
    return folder, write_files(packed_files(docs, ranks, pattern, separator), folder)


def file_blocks(spark: SparkSession, path: str, width: int = 2, block: int = BLOCK) -> DataFrame:
    """(file, block, tokens) of the flat files at a path; ``width`` is the bytes of an identifier.

    The listing gives names and lengths only. It is cut into ranges, which are spread over the tasks; a
    task reads its ranges' bytes and nothing else of the file. The number of tasks is told to Spark: the
    rows that name the ranges are tiny, and by their bytes they would all be put into one task.
    """
    size = width * block
    reach = size * RANGE_BLOCKS
    ranges = F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / F.lit(reach)).cast("long"))
    listed = landing_files(spark, path).select("path", "length", F.explode(ranges).alias("number"))
    tasks = max(listed.count() // TASK_RANGES, spark.sparkContext.defaultParallelism)
    todo = listed.repartition(tasks, "path", "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, name = range_reader(row["path"])
                first = row["number"] * RANGE_BLOCKS
                behind = min(row["length"], (row["number"] + 1) * reach)
                with store.open_input_file(name) as stream:
                    for at in range(first * size, behind, HELD_BLOCKS * size):
                        found = stream.read_at(min(HELD_BLOCKS * size, behind - at), at)
                        parts = [found[i : i + size] for i in range(0, len(found), size)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([row["path"]] * len(parts), pa.string()),
                                pa.array(range(at // size, at // size + len(parts)), pa.int64()),
                                pa.array(parts, pa.binary()),
                            ],
                            names=["file", "block", "tokens"],
                        )

    return todo.mapInArrow(run, "file string, block long, tokens binary")


def scanned(blocks: DataFrame, separator: int, kind: str = KIND) -> DataFrame:
    """One row per document of the files: ``file``, ``doc_index``, ``start``, ``n_tokens``, ``ended``.

    What a block says (its size and its separators) is written once. A window over the blocks of a range
    and one over the ranges of a file then place it: no task holds the separators of a whole file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for tokens in batch["tokens"]:
                values = np.frombuffer(tokens.as_buffer(), kind)
                sizes.append(len(values))
                ends.append(np.flatnonzero(values == separator))
            yield pa.RecordBatch.from_arrays(
                [batch["file"], batch["block"], pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int64()))],
                names=["file", "block", "size", "ends"],
            )

    searched = blocks.select("file", F.col("block").cast("long").alias("block"), "tokens").mapInArrow(
        run, "file string, block long, size long, ends array<long>"
    )
    zero, nothing = F.lit(0).cast("long"), F.lit(-1).cast("long")
    within = Window.partitionBy("file", "range").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    found = (
        staged(searched, "token-separators")
        .withColumn("range", F.floor(F.col("block") / RANGE_BLOCKS))
        .withColumn("n", F.size("ends").cast("long"))
        .withColumn("at", F.coalesce(F.sum("size").over(within), zero))
        .withColumn("seen", F.coalesce(F.sum("n").over(within), zero))
        .withColumn("last", F.col("at") + F.get("ends", (F.col("n") - 1).cast("int")))
        .withColumn("last_seen", F.max("last").over(within))
    )
    in_file = Window.partitionBy("file").orderBy("range")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        found.groupBy("file", "range")
        .agg(F.sum("size").alias("r_size"), F.sum("n").alias("r_n"), F.max("last").alias("r_last"), F.max("block").alias("r_block"))
        .withColumn("r_at", F.coalesce(F.sum("r_size").over(before), zero))
        .withColumn("r_seen", F.coalesce(F.sum("r_n").over(before), zero))
        .withColumn("r_last_seen", F.max(F.col("r_at") + F.col("r_last")).over(before))
        .withColumn("final_block", F.when(F.lead("range").over(in_file).isNull(), F.col("r_block")))
        .select("file", "range", "r_at", "r_seen", "r_last_seen", "final_block")
    )
    ended_by = F.coalesce(F.get("ends", (F.col("n") - 1).cast("int")), nothing)
    open_end = F.coalesce(F.col("block") == F.col("final_block"), F.lit(False)) & (ended_by < F.col("size") - 1)
    return (
        found.join(ranges, ["file", "range"])
        .withColumn("start", F.col("r_at") + F.col("at"))
        .withColumn("docs_before", F.col("r_seen") + F.col("seen"))
        .withColumn("last_before", F.coalesce(F.col("r_at") + F.col("last_seen"), F.col("r_last_seen"), nothing))
        .withColumn("all_ends", F.when(open_end, F.array_append("ends", F.col("size"))).otherwise(F.col("ends")))
        .select("file", "size", "start", "docs_before", "last_before", "all_ends", F.posexplode("all_ends").alias("i", "end"))
        .withColumn(
            "begin",
            F.when(F.col("i") > 0, F.col("start") + F.get("all_ends", F.col("i") - 1))
            .otherwise(F.col("last_before")) + 1,
        )
        .select(
            "file",
            (F.col("docs_before") + F.col("i")).alias("doc_index"),
            F.col("begin").alias("start"),
            (F.col("start") + F.col("end") - F.col("begin")).alias("n_tokens"),
            (F.col("end") < F.col("size")).alias("ended"),
        )
    )


def named(files: DataFrame) -> DataFrame:
    """(file, doc_index, doc_id) from the names kept beside the packed files."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum(F.size("doc_ids")).over(before), F.lit(0))
    return (
        files.select("file", "block", "doc_ids").withColumn("first", first)
        .select("file", "first", F.posexplode("doc_ids").alias("i", "doc_id"))
        .select("file", (F.col("first") + F.col("i")).cast("long").alias("doc_index"), "doc_id")
    )
