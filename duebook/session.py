"""How much one task is given at once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Bytes of a scan's split and of a shuffled partition. Rows with text keys take 20 to 30 times their
# shuffled bytes once they are sorted, and one task sorts and sums them several times over (window, join,
# aggregate): Spark's own 64 MB became up to 3.4 GB in a task of the leakage check.
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "12m",
}
# Fixed value: bytes of input files for each partition that a shuffle begins with. Adaptive execution joins small
# partitions up to the size above but never splits one for a sort or a sum, so a number that stays while the
# input grows makes every task grow with it. Text keys are written to a shuffle two to three times as large as Parquet
# holds them.
SHUFFLED_INPUT = 4 << 20
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def input_bytes(spark: SparkSession, folder: str) -> int:
    """Size of the Parquet files below ``folder``. Only metadata is read."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet")
    return files.load(folder).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def bound_tasks(spark: SparkSession, folder: str | None = None, shuffled: int = SHUFFLED_INPUT) -> None:
    """Let more data mean more tasks, not larger ones. Sizes that the session was given stay as they are.

    With the ``folder`` of the inputs, shuffles begin with a partition for every ``shuffled`` bytes of its files, and
    with as many as the session has at least.
    """
    for name, size in TASK_SIZES.items():
        if spark.conf.get(name, "1b") == "1b":  # nobody set it
            spark.conf.set(name, size)
    if folder is not None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(FIRST_PARTITIONS, max(least, -(-input_bytes(spark, folder) // shuffled)))


# Fixed value: rows that a Python worker is sent at once. Spark's own 10,000 whole texts stand several times over in
# an executor: in the JVM's buffers on their way out and back, in the worker's batch and as its strings.
BATCH_ROWS = "1000"


def bound_batches(spark: SparkSession) -> None:
    """Send whole texts to Python in small batches. A size that the session was given stays as it is."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "-1") == "-1":  # nobody set it
        spark.conf.set(name, BATCH_ROWS)
