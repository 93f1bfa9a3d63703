"""Where intermediate tables go, and writers that cannot skip the personal-data check."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence, Set
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duebook.operators.privacy import assert_no_personal_data

#: Rows of a bucket that one task can sort, join and sum in some 100 MB each.
BUCKET_ROWS = 500_000


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that all executors can reach: below ``spark.checkpoint.dir``, or below the
    warehouse of a session that has no such setting. Never a folder of one machine.
    """
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
    )
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _same_layout(table: StructType, df: StructType) -> bool:
    def layout(schema: StructType) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in schema.fields}

    return layout(table) == layout(df)


def _check_layout(table: DataFrame, name: str, df: DataFrame) -> None:
    if not _same_layout(table.schema, df.schema):
        raise ValueError(
            f"columns of {name} differ: table {table.schema.simpleString()}, "
            f"new rows {df.schema.simpleString()}"
        )


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Write a catalog table as Parquet; ``mode`` is ``overwrite`` or ``append``.

    An existing table is never widened or retyped: new rows must match it in name and type.
    Not partitioned unless asked, because small partitions cost more than they save.
    """
    assert_no_personal_data(df.columns, table)
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        current = spark.table(table)
        _check_layout(current, table, df)
        if mode == "append":
            df.select(*current.columns).write.insertInto(table)
            return
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def bucket_counts(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``bucket`` and ``rows``: how evenly rows would lie in so many buckets of ``key``."""
    bucket = F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("rows"))


def buckets_for(df: DataFrame, least: int = 1, rows: int = BUCKET_ROWS) -> int:
    """Buckets of about ``rows`` rows for ``df``, or for a frame with at least as many rows that is cheap to count.

    A bucket is one task's work: a number that stays while the table grows makes that task grow.
    """
    return max(least, -(-df.count() // rows))


def write_bucketed(
    df: DataFrame,
    table: str,
    key: str,
    buckets: int,
    sort_by: Sequence[str] = (),
    path: str | None = None,
    most_uneven: float = 4.0,
) -> bool:
    """Replace a table, one sorted file per bucket of ``key``; joins, sums and windows by ``key`` then need no
    shuffle. Tables that are joined must have the same number of buckets.

    A bucket is one task's work wherever the table is read. If the largest would hold more than
    ``most_uneven`` times the mean (a hot key, say), the table is written without buckets, False is returned,
    and adaptive execution can split the key as it does elsewhere. The count beforehand is a
    map-side-combined aggregate: write from a stage where ``df`` is dear.
    """
    assert_no_personal_data(df.columns, table)
    if df.sparkSession.catalog.tableExists(table):
        _check_layout(df.sparkSession.table(table), table, df)
    sizes = bucket_counts(df, key, buckets).agg(F.max("rows").alias("most"), F.sum("rows").alias("all"))
    found = sizes.first()
    even = not found["all"] or found["most"] <= most_uneven * max(1.0, found["all"] / buckets)
    writer = df.write
    if even:
        columns = list(dict.fromkeys([key, *sort_by]))
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(*columns)
    if path:
        writer = writer.option("path", path)
    writer.format("parquet").mode("overwrite").saveAsTable(table)
    return even


def replace_partition(
    df: DataFrame, table: str, column: str, value: object, path: str | None = None
) -> None:
    """Put rows into one partition of a table partitioned by ``column``.

    Other partitions stay; writing the same one again replaces its rows, so a rerun does not
    double them. ``df`` must not contain other values of ``column``, and may lack it.
    """
    spark = df.sparkSession
    labelled = df.withColumn(column, F.lit(value))
    if not spark.catalog.tableExists(table):
        write_table(labelled, table, partition_by=[column], path=path)
        return
    assert_no_personal_data(df.columns, table)
    current = spark.table(table)
    _check_layout(current, table, labelled)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    rows = labelled.select(*[c for c in current.columns if c != column])
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({column} = '{text}') SELECT * FROM {{rows}}",
        rows=rows,
    )


def replace_partitions(
    df: DataFrame,
    table: str,
    column: str,
    values: Sequence[object],
    path: str | None = None,
    filled: Set[object] | None = None,
) -> None:
    """Put rows into the partitions ``values`` of a table in one job; the other partitions stay.

    A value without rows leaves an empty partition. ``df`` must not contain other values, and may read
    the table itself. ``filled`` names the values that have rows; without it ``df`` is computed once more to find them.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        write_table(df, table, partition_by=[column], path=path)
        return
    assert_no_personal_data(df.columns, table)
    current = spark.table(table)
    _check_layout(current, table, df)
    if filled is None:
        filled = {row[0] for row in df.select(column).distinct().collect()}  # at most ``values``
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*current.columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    for value in values:
        if value not in filled:
            replace_partition(spark.createDataFrame([], df.schema), table, column, value)


def _write_stage(df: DataFrame, purpose: str, partition_by: Sequence[str]) -> str:
    assert_no_personal_data(df.columns, purpose)
    path = shared_folder(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def _read_stage(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Compute ``df`` once into shared storage and read it from there.

    For plans that are used in several parts. The written files end the lineage, so a lost
    executor repeats at most its own tasks of the later steps.
    """
    return _read_stage(df, _write_stage(df, purpose, partition_by))


@contextmanager
def staged(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """:func:`stage` for the length of a ``with`` block; the staged files are removed after it."""
    path = _write_stage(df, purpose, partition_by)
    try:
        yield _read_stage(df, path)
    finally:
        delete_folder(df.sparkSession, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the session's default or the named store; one that is gone is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in every file; quotes are doubled, spaces at the ends of values kept."""
    (
        df.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .mode("error")
        .csv(path)
    )


def create_reference_tables(
    spark: SparkSession, contracts: dict[str, StructType], schema: str, folder: str | None = None
) -> list[str]:
    """Create the typed reference tables that do not exist yet; returns the new names."""
    created = []
    for name, contract in contracts.items():
        table = f"{schema}.{name}"
        if not spark.catalog.tableExists(table):
            path = f"{folder.rstrip('/')}/{name}" if folder else None
            spark.catalog.createTable(table, path=path, source="parquet", schema=contract)
            created.append(table)
    return created


def _digest(columns: Sequence[str]) -> Column:
    """A row's digest takes every value with its length, and NULL as a mark of its own, so a value that
    moves to another column shows."""
    values = [F.col(f"`{c}`").cast("string") for c in columns]
    marked = [
        F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("N")) for v in values
    ]
    return F.md5(F.concat_ws("|", *marked))


def _digest_sum(part: int) -> Column:
    """Numbers of the digests, summed as decimals: copies count, and the sum cannot wrap around."""
    number = F.conv(F.substring("_digest", 1 + 15 * part, 15), 16, 10).cast("decimal(38,0)")
    return F.coalesce(F.sum(number), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)")


def snapshot_fingerprint(df: DataFrame, batch_column: str | None = None) -> DataFrame:
    """One row that identifies the content of a table, whatever the order of its rows."""
    batch = F.max(batch_column) if batch_column else F.lit(None).cast("string")
    return df.withColumn("_digest", _digest(df.columns)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.concat_ws("-", *(_digest_sum(i).cast("string") for i in (0, 1))).alias("content_hash"),
        batch.alias("latest_batch"),
    )


def partition_digests(
    df: DataFrame, partition: str, batch_column: str | None = None
) -> DataFrame:
    """The parts of a fingerprint, one row per partition. They add up: see :func:`total_fingerprint`."""
    batch = F.max(batch_column) if batch_column else F.lit(None).cast("string")
    return df.withColumn("_digest", _digest(df.columns)).groupBy(partition).agg(
        F.count(F.lit(1)).alias("rows"),
        *(_digest_sum(i).alias(f"sum_{i}") for i in (0, 1)),
        batch.alias("latest_batch"),
    )


def total_fingerprint(digests: DataFrame) -> DataFrame:
    """What :func:`snapshot_fingerprint` gives for the whole table, from its partitions' digests alone."""
    zero = F.lit(0).cast("decimal(38,0)")
    sums = [
        F.coalesce(F.sum(c), zero).cast("decimal(38,0)").cast("string") for c in ("sum_0", "sum_1")
    ]
    return digests.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.concat_ws("-", *sums).alias("content_hash"),
        F.max("latest_batch").alias("latest_batch"),
    )


def refresh_digests(
    spark: SparkSession,
    table: str,
    digest_table: str,
    partition: str,
    changed: Sequence[str] | None = None,
    batch_column: str | None = None,
    path: str | None = None,
) -> None:
    """Bring a table of digests up to date, reading only the ``changed`` partitions of ``table``.

    Without ``changed``, or for the first time, every partition is read. The digests of a partition are one
    row, so the whole digest table is staged and replaced; partitions that are gone lose theirs.
    """
    current = spark.table(table)
    first = changed is None or not spark.catalog.tableExists(digest_table)
    fresh = partition_digests(
        current if first else current.where(F.col(partition).isin(*changed)), partition, batch_column
    )
    if not first:
        kept = spark.table(digest_table).where(~F.col(partition).isin(*changed))
        fresh = kept.unionByName(fresh)
    with staged(fresh, "digests") as rows:
        write_table(rows.coalesce(1), digest_table, path=path)


def changed_partitions(before: DataFrame, after: DataFrame, partition: str) -> DataFrame:
    """Partitions that two digest tables tell apart, as ``added``, ``removed`` or ``changed``."""
    old = before.select(partition, F.struct("rows", "sum_0", "sum_1").alias("_old"))
    new = after.select(partition, F.struct("rows", "sum_0", "sum_1").alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .otherwise("changed")
    )
    both = old.join(new, partition, "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    return both.select(partition, change.alias("change"))
