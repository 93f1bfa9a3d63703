"""Clean rows and rejects of a batch, published together by one switch.

A batch is written once, as a *version*: a table of its own, split by the error flag. One view, the pair, names
the current version and the rejects of earlier batches; the clean table and the quarantine table are views over
it. Replacing the pair's definition is one entry of the catalog: readers see both parts of the
old batch, or both of the new one, and never a mix. A version stays readable until the second switch after it.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.operators.quality import HAS_ERROR
from duebook.sources.storage import _check_layout, delete_folder, replace_partition, write_table

BATCH = "_batch_id"


class Version(NamedTuple):
    """A written batch. ``folder`` is None where the catalog manages the files."""

    name: str
    batch_id: str
    folder: str | None


def pair_of(table: str) -> str:
    """The view that holds both parts of what ``table`` was published from."""
    return f"{table}_published"


def history_of(quarantine_table: str) -> str:
    return f"{quarantine_table}_history"


def write_version(df: DataFrame, table: str, batch_id: str, folder: str | None = None) -> Version:
    """Write a judged batch. Nobody sees it before :func:`switch_to`, and a failed one is an orphan."""
    name = f"{table}_version_{uuid.uuid4().hex}"
    path = f"{folder.rstrip('/')}/{name}" if folder else None
    write_table(df, name, partition_by=[HAS_ERROR], path=path)
    return Version(name, batch_id, path)


def drop_version(spark: SparkSession, version: Version) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {version.name}")
    if version.folder:
        delete_folder(spark, version.folder)


def current_version(spark: SparkSession, table: str) -> Version | None:
    """What the pair names; it is kept in the view's comment, so that it changes with its definition."""
    if not spark.catalog.tableExists(pair_of(table)):
        return None
    name, folder, batch_id = spark.catalog.getTable(pair_of(table)).description.split("|", 2)
    return Version(name, batch_id, folder or None)


def switch_to(
    spark: SparkSession,
    version: Version,
    table: str,
    quarantine_table: str,
    hidden: tuple[str, ...] = (),
    folder: str | None = None,
) -> None:
    """Publish a written version; ``hidden`` columns are shown for rejects only.

    Rejects of the version that is replaced go to the history first. The present pair does not read them
    there (it takes its own batch from its version), so this step changes nothing for readers and can be
    repeated. A batch that is published again replaces its own rejects.
    """
    rows = spark.table(version.name)
    before = current_version(spark, table)
    pair, history = pair_of(table), history_of(quarantine_table)
    history_path = f"{folder.rstrip('/')}/{history}" if folder else None
    if before:
        _check_layout(spark.table(pair), table, rows)
        old = spark.table(before.name).where(HAS_ERROR).drop(HAS_ERROR)
        replace_partition(old, history, BATCH, before.batch_id, history_path)
    elif not spark.catalog.tableExists(history):
        none = rows.where(F.lit(False)).drop(HAS_ERROR)
        write_table(none, history, partition_by=[BATCH], path=history_path)
    _replace_pair(spark, version, pair, history, rows.columns)
    for name, errors, columns in (
        (table, False, [c for c in rows.columns if c not in (HAS_ERROR, *hidden)]),
        (quarantine_table, True, [c for c in rows.columns if c != HAS_ERROR]),
    ):
        if not spark.catalog.tableExists(name):
            wanted = f"{HAS_ERROR}" if errors else f"NOT {HAS_ERROR}"
            spark.sql(f"CREATE VIEW {name} AS SELECT {_listed(columns)} FROM {pair} WHERE {wanted}")
    remove_orphans(spark, table, [version, *([before] if before else [])])


def _listed(columns: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _replace_pair(
    spark: SparkSession, version: Version, pair: str, history: str, columns: list[str]
) -> None:
    rest = ", ".join("true" if c == HAS_ERROR else f"`{c}`" for c in columns)
    mark = _quoted("|".join((version.name, version.folder or "", version.batch_id)))
    spark.sql(
        f"CREATE OR REPLACE VIEW {pair} COMMENT {mark} AS "
        f"SELECT {_listed(columns)} FROM {version.name} UNION ALL "
        f"SELECT {rest} FROM {history} WHERE {BATCH} <> {_quoted(version.batch_id)}"
    )


def remove_orphans(spark: SparkSession, table: str, keep: list[Version]) -> list[str]:
    """Drop versions of ``table`` that are not to be kept: failed batches and those before the last switch."""
    database, _, stem = table.rpartition(".")
    kept = {v.name.rpartition(".")[2].lower() for v in keep}
    found = spark.catalog.listTables(database or None, f"{stem}_version_*".lower())
    dropped = []
    for entry in found:
        if entry.name.lower() not in kept:
            name = f"{database}.{entry.name}" if database else entry.name
            detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
            outside = detail.get("Type", "").upper() == "EXTERNAL"
            drop_version(spark, Version(name, "", detail.get("Location") if outside else None))
            dropped.append(entry.name)
    return dropped
