import pytest
from pyspark.sql import functions as F

from duebook.contracts import REFERENCE_TABLES
from duebook.sources import storage
from duebook.sources.storage import bucket_counts, write_bucketed


def test_append_keeps_and_overwrite_replaces(spark, fresh_name):
    table = fresh_name("t")
    storage.write_table(spark.range(3), table)
    storage.write_table(spark.range(2), table, mode="append")
    assert spark.table(table).count() == 5
    storage.write_table(spark.range(1), table)
    assert spark.table(table).count() == 1


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_an_existing_table_is_never_widened_or_retyped(spark, fresh_name, mode):
    table = fresh_name("t")
    storage.write_table(spark.range(3), table)
    with pytest.raises(ValueError, match="differ"):
        storage.write_table(spark.range(3).withColumn("more", F.lit(1)), table, mode=mode)
    with pytest.raises(ValueError, match="differ"):
        storage.write_table(spark.range(3).select(F.col("id").cast("string")), table, mode=mode)


def test_columns_are_matched_by_name(spark, fresh_name):
    table = fresh_name("t")
    storage.write_table(spark.createDataFrame([("a", "b")], "x string, y string"), table)
    storage.write_table(spark.createDataFrame([("d", "c")], "y string, x string"), table, mode="append")
    assert {tuple(r) for r in spark.table(table).select("x", "y").collect()} == {("a", "b"), ("c", "d")}


@pytest.mark.parametrize("writer", ["table", "partition", "stage"])
def test_no_writer_accepts_raw_personal_data(spark, fresh_name, writer):
    df = spark.createDataFrame([("1",)], "national_id string")
    with pytest.raises(ValueError, match="national_id"):
        if writer == "table":
            storage.write_table(df, fresh_name("t"))
        elif writer == "partition":
            storage.replace_partition(df, fresh_name("t"), "_batch_id", "b")
        else:
            storage.stage(df, "s")


def test_partition_is_replaced_alone(spark, fresh_name):
    table = fresh_name("t")
    for batch, n in (("it's", 2), ("b", 3), ("it's", 4)):
        storage.replace_partition(spark.range(n), table, "_batch_id", batch)
    counts = {r[0]: r[1] for r in spark.table(table).groupBy("_batch_id").count().collect()}
    assert counts == {"it's": 4, "b": 3}


def test_partitions_only_when_asked(spark, tmp_path, fresh_name):
    storage.write_table(spark.range(3), fresh_name("t"), path=str(tmp_path / "plain"))
    assert not list((tmp_path / "plain").glob("*=*"))


def test_csv_keeps_spaces_quotes_and_nulls(spark, tmp_path):
    rows = [(" a ", 'say "x", y', None), ("b", "", "c")]
    df = spark.createDataFrame(rows, "p string, q string, r string")
    storage.write_csv(df, str(tmp_path / "csv"))
    back = spark.read.options(header=True, escape='"').schema(df.schema).csv(str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == sorted([rows[0], ("b", None, "c")])


def test_fingerprint_ignores_order_but_counts_copies(spark):
    rows = [(i, str(i)) for i in range(50)]
    print_of = lambda data, n: storage.snapshot_fingerprint(
        spark.createDataFrame(data, "a int, b string").repartition(n)
    ).first()
    assert print_of(rows, 1) == print_of(rows[::-1], 7)
    assert print_of(rows, 1) != print_of(rows + rows[:1], 1)
    assert print_of([], 1)["content_hash"] == "0-0"


def test_fingerprint_sees_a_value_that_moves(spark):
    schema = "a string, b string"
    prints = {
        storage.snapshot_fingerprint(spark.createDataFrame([row], schema)).first()["content_hash"]
        for row in [(None, "x"), ("x", None), ("x", ""), ("", "x"), ("N", "x"), ("x|1:y", "z"), ("x", "y")]
    }
    assert len(prints) == 7


def test_reference_tables_are_typed_and_created_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS reference_test")
    names = storage.create_reference_tables(spark, REFERENCE_TABLES, "reference_test")
    assert len(names) == 3
    assert storage.create_reference_tables(spark, REFERENCE_TABLES, "reference_test") == []
    kinds = {
        f.name: f.dataType.simpleString()
        for f in spark.table("reference_test.client_contracts").schema
    }
    assert kinds == {
        "client_id": "string",
        "commission_rate": "decimal(9,6)",
        "sla_target_days": "int",
        "valid_from": "date",
        "valid_to": "date",
    }
    for contract in REFERENCE_TABLES.values():
        assert not any(f.dataType.typeName() in ("double", "float") for f in contract)
    spark.sql("DROP DATABASE reference_test CASCADE")


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = (storage.shared_folder(spark, "x") for _ in range(2))
    assert first.startswith(root) and first != second


def test_buckets_are_used_only_where_they_are_even(spark, fresh_name):
    rows = spark.range(4000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("k"), "id")
    even, uneven, empty = (fresh_name(n) for n in ("even", "uneven", "empty"))
    assert write_bucketed(rows, even, "k", 8, ["id"])
    assert write_bucketed(rows, even, "k", 8, ["id"]), "replacing it is fine"
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {even}").collect()}
    assert detail["Num Buckets"] == "8" and detail["Sort Columns"] == "[`k`, `id`]"
    assert spark.table(even).count() == 4000
    counted = {r.bucket: r.rows for r in bucket_counts(rows, "k", 8).collect()}
    files = spark.table(even).groupBy(F.input_file_name()).count().collect()
    assert sorted(r["count"] for r in files) == sorted(counted.values())

    hot = rows.withColumn("k", F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("k")))
    assert not write_bucketed(hot, uneven, "k", 64)
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {uneven}").collect()}
    assert "Num Buckets" not in detail and spark.table(uneven).count() == 4000
    assert write_bucketed(rows.limit(0), empty, "k", 8) and spark.table(empty).isEmpty()
    with pytest.raises(ValueError, match="differ"):
        write_bucketed(rows.select("k"), even, "k", 8)


def test_digests_of_partitions_add_up_and_tell_what_changed(spark, fresh_name):
    table, digests = fresh_name("digested"), fresh_name("digests")
    rows = spark.range(60).select("id", (F.col("id") % 3).cast("string").alias("part"), F.lit("b1").alias("batch"))
    storage.write_table(rows, table, partition_by=["part"])
    storage.refresh_digests(spark, table, digests, "part", batch_column="batch")
    before = spark.createDataFrame(spark.table(digests).collect(), spark.table(digests).schema)
    whole = storage.snapshot_fingerprint(spark.table(table), "batch").first()
    assert storage.total_fingerprint(before).first() == whole

    storage.replace_partition(rows.where("part = '1'").drop("part").limit(5), table, "part", "1")
    storage.replace_partition(rows.where("part = '2'").drop("part").limit(0), table, "part", "2")
    storage.replace_partition(rows.where("part = '0'").drop("part"), table, "part", "7")
    storage.refresh_digests(spark, table, digests, "part", ["1", "2", "7"], "batch")
    after = spark.table(digests)
    assert storage.total_fingerprint(after).first() == storage.snapshot_fingerprint(spark.table(table), "batch").first()
    changes = {r.part: r.change for r in storage.changed_partitions(before, after, "part").collect()}
    assert changes == {"1": "changed", "2": "removed", "7": "added"}
    empty = storage.total_fingerprint(after.limit(0)).first()
    assert (empty.rows, empty.content_hash) == (0, "0-0")
