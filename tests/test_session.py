import pytest

from duebook.catalog import QUERIES
from duebook.session import FIRST_PARTITIONS, TASK_SIZES, bound_tasks, input_bytes
from duebook.sources.storage import buckets_for


@pytest.fixture
def fresh(spark):
    """A session of its own settings, as a user starts it."""
    return spark.newSession()


def test_queries_bound_what_one_task_reads(fresh, sf_dir):
    QUERIES["leakage_check"](fresh, sf_dir)
    assert {name: fresh.conf.get(name) for name in TASK_SIZES} == TASK_SIZES


def test_sizes_of_the_session_stay(fresh):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    fresh.conf.set(name, "8m")
    bound_tasks(fresh)
    assert fresh.conf.get(name) == "8m"
    assert fresh.conf.get("spark.sql.files.maxPartitionBytes") == "32m"


def test_buckets_grow_with_the_rows(spark):
    assert [buckets_for(spark.range(n), 8, rows=100) for n in (0, 800, 801, 8000)] == [8, 8, 9, 80]


def test_shuffles_begin_with_more_partitions_over_more_input(fresh, tmp_path):
    rows = fresh.range(40000).selectExpr("md5(string(id)) AS key", "id")
    sizes, first = [], []
    for n in (1, 5):
        rows.repartition(n).write.parquet(f"{tmp_path}/{n}/rows.parquet")
        fresh.range(n).write.mode("append").parquet(f"{tmp_path}/{n}/more.parquet")
        for _ in range(n - 1):
            rows.write.mode("append").parquet(f"{tmp_path}/{n}/rows.parquet")
        bound_tasks(fresh, f"{tmp_path}/{n}", shuffled=100_000)
        sizes.append(input_bytes(fresh, f"{tmp_path}/{n}"))
        first.append(int(fresh.conf.get(FIRST_PARTITIONS)))
        counted = fresh.read.parquet(f"{tmp_path}/{n}/rows.parquet").groupBy("key").count()
        assert counted.count() == 40000
    assert sizes[1] > 4 * sizes[0] and first[1] > 4 * first[0] >= 16
    assert first == [-(-s // 100_000) for s in sizes]


def test_a_session_with_many_partitions_keeps_them(fresh, sf_dir):
    fresh.conf.set("spark.sql.shuffle.partitions", "77")
    QUERIES["fct_servicing"](fresh, sf_dir)
    assert fresh.conf.get(FIRST_PARTITIONS) == "77"
