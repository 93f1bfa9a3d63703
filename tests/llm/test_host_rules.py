import duckdb

from duebook.llm import host_rules
from duebook.llm.catalog import HOST_RULES_SQL
from duebook.llm.common import unpacked
from pyspark.sql import functions as F


def _found(df):
    columns = ["doc_id", *host_rules.MEASURES, "base_failed", "kept"]
    measures = host_rules.measured(df, F.struct("row.doc_id"))
    return host_rules.judged(measures).select("row.doc_id", *columns[1:])


def test_edges_match_sql(documents, tmp_path):
    path = str(tmp_path / "documents")
    documents.select("doc_id", "text", "source").coalesce(1).write.parquet(path)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    expected = duck.execute(HOST_RULES_SQL).fetchall()
    found = [tuple(r) for r in _found(documents).collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_repeats_against_brute_force(spark):
    cases = ["a b c d e f g h", "a b c d e f g h a b c d e f g h", " ".join("x" * 30), " ".join("ab" * 20) + " z", ""]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(cases)], "doc_id int, text string, source string")
    for row in _found(df).collect():
        w = cases[row.doc_id].split()
        wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        covered = {i + k for i, x in enumerate(wins) if wins.count(x) > 1 for k in range(8)}
        assert row.n_repeat_words == len(covered)


def test_host_verdict_spares_documents_that_pass_every_rule(spark):
    good = " ".join(f"word{i}" for i in range(40))
    noisy = good.replace(" ", "# ")
    rows = [(i, noisy, "bad") for i in range(200)] + [(900, good, "bad"), (901, noisy, "fine")]
    rows += [(1000 + i, good, "fine") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    kept = {r.doc_id: r.kept for r in _found(df).collect()}
    assert not kept[0] and kept[900] and kept[901] and kept[1000]


def _hosts(spark, hosts):
    """A table of hosts, each with so many documents, the first of which fail a looser rule."""
    good = " ".join(f"word{i}" for i in range(40))
    noisy = good.replace(" ", "# ")
    rows = [(h * 10_000 + i, noisy if i < bad else good, f"h{h}") for h, (n, bad) in enumerate(hosts) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id int, text string, source string")


def test_the_limit_follows_the_prior(spark, tmp_path):
    # one host of 300 far above the others, and one of 4 with the same share: too few to tell
    df = _hosts(spark, [(300, 15)] * 8 + [(300, 100), (4, 1)])
    found = {r.doc_id: r.kept for r in _found(df).collect()}
    assert all(kept == (not (80_000 <= i < 80_100)) for i, kept in found.items())
    path = str(tmp_path / "documents")
    df.coalesce(1).write.parquet(path)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert dict(duck.execute(f"SELECT doc_id, kept FROM ({HOST_RULES_SQL})").fetchall()) == found


def test_hosts_that_differ_by_chance_only_do_not_fail(spark):
    assert _found(_hosts(spark, [(50, n) for n in (4, 5, 6, 7, 8, 9, 10, 12)])).where("NOT kept").isEmpty()


def test_extra_columns_and_empty_tables(documents, no_documents):
    out = unpacked(host_rules.judged(host_rules.measured(documents, F.col("row"))).where("kept"))
    assert out.columns == documents.columns
    assert not out.isEmpty()
    assert _found(no_documents).isEmpty()
