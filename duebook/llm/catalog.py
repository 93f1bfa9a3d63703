"""The registered queries of the text operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm import (
    best_fit_packing,
    context_mixing,
    host_rules,
    metric_tree,
    near_copies,
    page_text,
    personal_data,
    pieces,
    source_mix,
    token_alignment,
    token_scan,
    url_rules,
    whitening,
)
from duebook.llm.common import staged, table

#: Public vocabularies; a folder of the same files may stand anywhere.
TOKENIZERS = "/opt/tokenizers"
#: Fixed values that belong to byte_bpe_50k.tiktoken: what splits a text before the merges, and the free
#: identifier that ends a document.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_DOCUMENT = 50256

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ANSWERS: dict[str, str] = {}


def query(answer: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if answer is not None:
            ANSWERS[function.__name__] = answer
        return function

    return register


HOST_RULES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), w AS (
  SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM w) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(8) r(k) GROUP BY rid
), m AS (
  SELECT d.doc_id, d.source AS host, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid)
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words
         OR 100 * n_dup_lines > 30 * n_lines OR word_chars > 15 * n_words AS rule_failed
  FROM m
), h AS (
  SELECT host, count(*) AS docs, count(*) FILTER (WHERE rule_failed) AS failures FROM f GROUP BY host
), moments AS (
  SELECT sum(failures) / sum(docs) AS m, var_pop(failures / docs) AS between_hosts,
         avg(1 / docs) AS per_doc FROM h
), prior AS (
  SELECT m, CASE WHEN between_hosts - m * (1 - m) * per_doc <= m * (1 - m) / 10001 THEN 10000.0
    ELSE greatest(m * (1 - m) / (between_hosts - m * (1 - m) * per_doc) - 1, 1.0) END AS strength
  FROM moments
), v AS (
  SELECT host, (failures + m * strength) / (docs + strength)
         > least(m + sqrt(m * (1 - m) / (strength + 1)), 0.5) AS host_failed FROM h, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR (host_failed AND rule_failed)) AS kept
FROM f JOIN v ON f.host IS NOT DISTINCT FROM v.host
"""


@query(HOST_RULES_SQL)
def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    measures = staged(host_rules.measured(docs, F.struct("row.doc_id")), "host-rules")
    return host_rules.judged(measures).select(
        "row.doc_id", *host_rules.MEASURES, "base_failed", "kept"
    )


@query()
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = staged(source_mix.sized(docs, F.struct("row.doc_id")), "mix-sizes")
    return source_mix.mixed(rows).select("row.doc_id", "size", "source_size", "target", "taken")


URL_RULES_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), h AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), sites(rule, verdict, site, prefix) AS (
  VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
         ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
), found AS (
  SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, max_by(s.verdict, length(rule)) AS site
  FROM h LEFT JOIN sites s
    ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, prefix)
  GROUP BY ALL
)
SELECT page_id, host, path, rule,
       CASE WHEN site IS NOT NULL THEN site
            WHEN contains(host || path, '/docs/') THEN 'allow'
            WHEN regexp_matches(host || path,
              '/login/|/cart/|/search/.*/page/|/tag/|blog\..*/es/|/wp-admin/|\.zip') THEN 'block'
            ELSE 'allow' END AS verdict
FROM found
"""


@query(URL_RULES_SQL)
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = url_rules.SITE_RULES + url_rules.PATTERN_RULES
    return url_rules.judged(pages, rules).select("row.page_id", "host", "path", "rule", "verdict")


NEAR_COPIES_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i
        FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS hits
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM common JOIN n n1 ON n1.doc_id = x JOIN n n2 ON n2.doc_id = y
  WHERE 100 * hits >= 85 * (n1.n + n2.n - hits)
), reach AS (
  SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), c AS (
  SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
         least(w.doc_id, coalesce(min(reach.y), w.doc_id)) AS component_id
  FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach ON reach.x = w.doc_id
  GROUP BY w.doc_id, n.n
)
SELECT *, doc_id = component_id AS kept FROM c
"""


@query(NEAR_COPIES_SQL)
def op9_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return near_copies.grouped(docs, near_copies.Likeness(words=3, percent=85)).select(
        "doc_id", "n_shingles", "component_id", kept.alias("kept")
    )


@query()
def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encoded(docs, f"{TOKENIZERS}/piece_bpe_32k.model").select(
        "row.doc_id", "n_tokens", "round_trip", "ids"
    )


@query()
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_data.detected(docs).select(
        "row.doc_id", *(f"n_{kind}" for kind in personal_data.KINDS), "base_sha256", "spans"
    )


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id, score
FROM s QUALIFY rank <= 5
"""


@query(TOP_K_SQL)
def op3_metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metric_tree.integers(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return metric_tree.top_k(rows, F.col("vec_id") % 50 == 0)


@query()
def op10_token_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = token_scan.ranks_of(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    folder, names = token_scan.flat_files(docs, ranks, BYTE_PATTERN, END_OF_DOCUMENT)
    name = F.regexp_extract("file", r"([^/]+)\.bin$", 1)
    return (
        token_scan.scanned(token_scan.file_blocks(spark, folder), END_OF_DOCUMENT)
        .withColumn("file", name)
        .join(token_scan.named(names), ["file", "doc_index"])
        .select("doc_id", "n_tokens", "file", "doc_index", "start", "ended")
    )


@query()
def op1_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extracted(table(spark, sf_dir, "pages"))


@query()
def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.scored(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return best_fit_packing.packed_documents(
        docs, f"{TOKENIZERS}/byte_bpe_50k.json", F.struct("row.doc_id")
    ).select(
        "row.doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32",
        "sequence_id", "offset",
    )


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    rows = whitening.components(vectors, F.struct("row.vec_id"))
    return rows.select(
        "row.vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"),
        "whitened", "explained", "identity_error",
    )


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.aligned(
        docs, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model", F.struct("row.doc_id")
    ).select("row.doc_id", *token_alignment.MEASURES, "n_best", "count_sum", "groups_sha256")
