import collections
import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from duebook.llm import token_alignment
from duebook.llm.catalog import QUERIES, TOKENIZERS
from duebook.llm.word_cache import byte_decoder

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"


def plain(rows):
    """Every link written out, from the two libraries on whole texts."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    vocabulary = {i: t for t, i in json.load(open(A))["model"]["vocab"].items()}
    model, decoder = SentencePieceProcessor(model_file=B), byte_decoder()
    pieces = [model.id_to_piece(i) for i in range(len(model))]

    def bytes_of(side, i):
        if side == 0:
            return bytes(decoder[c] for c in vocabulary[i])
        if model.is_byte(i):
            return bytes([int(pieces[i][3:5], 16)])
        return pieces[i].replace("▁", " ").encode()

    documents, holders = [], collections.Counter()
    for key, text in rows:
        wanted = f" {text}".encode()
        sides = [tokenizer.encode(f" {text}", add_special_tokens=False).ids, model.encode(text or "")]
        joined = [b"".join(bytes_of(s, i) for i in ids) for s, ids in enumerate(sides)]
        groups = []
        if text and joined == [wanted, wanted]:
            ends = [np.cumsum([len(bytes_of(s, i)) for i in ids]).tolist() for s, ids in enumerate(sides)]
            border = [set(e) for e in ends]
            cuts = sorted(border[0] & border[1])
            start = 0
            for cut in cuts:
                groups.append(
                    tuple([i for i, e in zip(ids, es) if start < e <= cut] for ids, es in zip(sides, ends))
                )
                start = cut
        links = [(a, b) for g in groups for a in g[0] for b in g[1]]
        documents.append((key, groups, links))
        holders.update(set(links))
    highest = collections.Counter()
    for (a, _), n in holders.items():
        highest[a] = max(highest[a], n)
    results = collections.Counter()
    for key, groups, links in documents:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        n_a, n_b = (sum(len(g[s]) for g in groups) for s in (0, 1))
        best = sum(holders[p] == highest[p[0]] for p in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        count_sum = sum(holders[p] for p in links)
        results[(key, n_a, n_b, len(groups), len(links), best, count_sum, digest)] += 1
    return results, holders, highest


def found(df, key):
    columns = [*token_alignment.MEASURES, "n_best", "count_sum", "groups_sha256"]
    return collections.Counter((r[0], *r[1:]) for r in df.select(key, *columns).collect())


@pytest.fixture(scope="module")
def texts(documents):
    odd = ["日本語 と 中国 語 の 文 章 " * 30, "aaaa" * 500, "a▁b", "<|endoftext|> and <s>", " ", "\n\n", "é" * 90]
    rows = [(200 + i, t, None, None, 1, None, 2, "r", "s", "h", "i") for i, t in enumerate(odd * 2)]
    return documents.union(documents.sparkSession.createDataFrame(rows, documents.schema)).repartition(5)


def test_against_every_link_written_out(spark, texts):
    expected, holders, highest = plain([(r.doc_id, r.text) for r in texts.collect()])
    df = token_alignment.aligned(texts, A, B)
    assert df.select("row.*").columns == texts.columns
    assert found(df, "row.doc_id") == expected
    pairs = {(r.a_id, r.b_id): (r.documents, r.best) for r in token_alignment.pair_counts(texts, A, B).collect()}
    assert pairs == {p: (n, n == highest[p[0]]) for p, n in holders.items()}


def test_many_small_runs_levels_and_segments(spark, texts, monkeypatch):
    monkeypatch.setattr(token_alignment, "FAN_BITS", 1)
    expected, _, _ = plain([(r.doc_id, r.text) for r in texts.collect()])
    df = token_alignment.aligned(texts, A, B, F.struct("row.doc_id"), buffer=700)
    assert found(df, "row.doc_id") == expected


def test_a_document_in_segments_has_the_same_links():
    aligner = token_alignment.Aligner(A, B)
    x = aligner.align(["short", "aaaa" * 300 + " 中文字 " * 40 + "the cat " * 50, ""])
    layout = aligner.layout
    keys, weights = np.unique(token_alignment.links_of(layout, x, 1, 2, 5), return_counts=True)
    for most in (1, 50, 10**6):
        parts = list(token_alignment.links_in_segments(layout, x, 1, 5, most))
        assert np.concatenate([k for k, _ in parts]).tolist() == keys.tolist()
        assert np.concatenate([w for _, w in parts]).tolist() == weights.tolist()
    a, b = layout.identifiers(keys >> layout.doc_bits)
    assert (layout.pair(a, b) == keys >> layout.doc_bits).all()


def test_empty_table(no_documents):
    df = token_alignment.aligned(no_documents, A, B)
    assert df.count() == 0 and "count_sum" in df.columns
    assert token_alignment.pair_counts(no_documents, A, B).count() == 0


def test_registered_query_over_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    expected, _, _ = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert found(QUERIES["op11_token_alignment"](spark, sf_dir), "doc_id") == expected
