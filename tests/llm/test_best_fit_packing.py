import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from duebook.llm import best_fit_packing, linear_grouping, word_cache
from duebook.llm.catalog import QUERIES, TOKENIZERS
from duebook.llm.common import staged
from duebook.llm.linear_grouping import Grouping

VOCABULARY = f"{TOKENIZERS}/byte_bpe_50k.json"
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"


def odd_texts(n, seed=1):
    r = random.Random(seed)
    pool = [chr(c) for c in (*range(0x530), *range(0x2000, 0x2070), *range(0x3000, 0x3060), 0x4E00)]
    pool += [" "] * 300 + ["\n"] * 60 + list("abcdefghij'stm") * 20
    pool += ["<|endoftext|>", "<s>", "▁", "\U0001f600"]
    return ["".join(r.choice(pool) for _ in range(r.randrange(60))) for _ in range(n)] + ["", "  ", " a", "a "]


def test_word_cache_gives_what_the_libraries_give_for_whole_texts():
    from sentencepiece import SentencePieceProcessor

    texts = odd_texts(6000)
    whole = Tokenizer.from_file(VOCABULARY)
    ids, counts = word_cache.byte_level(VOCABULARY, special_as_text=False).encode(texts)
    found = np.split(ids, np.cumsum(counts)[:-1])
    expected = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert [f.tolist() for f in found] == expected

    whole.encode_special_tokens = True
    cache = word_cache.byte_level(VOCABULARY, special_as_text=True, prefix=" ")
    cache._most = 10  # forgets between the calls
    for part in (texts[:3000], texts[3000:]):
        ids, counts = cache.encode(part)
        found = np.split(ids, np.cumsum(counts)[:-1])
        encoded = whole.encode_batch([" " + t for t in part], add_special_tokens=False)
        assert [f.tolist() for f in found] == [e.ids for e in encoded]

    ids, counts = word_cache.piece_level(PIECES).encode(texts)
    found = np.split(ids, np.cumsum(counts)[:-1])
    assert [f.tolist() for f in found] == SentencePieceProcessor(model_file=PIECES).encode(texts)


def used(counts, ranges, capacity):
    """Every document once, gapless sequences within the capacity; how many there are."""
    sequences, seen = collections.defaultdict(list), collections.Counter()
    for r in ranges:
        for k in range(r.each * r.sequences):
            place = r.offset + k % r.each * r.length
            sequences[r.sequence + k // r.each].append((place, r.length))
            seen[(r.length, r.rank + k)] += 1
    assert set(seen.values()) <= {1}
    assert set(seen) == {(length, k) for length, n in counts.items() for k in range(n)}
    for parts in sequences.values():
        end = 0
        for place, length in sorted(parts):
            assert place == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("share, groups", [(2, 24), (4, 8), (10, 40)])
@pytest.mark.parametrize("low, high", [(1, 100), (30, 70), (33, 40), (50, 51), (100, 101), (1, 3)])
def test_plans_are_whole_and_near_the_lower_bound(share, groups, low, high):
    r = random.Random(low)
    counts = collections.Counter(r.randrange(low, high) for _ in range(3000))
    ranges = linear_grouping.plan(counts, Grouping(100, ((share, groups),)))
    needed = max(-(-sum(n * c for n, c in counts.items()) // 100), sum(c for n, c in counts.items() if n > 50))
    each = 100 // low
    if high - low == 1:
        assert used(counts, ranges, 100) == -(-3000 // each)
    elif share == 2 and (low, high) in ((1, 100), (1, 3)):
        assert used(counts, ranges, 100) <= 1.06 * needed
    else:
        assert used(counts, ranges, 100) <= 1.5 * needed


def test_grouping_beats_plain_best_fit_where_lengths_come_in_threes():
    r = random.Random(3)
    counts = collections.Counter(r.randrange(650, 800) for _ in range(20000))
    best_fit = linear_grouping.plan(counts, Grouping(2048, ((2, 24),)))
    grouped = linear_grouping.plan(counts, Grouping(2048, ((2, 24), (3, 60), (6, 60))))
    assert used(counts, grouped, 2048) < 0.98 * used(counts, best_fit, 2048)


def test_a_plan_does_not_grow_with_the_documents():
    r = random.Random(4)
    counts = collections.Counter(min(int(r.expovariate(1 / 400)) + 1, 2048) for _ in range(20000))
    few = linear_grouping.plan(counts)
    many = linear_grouping.plan({n: c * 1_000_000 for n, c in counts.items()})
    assert len(many) < 2 * len(few) + 100
    assert linear_grouping.plan({}) == []
    with pytest.raises(ValueError):
        linear_grouping.plan({0: 1})


def check(rows, texts, capacity, row_key):
    """Pieces against whole encodings, and the sequences they make."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    expected = collections.Counter()
    for key, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            expected[(key, piece, a, b - a, crc)] += 1
    found = collections.Counter((row_key(r), r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert found == expected
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_documents_in_sequences(spark, documents, no_documents):
    rows = best_fit_packing.packed_documents(documents, VOCABULARY, grouping=Grouping(64, ((2, 8), (4, 8))))
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    n = check(rows.collect(), texts, 64, lambda r: r.row.doc_id)
    total = rows.agg(F.sum("length")).first()[0]
    assert n <= -(-total // 64) + 2
    assert rows.select("row.*").columns == documents.columns
    empty = best_fit_packing.packed_documents(no_documents, VOCABULARY)
    assert empty.count() == 0 and "sequence_id" in empty.columns


def test_registered_query_over_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = QUERIES["op12_best_fit_packing"](spark, sf_dir)
    total = rows.agg(F.sum("length")).first()[0]
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert check(rows.collect(), texts, 2048, lambda r: r.doc_id) <= -(-total // 2048) + 1


def test_sequences_hold_the_identifiers(spark, documents):
    rows = best_fit_packing.packed_documents(
        documents, VOCABULARY, F.struct("row.doc_id"), Grouping(256), end=50256, keep_ids=True
    )
    full = best_fit_packing.sequences(staged(rows, "packing-test"))
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ends = full.select(F.explode("ids").alias("i")).where("i = 50256").count()
    total = sum(
        len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in documents.collect()
    )
    assert ends == documents.count()
    assert full.agg(F.sum(F.size("ids"))).first()[0] == total
    assert full.where(F.size("ids") > 256).count() == 0
