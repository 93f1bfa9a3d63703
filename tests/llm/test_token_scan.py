import numpy as np
import pytest

from duebook.llm import token_scan
from duebook.llm.catalog import BYTE_PATTERN, END_OF_DOCUMENT, TOKENIZERS


def plain(values, separator):
    """Documents of a flat file, one identifier at a time."""
    out, start = [], 0
    for i, v in enumerate(values):
        if v == separator:
            out.append((start, i - start, True))
            start = i + 1
    if start < len(values):
        out.append((start, len(values) - start, False))
    return out


@pytest.mark.parametrize("block,reach", [(1, 3), (7, 1), (7, 5), (64, 2), (100_000, 512)])
def test_flat_files_against_plain_scan(spark, tmp_path, monkeypatch, block, reach):
    monkeypatch.setattr(token_scan, "RANGE_BLOCKS", reach)
    monkeypatch.setattr(token_scan, "HELD_BLOCKS", 2)
    rng = np.random.default_rng(block)
    files = [rng.integers(0, 9, n) for n in (1, 500, 64, 128)] + [np.full(130, 3), np.full(70, 9), np.array([], int)]
    files[1][[0, 1, -1]] = 9
    files[2][-1] = 9
    for i, values in enumerate(files):
        values[rng.random(len(values)) < 0.1] = 9
        values.astype("<u4").tofile(tmp_path / f"{i}.bin")
    blocks = token_scan.file_blocks(spark, str(tmp_path), width=4, block=block)
    found = token_scan.scanned(blocks, 9, "<u4").collect()
    for i, values in enumerate(files):
        own = sorted((r.doc_index, r.start, r.n_tokens, r.ended) for r in found if r.file.endswith(f"/{i}.bin"))
        assert own == [(k, *d) for k, d in enumerate(plain(values.tolist(), 9))]


def test_a_file_of_more_than_two_gigabytes(spark, tmp_path):
    n = 2**30 + 70_000
    ends = [0, 5, 16_383, 16_384, 2**29 - 1, 2**30 - 1, 2**30, n - 3]
    with open(tmp_path / "large.bin", "wb") as out:
        out.truncate(2 * n)
        for end in ends:
            out.seek(2 * end)
            out.write((9).to_bytes(2, "little"))
    blocks = token_scan.file_blocks(spark, str(tmp_path))
    found = sorted((r.doc_index, r.start, r.n_tokens, r.ended) for r in token_scan.scanned(blocks, 9).collect())
    starts = [0, *(e + 1 for e in ends)]
    assert found == [(i, s, e - s, e < n) for i, (s, e) in enumerate(zip(starts, [*ends, n]))]


def test_documents_through_written_files(spark, documents, no_documents, monkeypatch):
    import tiktoken

    monkeypatch.setattr(token_scan, "FILE_BLOCKS", 2)
    monkeypatch.setattr(token_scan, "BLOCK", 64)
    monkeypatch.setattr(token_scan, "RANGE_BLOCKS", 2)
    ranks = token_scan.ranks_of(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    coder = tiktoken.Encoding("t", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    folder, names = token_scan.flat_files(documents, ranks, BYTE_PATTERN, END_OF_DOCUMENT)
    scanned = token_scan.scanned(token_scan.file_blocks(spark, folder, block=64), END_OF_DOCUMENT)
    by_name = scanned.selectExpr("regexp_extract(file, '([^/]+).bin$', 1) AS file", "doc_index", "n_tokens", "ended")
    found = by_name.join(token_scan.named(names), ["file", "doc_index"]).collect()
    expected = sorted((str(r.doc_id), len(coder.encode_ordinary(r.text or ""))) for r in documents.collect())
    assert sorted((str(r.doc_id), r.n_tokens) for r in found) == expected
    assert all(r.ended for r in found)
    folder, names = token_scan.flat_files(no_documents, ranks, BYTE_PATTERN, END_OF_DOCUMENT)
    assert names.isEmpty()
    assert token_scan.scanned(token_scan.file_blocks(spark, folder), END_OF_DOCUMENT).isEmpty()


def test_packed_documents(documents, no_documents, monkeypatch):
    import tiktoken

    monkeypatch.setattr(token_scan, "BLOCK", 512)
    ranks = token_scan.ranks_of(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    coder = tiktoken.Encoding("t", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    files = token_scan.packed_files(documents, ranks, BYTE_PATTERN, END_OF_DOCUMENT).cache()
    found = token_scan.scanned(files, END_OF_DOCUMENT).join(token_scan.named(files), ["file", "doc_index"])
    expected = sorted((str(r.doc_id), len(coder.encode_ordinary(r.text or ""))) for r in documents.collect())
    assert sorted((str(r.doc_id), r.n_tokens) for r in found.collect()) == expected
    assert found.where("NOT ended").isEmpty()
    assert token_scan.packed_files(no_documents, ranks, BYTE_PATTERN, END_OF_DOCUMENT).isEmpty()


@pytest.mark.parametrize("file_blocks", [1, 2])
def test_documents_end_in_the_file_they_begin_in(documents, monkeypatch, file_blocks):
    import tiktoken

    monkeypatch.setattr(token_scan, "BLOCK", 64)
    monkeypatch.setattr(token_scan, "FILE_BLOCKS", file_blocks)
    ranks = token_scan.ranks_of(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    coder = tiktoken.Encoding("t", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    files = token_scan.packed_files(documents, ranks, BYTE_PATTERN, END_OF_DOCUMENT).cache()
    scanned = token_scan.scanned(files, END_OF_DOCUMENT).cache()
    assert scanned.where("NOT ended").isEmpty()
    assert scanned.select("file").distinct().count() > documents.rdd.getNumPartitions()
    found = scanned.join(token_scan.named(files), ["file", "doc_index"]).collect()
    expected = sorted((str(r.doc_id), len(coder.encode_ordinary(r.text or ""))) for r in documents.collect())
    assert sorted((str(r.doc_id), r.n_tokens) for r in found) == expected
    whole = {}
    for r in sorted(files.collect(), key=lambda r: (r.file, r.block)):
        assert len(r.tokens) <= 2 * 64
        whole[r.file] = whole.get(r.file, b"") + r.tokens
    assert sorted((r.file, r.start, r.n_tokens) for r in found) == sorted(
        (name, start, n)
        for name, tokens in whole.items()
        for start, n, _ in plain(np.frombuffer(tokens, "<u2").tolist(), END_OF_DOCUMENT)
    )
