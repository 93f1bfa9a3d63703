import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duebook.llm import pieces
from duebook.llm.catalog import TOKENIZERS

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(MODEL)


def plain_score(text, words, voc):
    """Best score by trying every piece at every character, without trie or chunks."""
    if not text:
        return 0.0
    text = " " + text
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + 20) + 1):
            raw = text[i:j].replace(" ", "▁") if "▁" not in text[i:j] else None
            score = words.get(raw)
            if score is not None:
                best[j] = max(best[j], best[i] + score)
        if words.get(text[i].replace(" ", "▁") if text[i] != "▁" else None) is None:
            best[i + 1] = max(best[i + 1], best[i] + voc.unknown)
    return best[-1]


def path_score(ids, voc):
    """Score of ids, where runs of byte pieces stand for characters without a piece."""
    total, raw = 0.0, b""
    byte = set(voc.byte_id.tolist())
    for i in [*ids, None]:
        if i in byte:
            raw += voc.text[i]
            continue
        total += voc.unknown * len(raw.decode())
        raw = b""
        if i is not None:
            total += voc.score[i]
    return total


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="the anding\n▁中é😀", max_size=40))
def test_best_path_and_round_trip(vocabulary, text):
    words = {
        (b if not b.startswith(b" ") else b).decode().replace(" ", "▁"): float(s)
        for i, (b, s) in enumerate(zip(vocabulary.text, vocabulary.score))
        if b and i not in set(vocabulary.byte_id.tolist())
    }
    coder = pieces.Coder(vocabulary)
    ids = pieces.encode_column(pa.array([text]), coder)[0].as_py()
    assert path_score(ids, vocabulary) == pytest.approx(plain_score(text, words, vocabulary), rel=1e-12)
    assert coder.decode(np.array(ids, np.int64)).decode() == text


def test_trie_finds_exactly_its_words():
    words = {w.encode(): i for i, w in enumerate(["a", "ab", "abc", "b", "中", "中文", "zebra"])}
    base, check, value = pieces.double_array(words)

    def look(word):
        state = 0
        for c in word:
            child = base[state] + c
            if check[child] != state:
                return -1
            state = child
        return value[state]

    assert all(look(w) == i for w, i in words.items())
    assert look("abd".encode()) == -1 and look(b"zeb") == -1 and look(b"q") == -1


def test_best_path_of_the_library_scores_the_same(vocabulary):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(open(MODEL, "rb").read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    coder = pieces.Coder(vocabulary)
    for text in ("the thing", "Inth onston of onti", "hand and end", "eauxtion"):
        ids = pieces.encode_column(pa.array([text]), coder)[0].as_py()
        best = library.nbest_encode(text, nbest_size=8)[0]
        assert vocabulary.score[ids].sum() == vocabulary.score[best].sum()


def test_edges(documents, no_documents):
    found = pieces.encoded(documents, MODEL).collect()
    assert len(found) == documents.count()
    for r in found:
        assert r.round_trip and r.n_tokens == len(r.ids)
        assert (r.n_tokens == 0) == (not r["row"].text)
    assert pieces.encoded(no_documents, MODEL).isEmpty()


def test_long_texts_in_segments(vocabulary, monkeypatch):
    coder = pieces.Coder(vocabulary)
    text = "some  words   and\nlines " * 300
    whole = pieces.encode_column(pa.array([text]), coder)[0].as_py()
    monkeypatch.setattr(pieces, "SEGMENT", 50)
    monkeypatch.setattr(pieces, "CACHED_CHUNKS", 3)
    assert pieces.encode_column(pa.array([None, text, ""]), pieces.Coder(vocabulary)).to_pylist() == [[], whole, []]
