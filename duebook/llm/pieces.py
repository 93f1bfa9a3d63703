"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The vocabulary (pieces, log scores, byte pieces) is read from a model file once on the driver and laid
out as a double array over UTF-8 bytes. A text gets a leading space, spaces become the white-space marker,
and no piece holds a marker behind other characters, so the best path of a text is the best paths of
its chunks (a run of spaces and what follows) one after another. Equal chunks of a batch are solved
once; the trie walk and the Viterbi steps run over all chunks of a batch together.

A character without a piece costs the lowest score less 10 and becomes byte pieces. Of paths with the same
score the one found first stays; places are worked off from the left, short pieces before long ones.

Edge cases. NULL and empty texts have no ids and decode to an empty text. A marker character (U+2581)
written in the text itself is encoded as byte pieces, so decoding gives it back and not a space. Texts of any
length are worked off in segments cut at spaces. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm.common import packed
from duebook.llm.hashing import text_buffers

MARKER = "▁".encode()
#: Stands for a marker that the text itself holds; the byte occurs in no UTF-8 text.
OWN_MARKER = b"\xff"
UNKNOWN_PENALTY = 10.0
SEGMENT = 1 << 21
CACHED_CHUNKS = 300_000
CHUNK = re.compile(rb" +[^ ]*")


@dataclass
class Vocabulary:
    """Double array (``base``, ``check``, ``value``), scores and bytes of the pieces."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    score: np.ndarray
    text: list[bytes]
    byte_id: np.ndarray

    @property
    def unknown(self) -> float:
        return float(self.score.min()) - UNKNOWN_PENALTY


def double_array(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A trie in two arrays: the child of state s by byte c is ``base[s] + c`` if ``check`` says s."""
    tree: list[dict[int, int]] = [{}]
    ends: list[int] = [-1]
    for word, number in words.items():
        node = 0
        for c in word:
            if c not in tree[node]:
                tree[node][c] = len(tree)
                tree.append({})
                ends.append(-1)
            node = tree[node][c]
        ends[node] = number
    size = len(tree) + 1024
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    free, used = 256, 256
    todo = [(0, 0)]
    for node, state in todo:
        children = tree[node]
        value[state] = ends[node]
        if not children:
            continue
        codes = sorted(children)
        while free < size and check[free] != -1:
            free += 1
        # a few tries among the gaps, else behind everything
        for offset in (*range(free - codes[0], free - codes[0] + 16), used + 1 - codes[0]):
            if offset + codes[-1] >= size:
                more = offset + codes[-1] + 4096 - size
                base, check, value = base + [0] * more, check + [-1] * more, value + [-1] * more
                size += more
            if all(check[offset + c] == -1 for c in codes):
                break
        base[state] = offset
        used = max(used, offset + codes[-1])
        for c in codes:
            check[offset + c] = state
            todo.append((children[c], offset + c))
    pad = [0] * 256
    return (
        np.array(base + pad, np.int32),
        np.array(check + [-1] * 256, np.int32),
        np.array(value + [-1] * 256, np.int32),
    )


def load(model_file: str) -> Vocabulary:
    """Pieces and scores of a SentencePiece model file with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    words, score, text = {}, [], []
    byte_id = np.full(256, -1, np.int32)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        score.append(model.get_score(i))
        if model.is_control(i) or model.is_unknown(i):
            text.append(b"")
        elif model.is_byte(i):
            byte_id[int(piece[3:5], 16)] = i
            text.append(bytes([int(piece[3:5], 16)]))
        else:
            raw = piece.encode()
            if MARKER in raw.lstrip(MARKER) and raw.replace(MARKER, b""):
                raise ValueError(f"piece {piece!r} holds a marker behind other characters")
            words[raw] = i
            text.append(raw.replace(MARKER, b" "))
    if (byte_id < 0).any():
        raise ValueError("the model has no byte pieces to fall back to")
    return Vocabulary(*double_array(words), np.array(score, np.float64), text, byte_id)


def _flat(chosen: np.ndarray, begins: np.ndarray, counts: np.ndarray, items: np.ndarray) -> np.ndarray:
    """``items[begins[k] : begins[k] + counts[k]]`` for every k of ``chosen``, one after another."""
    own = counts[chosen]
    ends = np.cumsum(own)
    within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - own, own)
    return items[np.repeat(begins[chosen], own) + within]


def best_paths(chunks: list[bytes], voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the best path of every chunk, flat, and their numbers."""
    raw = np.frombuffer(b"".join(chunks), np.uint8)
    sizes = np.fromiter((len(c) for c in chunks), np.int64, len(chunks))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    end_of = np.repeat(ends, sizes)
    letter = (raw & 0xC0) != 0x80
    letter[begins] = True
    heads = np.flatnonzero(letter)
    width = np.diff(np.append(heads, len(raw)))

    # all pieces that begin at any character, walked one byte at a time
    starts, lengths, ids = [], [], []
    at, state, depth = heads, np.zeros(len(heads), np.int32), 0
    single = np.zeros(len(raw), bool)
    while len(at):
        inside = at + depth < end_of[at]
        at, state = at[inside], state[inside]
        child = voc.base[state] + raw[at + depth]
        fits = voc.check[child] == state
        at, state = at[fits], child[fits]
        depth += 1
        whole = voc.value[state] >= 0
        starts.append(at[whole])
        lengths.append(np.full(int(whole.sum()), depth))
        ids.append(voc.value[state[whole]])
    start, length, piece = (np.concatenate(x) for x in (starts, lengths, ids))
    width_at = np.zeros(len(raw), np.int64)
    width_at[heads] = width
    single[start[length == width_at[start]]] = True
    lone = heads[~single[heads]]
    start = np.concatenate([start, lone])
    length = np.concatenate([length, width_at[lone]])
    score = np.concatenate([voc.score[piece], np.full(len(lone), voc.unknown)])
    piece = np.concatenate([piece, np.full(len(lone), -1, piece.dtype)])

    # Viterbi: places in order, all chunks at once; targets of one place and length are distinct
    place = start - np.repeat(begins, sizes)[start]
    order = np.lexsort((length, place))
    start, length, piece, score = start[order], length[order], piece[order], score[order]
    key = place[order] * (int(length.max(initial=1)) + 1) + length
    cuts = np.flatnonzero(np.diff(key, prepend=-1))
    # one slot more per chunk, for the place behind its last byte
    slot_begin = begins + np.arange(len(chunks))
    slot = start + np.repeat(np.arange(len(chunks)), sizes)[start]
    best = np.full(len(raw) + len(chunks), -np.inf)
    best[slot_begin] = 0.0
    via = np.full(len(best), -1, np.int64)
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)]):
        target = slot[a:b] + length[a:b]
        candidate = best[slot[a:b]] + score[a:b]
        better = candidate > best[target]
        best[target[better]] = candidate[better]
        via[target[better]] = np.arange(a, b)[better]

    # back along the paths, all chunks at once
    who, at = np.arange(len(chunks)), ends + np.arange(len(chunks))
    owners, edges = [], []
    while len(who):
        edge = via[at]
        owners.append(who)
        edges.append(edge)
        at = slot[edge]
        more = at > slot_begin[who]
        who, at = who[more], at[more]
    owner, edge = np.concatenate(owners), np.concatenate(edges)
    order = np.lexsort((slot[edge], owner))
    owner, edge = owner[order], edge[order]

    # characters without a piece become the ids of their bytes
    lone = piece[edge] < 0
    count = np.where(lone, length[edge], 1)
    own = np.where(lone & (raw[start[edge]] == OWN_MARKER[0]), len(MARKER), count)
    flat_owner = np.repeat(owner, own)
    within = np.arange(len(flat_owner)) - np.repeat(np.cumsum(own) - own, own)
    flat_edge = np.repeat(edge, own)
    byte = raw[np.minimum(start[flat_edge] + within, len(raw) - 1)]
    marked = np.repeat(own != count, own)
    byte = np.where(marked, np.frombuffer(MARKER, np.uint8)[within % len(MARKER)], byte)
    result = np.where(piece[flat_edge] < 0, voc.byte_id[byte], piece[flat_edge])
    return result.astype(np.int32), np.bincount(flat_owner, minlength=len(chunks))


class Coder:
    """Encodes and decodes with the paths of the chunks seen so far at hand (a bounded number)."""

    def __init__(self, voc: Vocabulary):
        self.voc = voc
        self.text = np.frombuffer(b"".join(voc.text), np.uint8)
        self.text_size = np.array([len(t) for t in voc.text])
        self.text_begin = np.cumsum(self.text_size) - self.text_size
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.count = np.zeros(0, np.int64)
        self.begin = np.zeros(0, np.int64)

    def _learn(self, chunks: list[bytes]) -> None:
        if len(self.number) > CACHED_CHUNKS:
            self._forget()
        new = [c for c in dict.fromkeys(chunks) if c not in self.number]
        if new:
            ids, count = best_paths([c.replace(b" ", MARKER) for c in new], self.voc)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.ids = np.concatenate([self.ids, ids])
            self.count = np.concatenate([self.count, count])
            self.begin = np.cumsum(self.count) - self.count

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and how many each of ``texts`` (UTF-8, with its leading space) has."""
        chunks: list[bytes] = []
        bounds = [0]
        for text in texts:
            chunks += CHUNK.findall(text.replace(MARKER, OWN_MARKER))
            bounds.append(len(chunks))
        self._learn(chunks)
        number = self.number
        chosen = np.fromiter((number[c] for c in chunks), np.int64, len(chunks))
        total = np.concatenate([[0], np.cumsum(self.count[chosen])])
        return _flat(chosen, self.begin, self.count, self.ids), np.diff(total[bounds])

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 text of the ids; the leading space of the encoding goes."""
        return _flat(ids, self.text_begin, self.text_size, self.text).tobytes().removeprefix(b" ")


def _segments(text: bytes) -> Iterator[bytes]:
    """The text with its leading space, in parts of about SEGMENT bytes that begin with a space run."""
    text = b" " + text if text else text
    at = 0
    while len(text) - at > SEGMENT:
        cut = text.find(b" ", at + SEGMENT)
        while cut > 0 and text[cut - 1 : cut] == b" ":
            cut = text.find(b" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:]


def encode_column(texts: pa.Array, coder: Coder) -> pa.ListArray:
    """Ids of every text of a string column."""
    raw, begins = text_buffers(texts)
    data = raw.tobytes()
    counts = np.zeros(len(begins) - 1, np.int64)
    done, batch, owner, size = [], [], [], 0

    def flush() -> None:
        ids, n = coder.encode(batch)
        done.append(ids)
        np.add.at(counts, owner, n)

    for i in range(len(counts)):
        for segment in _segments(data[begins[i] : begins[i + 1]]):
            batch.append(segment)
            owner.append(i)
            size += len(segment)
            if size > SEGMENT:
                flush()
                batch, owner, size = [], [], 0
    if batch:
        flush()
    ids = np.concatenate(done) if done else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(
        np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(ids, pa.int32())
    )


def encoded(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs`` packed as ``row``, with ``ids``, ``n_tokens`` and ``round_trip``: whether decoding
    the ids gives the text back, byte for byte."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(load(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                row = batch["row"]
                texts = pa.array(row.field("text").cast(pa.large_string()))
                ids = encode_column(texts, coder)
                same = []
                values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
                for text, a, b in zip(texts, offsets, offsets[1:]):
                    same.append(coder.decode(values[a:b]) == (text.as_py() or "").encode())
                yield pa.RecordBatch.from_arrays(
                    [row, ids, pa.array(np.diff(offsets).astype(np.int64)), pa.array(same, pa.bool_())],
                    names=["row", "ids", "n_tokens", "round_trip"],
                )

    rows = packed(docs)
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"row {kind}, ids array<int>, n_tokens long, round_trip boolean"
    )
