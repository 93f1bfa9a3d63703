"""Token identifiers of whole texts from a cache of words.

A space between two visible characters always ends a pre-token of the public vocabularies, and no token
reaches over it. The stretches between such spaces can then be encoded once each by the tokenizer's own
library, and a text is the concatenation of its stretches. Everything else (line breaks, runs of spaces,
unusual white space) stays inside a stretch, where the library decides.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np

#: Characters that any version of Unicode or of the vocabularies could count as white space, and controls.
_DOUBTFUL = r"\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u206f\u2581\u3000\ufeff"
_BETWEEN_WORDS = re.compile(rf" (?=[^{_DOUBTFUL}])(?<=[^{_DOUBTFUL}] )")
_NOT_PLAIN = re.compile(r"<\||[^\x00-\u024f]")
#: Fixed value: what splits a text before the merges of the byte-level vocabularies.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

Encode = Callable[[list[str]], Sequence[Sequence[int]]]


class _Places(dict):
    """Stretch to its number; a stretch that is asked for the first time gets the next one."""

    def __init__(self, count: Callable[[], int]):
        self._count = count
        self.unseen: list[str] = []

    def __missing__(self, stretch: str) -> int:
        place = self[stretch] = self._count() + len(self.unseen)
        self.unseen.append(stretch)
        return place


class WordCache:
    """``first`` encodes how a text begins, ``later`` a stretch as it stands behind its space.

    The cache forgets everything once it holds ``most`` stretches, so its memory is bounded.
    """

    def __init__(self, first: Encode, later: Encode, most: int = 1 << 20):
        self._encoders = first, later
        self._most = most
        self._forget()

    def _forget(self) -> None:
        self._places = tuple(_Places(lambda: len(self._starts) - 1) for _ in range(2))
        self._starts = np.zeros(1, np.int64)
        self._ids = np.empty(0, np.int32)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(identifiers of all texts in a row, how many each text has). Empty texts have none."""
        if not len(texts):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        if len(self._starts) > self._most:
            self._forget()
        first, later, counts = [], [], []
        for text in texts:
            stretches = _BETWEEN_WORDS.split(text)
            first.append(stretches[0])
            later.extend(stretches[1:])
            counts.append(len(stretches))
        counts = np.asarray(counts, np.int64)
        heads = np.cumsum(counts) - counts
        is_head = np.zeros(counts.sum(), bool)
        is_head[heads] = True
        places = np.empty(len(is_head), np.int64)
        places[is_head] = self._look_up(0, first)
        places[~is_head] = self._look_up(1, later)

        lengths = self._starts[places + 1] - self._starts[places]
        ends = np.cumsum(lengths)
        shift = np.repeat(self._starts[places] - (ends - lengths), lengths)
        return self._ids[shift + np.arange(ends[-1])], np.add.reduceat(lengths, heads)

    def _look_up(self, kind: int, stretches: list[str]) -> np.ndarray:
        known = self._places[kind]
        places = np.fromiter(map(known.__getitem__, stretches), np.int64, len(stretches))
        if known.unseen:
            found = self._encoders[kind](known.unseen)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.int32, lengths.sum())
            self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(lengths)])
            self._ids = np.concatenate([self._ids, flat])
            known.unseen = []
        return places


def byte_decoder() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte, and that byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_tokens(path: str) -> list[bytes]:
    """The bytes of every identifier of a byte-level vocabulary file; special tokens stand for nothing."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"] for t in content["added_tokens"] if t["special"]}
    decoder = byte_decoder()
    tokens = [b""] * (1 + max(content["model"]["vocab"].values()))
    for token, number in content["model"]["vocab"].items():
        if token not in special:
            tokens[number] = bytes(map(decoder.__getitem__, token))
    return tokens


def byte_level(path: str, special_as_text: bool, prefix: str = "") -> WordCache:
    """A byte-level vocabulary file; ``prefix`` is put before every text.

    Plain stretches are merged by ``tiktoken``, whose ranks are the identifiers of the same file and which
    is five times faster; ``tokenizers`` itself takes all that may be a special token or is written in
    characters that the two libraries could classify differently. A test compares the results.
    """
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = special_as_text
    ranks = {token: number for number, token in enumerate(byte_tokens(path)) if token}
    merge = tiktoken.Encoding(
        "stretches", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary

    def encoded(texts: list[str]) -> list[list[int]]:
        exact = [t for t in texts if _NOT_PLAIN.search(t)]
        ids = iter(tokenizer.encode_batch_fast(exact, add_special_tokens=False) if exact else ())
        return [next(ids).ids if _NOT_PLAIN.search(t) else merge(t) for t in texts]

    return WordCache(
        lambda texts: encoded([prefix + t for t in texts]), lambda texts: encoded([" " + t for t in texts])
    )


def piece_tokens(path: str) -> list[bytes]:
    """The bytes of every piece of a model file; control and unknown pieces stand for nothing."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    tokens = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        if model.is_byte(number):
            tokens.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(number) or model.is_unknown(number):
            tokens.append(b"")
        else:
            tokens.append(piece.replace("\u2581", " ").encode())
    return tokens


def piece_level(path: str) -> WordCache:
    """A piece vocabulary that puts a space before every text."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)

    def encoded(texts: list[str]) -> list[list[int]]:
        return model.encode(texts, num_threads=1)

    return WordCache(encoded, encoded)
