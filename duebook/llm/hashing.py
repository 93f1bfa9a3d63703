"""Hashes of words for whole Arrow batches of texts, without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; arrays of eight bytes for each of them stay small.
PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(max(n, PIECE + 4096), base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and where each text begins (NULL: an empty text)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _pieces(raw: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of about PIECE bytes that end where no word is cut."""
    at, n = 0, len(raw)
    while at < n:
        end = min(at + PIECE, n)
        while end < n and not _SPACE[raw[end]]:
            step = min(end + 4096, n)
            gap = np.flatnonzero(_SPACE[raw[end:step]])
            next_text = begins[np.searchsorted(begins, end)] if end <= begins[-1] else n
            end = min(end + int(gap[0]) if len(gap) else step, int(next_text))
            if end == next_text:
                break
        yield at, end
        at = end


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lower-cased) of every text, and how many words each text has."""
    raw, begins = text_buffers(texts)
    hashes, places = [], []
    for at, end in _pieces(raw, begins):
        part = _LOWER[raw[at:end]]
        solid = ~_SPACE[part]
        first = np.zeros(len(part), bool)
        inside = begins[(begins >= at) & (begins < end)] - at
        first[inside] = True
        before = np.empty(len(part), bool)
        before[0], before[1:] = False, solid[:-1]
        start = np.flatnonzero(solid & (~before | first))
        after = np.empty(len(part), bool)
        after[-1], after[:-1] = False, solid[1:]
        following = np.zeros(len(part), bool)
        following[:-1] = first[1:]
        stop = np.flatnonzero(solid & (~after | following)) + 1
        up, down = power_tables(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_RANDOM[part] * up[: len(part)], out=total[1:])
        hashes.append(mix((total[stop] - total[start]) * down[start]))
        places.append(start + at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(begins) - 1, np.int64)
    place = np.concatenate(places)
    counts = np.diff(np.searchsorted(place, begins))
    return np.concatenate(hashes), counts


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of ``words`` consecutive words, text by text.

    A text with fewer words is one shingle as a whole; without words it has none.
    """
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    factors = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    for n, end in zip(counts.tolist(), ends.tolist()):
        own = hashes[end - n : end]
        if n >= words:
            m = n - words + 1
            total = own[:m] * factors[0]
            for j in range(1, words):
                total += mix(own[j : j + m] + factors[j]) * factors[j]
            yield np.unique(mix(total))
        elif n:
            total = np.uint64(n)
            for j in range(n):
                total = mix(total * factors[j] + own[j : j + 1])
            yield total
        else:
            yield own
