"""Vectorised words, shingles and their hashes over Arrow string columns.

Texts are read as UTF-8 bytes.  A word is a maximal run of bytes other than
space and 0x09-0x0D (all of them ASCII, so byte runs are character runs);
A-Z count as a-z.  Everything is numpy on whole buffers: no Python loop per
word.  Batches are cut into slices of about ``SLICE`` text bytes, at document
ends, so that memory does not depend on the Arrow batch size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit numbers with full avalanche."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _MUL)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        m = max(n, SLICE + 1)
        _POWERS[:] = [np.multiply.accumulate(np.full(m, _MUL)), np.multiply.accumulate(np.full(m, _INV))]
    return _POWERS[0], _POWERS[1]


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks)
    binary = pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type)
    col = pc.fill_null(col.cast(pa.large_binary() if binary else pa.large_string()), b"" if binary else "")
    _, off, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and offsets[-1] > offsets[0] \
        else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE):
    """(first, end) document ranges of about ``size`` bytes, at least one document each."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(n, max(at + 1, end))
        yield at, end
        at = end


def words(raw: np.ndarray, offsets: np.ndarray):
    """(document, hash, start, end) of each word of a slice; ``offsets`` are
    relative to ``raw``.  Equal lower-cased words have equal hashes."""
    n = len(raw)
    if n == 0:
        e = np.zeros(0, np.int64)
        return e, np.zeros(0, np.uint64), e, e
    letter = ~_SPACE[raw]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = letter[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = letter[1:]
    after[inner - 1] = False
    start = np.flatnonzero(letter & ~before)
    end = np.flatnonzero(letter & ~after) + 1
    power, inverse = _powers(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[raw] * power[:n], out=total[1:])
    h = mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * _MUL)
    doc = np.searchsorted(offsets, start, "right") - 1
    return doc, h, start, end


def word_hash(word: str) -> int:
    """The hash that ``words`` gives this one word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(words(raw, np.array([0, len(raw)]))[1][0])


def grams(doc: np.ndarray, h: np.ndarray, n: int):
    """(document, hash, first word) of each run of ``n`` words in one document."""
    m = len(h) - n + 1
    if m <= 0:
        e = np.zeros(0, np.int64)
        return e, np.zeros(0, np.uint64), e
    keep = np.flatnonzero(doc[:m] == doc[n - 1:n - 1 + m])
    acc = h[keep]
    for i in range(1, n):
        acc = mix64(acc * _MUL + h[keep + i])
    return doc[keep], acc, keep


def whole(h: np.ndarray) -> int:
    """Hash of a word sequence taken as one shingle."""
    acc = h[:1].copy()
    for i in range(1, len(h)):
        acc = mix64(acc * _MUL + h[i:i + 1])
    return int(mix64(acc + np.uint64(len(h)))[0])
