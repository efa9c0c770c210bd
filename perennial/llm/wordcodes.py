"""Whole texts as arrays of 64-bit word codes, computed on their UTF-8 bytes.

Runs inside tasks on Arrow batches. A code is a hash of the word's bytes, so tables of
codes from different tasks agree without a shared dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

_SPAN = 1 << 16  # bytes hashed at a time, small enough for the cache
_RADIX = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(radix: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    out[1:] = np.uint64(radix)
    return np.multiply.accumulate(out)


_POW = _powers(_RADIX, _SPAN)
_INV = _powers(pow(_RADIX, -1, 1 << 64), _SPAN)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_constants(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the offsets between them; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _valid, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; texts never run into each other."""
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    # 0x09 to 0x0D and 0x20; what is below 0x09 wraps around.
    word = ~((data == 0x20) | ((data - np.uint8(0x09)) < 5))
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[0], edge[-1] = word[0], word[-1]
    np.not_equal(word[1:], word[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    starts, ends = at[::2].copy(), at[1::2].copy()
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    cut = np.unique(inner[word[inner - 1] & word[inner]])
    if len(cut):
        starts, ends = (np.insert(x, np.searchsorted(x, cut), cut) for x in (starts, ends))
    return starts, ends


def span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A code for each span of bytes: a polynomial from prefix sums, then mixed."""
    codes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = int(np.searchsorted(ends, base + _SPAN - 1, side="right"))
        if to <= at:  # one span is longer than the tables
            codes[at] = np.uint64(xxhash.xxh64_intdigest(data[base : ends[at]].tobytes()))
            at += 1
            continue
        part = data[base : ends[to - 1]].astype(np.uint64)
        part += np.uint64(1)
        part *= _POW[: len(part)]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part, out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        codes[at:to] = (sums[e] - sums[s]) * _INV[s] + (e - s).astype(np.uint64)
        at = to
    return mix(codes)


@dataclass
class Words:
    codes: np.ndarray  # one per word, text after text
    first: np.ndarray  # where each text's words begin, and the total at the end

    def of(self, text: int) -> np.ndarray:
        return self.codes[self.first[text] : self.first[text + 1]]

    def __len__(self) -> int:
        return len(self.first) - 1


def word_codes(texts: pa.Array, lower: bool = True) -> Words:
    data, offsets = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    starts, ends = word_spans(data, offsets)
    return Words(span_codes(data, starts, ends), np.searchsorted(starts, offsets, side="left"))


def sequence_codes(codes: np.ndarray, n: int, salt: int) -> np.ndarray:
    """A code for every run of ``n`` codes; fewer than ``n`` give one run of them all."""
    if not len(codes):
        return codes
    n = min(n, len(codes))
    total = np.zeros(len(codes) - n + 1, dtype=np.uint64)
    for k, factor in enumerate(odd_constants(n, salt + n)):
        total += codes[k : len(codes) - n + 1 + k] * factor
    return mix(total)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``limit`` bytes of text, or one row."""
    _data, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
