"""Vectorised text work on Arrow batches: bytes of whole texts in, word and n-gram hashes out.

Texts are handled as their UTF-8 bytes, a few megabytes at a time, so memory does not grow with a
batch; one longer text forms a slice of its own. A null text is the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry table, true for the bytes in the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Words as runs of anything but ASCII white space.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words as runs of lower-case ASCII letters, digits and non-ASCII characters.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive runs of texts of at most ``limit`` bytes, or one text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, raw[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return _LOWER[raw]


def word_spans(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each text (one entry more than texts)."""
    inside = table[raw]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(raw):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(raw))]
        before[edges] = False
        after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes a step."""
    length = ends - starts
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lanes = np.arange(8)
    h = mix(length.astype(np.uint64) + np.uint64(1))
    todo, at = np.arange(len(starts)), starts
    while len(todo):
        left = ends[todo] - at
        block = padded[at[:, None] + lanes]
        block[lanes >= left[:, None]] = 0
        h[todo] = mix((h[todo] ^ block.view(np.uint64)[:, 0]) * np.uint64(0x2545F4914F6CDD1D))
        more = left > 8
        todo, at = todo[more], at[more] + 8
    return h


def ngram_hashes(words: np.ndarray, first_word: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each position on, and which positions have k words left in their text."""
    n = len(words)
    h = words.copy()
    for j in range(1, k):
        h[:max(0, n - j)] = mix(h[:max(0, n - j)] * np.uint64(0x9E3779B97F4A7C15) + words[j:])
    ends = np.repeat(first_word[1:], np.diff(first_word))
    return h, np.arange(n) + k <= ends


def rows_of(first: np.ndarray) -> np.ndarray:
    """The text number of each element, from the texts' first elements."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def segment_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments; empty segments give 0."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[first[1:]] - total[first[:-1]]


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each (start, length), one after the other."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])
