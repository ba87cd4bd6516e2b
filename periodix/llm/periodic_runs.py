"""Periodic runs of words in whole texts, by block convolution at dyadic scales.

A run is a stretch of words that repeats itself with a period and cannot be made longer. For periods from B to 2B - 1
(B = 1, 2, 4, ...) texts are cut into blocks of B words: a run of at least four periods holds a whole block that occurs
again one period later. With words numbered exactly, a block occurs at a distance where the sum of squared differences is
zero; the sums for all distances of a window come from one convolution, computed by a number-theoretic transform, which is
exact modulo its prime. Distances found are then compared word by word and extended both ways, so the prime never decides.

A block that holds a word without another occurrence in its window cannot occur there and is left out, as is a block whose
window lies inside a run found at a smaller scale: by the theorem of Fine and Wilf it would only give that run again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodix.llm.text import NOT_SPACE, rows_of, runs, slices, word_spans
from periodix.llm.work import map_arrow

#: 15 * 2**27 + 1, a prime with roots of unity for windows of up to 2**27 words; 31 generates its units.
PRIME, GENERATOR = 2013265921, 31
_P = np.uint64(PRIME)
#: Elements transformed at a time.
BATCH = 1 << 19


@cache
def _roots(size: int, inverse: bool) -> np.ndarray:
    """The first ``size`` / 2 powers of a root of unity of order ``size``."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    out = np.ones(max(1, size // 2), np.uint64)
    step = 1
    while step < len(out):
        out[step:2 * step] = out[:step] * np.uint64(pow(root, step, PRIME)) % _P
        step *= 2
    return out


def transform(x: np.ndarray) -> np.ndarray:
    """The number-theoretic transform of each row, in bit-reversed order; the length is a power of two."""
    rows, size = x.shape
    half = size // 2
    while half:
        pair = x.reshape(rows, -1, 2, half)
        low, high = pair[:, :, 0], pair[:, :, 1]
        x = np.stack([(low + high) % _P, (low + _P - high) % _P * _roots(2 * half, False) % _P], axis=2).reshape(rows, size)
        half //= 2
    return x


def restore(x: np.ndarray) -> np.ndarray:
    """The rows that ``transform`` gave these of."""
    rows, size = x.shape
    half = 1
    while half < size:
        pair = x.reshape(rows, -1, 2, half)
        low, high = pair[:, :, 0], pair[:, :, 1] * _roots(2 * half, True) % _P
        x = np.stack([(low + high) % _P, (low + _P - high) % _P], axis=2).reshape(rows, size)
        half *= 2
    return x * np.uint64(pow(size, PRIME - 2, PRIME)) % _P


def occurrences(words: np.ndarray, squares: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) wherever a block of ``size`` words from a start equals the words ``size`` to 2 ``size`` - 1
    further on, modulo the prime. ``squares`` are prefix sums of the words' squares, one entry more than words.

    Windows must lie inside ``words``: start + 3 size <= len(words).
    """
    found_at, found_distance = [], []
    length, step = 4 * size, max(1, BATCH // (4 * size))
    back = -np.arange(size) % length
    for first in range(0, len(blocks), step):
        at = blocks[first:first + step]
        window = np.zeros((len(at), length), np.uint64)
        window[:, :3 * size] = words[at[:, None] + np.arange(3 * size)]
        mirror = np.zeros((len(at), length), np.uint64)
        mirror[:, back] = window[:, :size]
        cross = restore(transform(mirror) * transform(window) % _P)[:, size:2 * size]
        there = at[:, None] + np.arange(size, 2 * size)
        own = squares[at + size] - squares[at]
        other = squares[there + size] - squares[there]
        differences = (own[:, None] + other + 2 * (PRIME - cross.astype(np.int64))) % PRIME
        row, distance = np.nonzero(differences == 0)
        found_at.append(at[row])
        found_distance.append(distance + size)
    return np.concatenate(found_at), np.concatenate(found_distance)


def _forward(words: np.ndarray, at: int, distance: int, end: int) -> int:
    """The first position from ``at`` on whose word differs from the one ``distance`` later, or has none before ``end``."""
    stop, step = end - distance, 64
    while at < stop:
        to = min(stop, at + step)
        differs = words[at:to] != words[at + distance:to + distance]
        if differs.any():
            return at + int(differs.argmax())
        at, step = to, step * 2
    return stop


def _backward(words: np.ndarray, at: int, distance: int, begin: int) -> int:
    """The smallest start from which all words up to ``at`` equal the ones ``distance`` later."""
    step = 64
    while at > begin:
        to = max(begin, at - step)
        differs = (words[to:at] != words[to + distance:at + distance])[::-1]
        if differs.any():
            return at - int(differs.argmax())
        at, step = to, step * 2
    return begin


def find_runs(words: np.ndarray, first_word: np.ndarray, periods: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of every maximal run, sorted by start and period, of several texts at once.

    ``words`` are word numbers, text after text; text t has those from first_word[t] to first_word[t + 1]. A run has at
    least ``periods`` (4 or more) periods and ``least`` words and does not cross texts.
    """
    if periods < 4:
        raise ValueError("a run must have at least four periods to hold a block and its next occurrence at every scale")
    n = len(words)
    if not n:
        return []
    text = rows_of(first_word)
    text_end = first_word[1:][text]
    # how far on the same word occurs again in the same text
    key = text * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    gap = np.full(n, n + 1, np.int64)
    same = key[order[1:]] == key[order[:-1]]
    gap[order[:-1][same]] = np.diff(order)[same]
    numbers = words.astype(np.uint64)
    squares = np.concatenate([[0], np.cumsum((numbers % _P * (numbers % _P) % _P).astype(np.int64))])
    covered = np.zeros(n, np.int64)  # the furthest end of a known run over each word
    known: set[tuple[int, int]] = set()
    out: list[tuple[int, int, int]] = []
    size, longest = 1, int(np.diff(first_word).max())
    while periods * size <= longest:
        at = np.arange(len(gap)) * size
        open_ = (gap < 2 * size) & (at + 3 * size <= text_end[at]) & (covered[at] < at + 3 * size)
        blocks = at[open_]
        if len(blocks):
            at, distance = occurrences(numbers, squares, blocks, size)
            # the block after it repeats as well in any run that is long enough, and comparing words settles both
            fits = at + 2 * size + distance <= text_end[at]
            at, distance = at[fits], distance[fits]
            equal = np.ones(len(at), bool)
            for k in range(0, 2 * size):
                todo = np.flatnonzero(equal)
                if not len(todo):
                    break
                equal[todo] = words[at[todo] + k] == words[at[todo] + k + distance[todo]]
            reached: dict[int, tuple[int, int]] = {}  # the last stretch of each distance
            fresh = []
            for i, s in zip(at[equal].tolist(), distance[equal].tolist()):
                a, b = reached.get(s, (0, 0))
                if a <= i < b:
                    continue
                a = _backward(words, i, s, int(first_word[text[i]]))
                b = _forward(words, i + 2 * size, s, int(text_end[i]))
                reached[s] = a, b
                if b + s - a >= max(least, periods * s) and (a, b + s) not in known:
                    fresh.append((a, b + s, s))
            for a, b, s in fresh:
                known.add((a, b))
                covered[a:b] = np.maximum(covered[a:b], b)
            out += fresh
        if len(gap) % 2:
            gap = np.append(gap, n + 1)
        gap = np.maximum(gap[::2], gap[1::2])
        size *= 2
    return sorted(out, key=lambda r: (r[0], r[2]))


def word_numbers(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words and only for those; words must hold all bytes that are not white space."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    packed = raw[NOT_SPACE[raw]]
    column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def _joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first_word: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Each text's kept words, joined by one space."""
    kept_before = np.concatenate([[0], np.cumsum(keep)])[first_word]
    starts, size = starts[keep], (ends - starts)[keep] + 1
    stops = np.cumsum(size)
    data = np.append(raw, np.uint8(32))[runs(starts, size)]
    data[stops - 1] = 32
    bounds = np.concatenate([[0], stops])[kept_before]
    some = np.diff(kept_before) > 0
    last = bounds[1:][some] - 1  # no space after a text's last word
    data = np.delete(data, last)
    offsets = np.concatenate([[0], np.cumsum(np.diff(bounds) - some)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", periods: int = 4, least: int = 6) -> DataFrame:
    """(doc_id, n_words, runs, top, collapsed), one row per input row, without a shuffle.

    ``runs`` lists every run (start, length, period) by start and period, counted in words from 0; ``top`` is the place in
    that list, from 0, of the run with the greatest length / period (ties: smallest start, then period), null without
    runs. ``collapsed`` is the text without the words that any run holds after its first period, joined by one space.

    Words are separated by ASCII white space. A null text is empty: no words, no runs, an empty collapsed text. Null and
    repeated ids are kept row by row; an empty table gives an empty result; other columns are ignored. Work is done on
    about a megabyte of texts at a time, or on one longer text.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, raw, offsets in slices(batch.column("text")):
                starts, ends, first_word = word_spans(raw, offsets, NOT_SPACE)
                found = find_runs(word_numbers(raw, starts, ends), first_word, periods, least)
                keep = np.ones(len(starts), bool)
                lists: dict[int, list[tuple[int, int, int]]] = {}
                for a, b, p in found:
                    keep[a + p:b] = False
                    t = int(np.searchsorted(first_word, a, "right")) - 1
                    lists.setdefault(t, []).append((a - int(first_word[t]), b - a, p))
                top = [None] * (end - first)
                for t, of_text in lists.items():
                    best = 0
                    for k, (_, length, period) in enumerate(of_text):
                        if length * of_text[best][2] > of_text[best][1] * period:
                            best = k
                    top[t] = best
                rows = [[dict(zip(("start", "length", "period"), r)) for r in lists.get(t, [])] for t in range(end - first)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first), pa.array(np.diff(first_word), pa.int64()), pa.array(rows, pa.list_(_RUN)),
                     pa.array(top, pa.int32()), _joined(raw, starts, ends, first_word, keep).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "top", "collapsed"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(rows, search, f"doc_id {kind}, n_words bigint, runs {RUNS}, top int, collapsed string")
