"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting: shallow trees, one feature at a time in turn, add small steps to that feature's lookup table
over its bins; then the feature pairs that explain most of what is left get two-dimensional tables the same way.
A text's score is the sum of the looked-up values, so each feature's part can be read off.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodix.llm.sample import labelled
from periodix.llm.text import NOT_SPACE, byte_class, lower_ascii, mix, rows_of, segment_sum, slices, word_hashes, word_spans
from periodix.llm.work import map_arrow

FEATURES = ["log_bytes", "log_words", "upper", "digits", "punctuation", "symbols", "pipes", "non_ascii", "word_length",
            "longest_word", "words_per_line", "log_lines", "distinct_words", "repeated_words", "top_word",
            "repeated_lines", "bare_lines", "shouted"]

#: Labelled documents that are fitted at most, in hash order of their ids.
FIT_ROWS = 20000
BINS = 32
PAIR_BINS = 8

_UPPER, _DIGIT = byte_class((65, 90)), byte_class((48, 57))
_PUNCTUATION = byte_class((33, 47), (58, 64), (91, 96), (123, 126))
_SYMBOL = _PUNCTUATION & ~byte_class((33, 34), (39, 41), (44, 46), (58, 59), (63, 63))
_NON_ASCII, _PIPE, _BANG = byte_class((128, 255)), byte_class((124, 124)), byte_class((33, 33))
_LINE = ~byte_class((10, 10))


def _top_share(row: np.ndarray, h: np.ndarray, n: int, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's elements: the share of distinct ones, and of the most frequent one."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.concatenate([np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(h)]]))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, row[first], count)
    safe = np.maximum(total, 1)
    return np.bincount(row[first], minlength=n) / safe, top / safe


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, a column for each of FEATURES) for slices of whole texts; empty texts give zeros."""
    for first, end, raw, offsets in slices(texts):
        n = end - first
        size = np.diff(offsets)
        at_least = np.maximum(size, 1)
        share = lambda table: segment_sum(table[raw].astype(np.int64), offsets) / at_least
        starts, ends, first_word = word_spans(raw, offsets, NOT_SPACE)
        words = np.diff(first_word)
        some = np.maximum(words, 1)
        h = word_hashes(lower_ascii(raw), starts, ends)
        row = rows_of(first_word)
        distinct, top = _top_share(row, h, n, words)
        longest = np.zeros(n, np.int64)
        np.maximum.at(longest, row, ends - starts)
        l_starts, l_ends, first_line = word_spans(raw, offsets, _LINE)
        lines = np.diff(first_line)
        in_line = np.searchsorted(starts, np.stack([l_starts, l_ends]))  # words of each line
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h))])
        line_hash = total[in_line[1]] - total[in_line[0]]
        distinct_lines, _ = _top_share(rows_of(first_line), line_hash, n, lines)
        ended = np.isin(raw[np.maximum(l_ends - 1, 0)], np.frombuffer(b".!?:;\"')", np.uint8)) if len(raw) else np.zeros(0, bool)
        bare = segment_sum((~ended).astype(np.int64), first_line) / np.maximum(lines, 1)
        last = raw[np.maximum(ends - 1, 0)] if len(raw) else raw
        shouted = segment_sum(_BANG[last].astype(np.int64), first_word) / some
        yield first, end, np.stack([
            np.log1p(size), np.log1p(words), share(_UPPER), share(_DIGIT), share(_PUNCTUATION), share(_SYMBOL), share(_PIPE),
            share(_NON_ASCII), segment_sum(ends - starts, first_word) / some, longest.astype(float), words / np.maximum(lines, 1),
            np.log1p(lines), distinct, (1 - distinct) * np.log1p(words), top, np.where(lines > 0, 1 - distinct_lines, 0.0), bare,
            shouted], axis=1)


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables by feature, and by pair of features."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    bias: float = 0.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edges, x[:, j], "right")]
        coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], "right") for pair in self.pairs for j in pair}
        for (i, j), table in self.pairs.items():
            out += table[coarse[i], coarse[j]]
        return out


def bin_edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between distinct values, near equal shares of them."""
    values = np.unique(x)
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="midpoint"))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return -g / (h + 1.0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """A step over ordered bins: a few cuts chosen one by one for the gain, one value for each piece."""
    cuts = [0, len(g)]
    total_g, total_h = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                at = np.arange(a + 1, b)
                left = _gain(total_g[at] - total_g[a], total_h[at] - total_h[a])
                right = _gain(total_g[b] - total_g[at], total_h[b] - total_h[at])
                gain = left + right - _gain(total_g[b] - total_g[a], total_h[b] - total_h[a])
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], int(at[k]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.empty(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = _leaf(total_g[b] - total_g[a], total_h[b] - total_h[a])
    return out


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four quadrants: its gain, and each cell's value."""
    tg, th = (np.pad(t.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for t in (g, h))

    def parts(t: np.ndarray) -> list[np.ndarray]:
        a, top, left, whole = t[1:-1, 1:-1], t[1:-1, -1:], t[-1:, 1:-1], t[-1, -1]
        return [a, top - a, left - a, whole - top - left + a]

    pg, ph = parts(tg), parts(th)
    if not pg[0].size:
        return 0.0, np.zeros_like(g)
    gain = sum(_gain(a, b) for a, b in zip(pg, ph)) - _gain(tg[-1, -1], th[-1, -1])
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    leaf = [_leaf(a[i, j], b[i, j]) for a, b in zip(pg, ph)]
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = leaf
    return float(gain[i, j]), out


def fit(x: np.ndarray, labels: np.ndarray, rounds: int = 120, rate: float = 0.1, n_pairs: int = 6, pair_rounds: int = 40) -> AdditiveModel:
    """The model of ``labels`` (0 or 1) on the columns of ``x``; without both labels a constant."""
    y = np.asarray(labels, dtype=float)
    n, m = x.shape
    p = (y.sum() + 0.5) / (n + 1)
    model = AdditiveModel([bin_edges(x[:, j], BINS) if n else np.zeros(0) for j in range(m)], [], [bin_edges(x[:, j], PAIR_BINS) if n else np.zeros(0) for j in range(m)])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.bias = float(np.log(p / (1 - p)))
    if not n or y.min() == y.max():
        return model
    where = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    margin = np.full(n, model.bias)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-margin))
        return q - y, q * (1 - q)

    for _ in range(rounds):
        for j in range(m):
            g, h = slope()
            size = len(model.tables[j])
            step = rate * shallow_tree(np.bincount(where[j], g, size), np.bincount(where[j], h, size))
            model.tables[j] += step
            margin += step[where[j]]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]
    cells = {(i, j): coarse[i] * (len(model.pair_edges[j]) + 1) + coarse[j] for i, j in combinations(range(m), 2)}
    shape = {(i, j): (len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1) for i, j in cells}

    def grid(pair: tuple[int, int]) -> tuple[float, np.ndarray]:
        g, h = slope()
        a, b = shape[pair]
        return quadrants(np.bincount(cells[pair], g, a * b).reshape(a, b), np.bincount(cells[pair], h, a * b).reshape(a, b))

    chosen = sorted(cells, key=lambda pair: (-grid(pair)[0], pair))[:n_pairs]
    model.pairs = {pair: np.zeros(shape[pair]) for pair in chosen}
    for _ in range(pair_rounds):
        for pair in chosen:
            step = rate * grid(pair)[1]
            model.pairs[pair] += step
            margin += step.ravel()[cells[pair]]
    return model


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, x in features(batch.column("text")):
            flat = pa.array(x.ravel())
            lists = pa.FixedSizeListArray.from_arrays(flat, x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(first, end - first), lists], ["label", "x"])


def train(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", fit_rows: int = FIT_ROWS, **options) -> AdditiveModel:
    """A model fitted on at most ``fit_rows`` labelled documents that are not held out (an expression over doc_id).

    Spark computes the features; the driver fits those of the bounded sample. Null labels are ignored.
    """
    rows = labelled(docs, labels, id_col, text_col, label_col, held_out, fit_rows).select("label", "text")
    sample = map_arrow(rows, _features_of, "label int, x array<double>").toArrow()
    x = sample.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    y = sample.column("label").to_numpy()
    order = np.lexsort((*x.T, y))  # a fixed order, whatever order the rows came in
    return fit(x[order], y[order], **options)


def score(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row: the probability of label 1, and whether it is 0.5 or more.

    The whole text counts; a null text scores like an empty one. Repeated rows score alike, an empty table gives an
    empty result, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, x in features(batch.column("text")):
                p = 1 / (1 + np.exp(-shared.value.margins(x)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, end - first), pa.array(p)], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = map_arrow(rows, scored, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
