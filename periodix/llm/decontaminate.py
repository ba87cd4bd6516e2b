"""Benchmark decontamination by winnowing: join minimum k-gram hashes of test items and documents, extend hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from periodix.llm.text import ALNUM, lower_ascii, mix, ngram_hashes, rows_of, runs, slices, word_hashes, word_spans
from periodix.llm.work import map_arrow, work_folder, written

#: A shared span of this many words is contamination; shorter items count as a whole.
WINDOW = 13
#: Words per k-gram. Of any WINDOW - GRAM + 1 consecutive k-grams, each text keeps the smallest hash.
GRAM = 5
#: Benchmark words (8 bytes each, and as much for their index) that one pass over the documents carries to executors.
BLOCK_WORDS = 1 << 21


def hashed_words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, first word of each text) for slices of texts."""
    for first, end, raw, offsets in slices(texts):
        raw = lower_ascii(raw)
        starts, ends, first_word = word_spans(raw, offsets, ALNUM)
        yield first, end, word_hashes(raw, starts, ends), first_word


def winnow(words: np.ndarray, first_word: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept k-grams: the smallest of each window's, the last of equal ones.

    Two texts that share ``window`` consecutive words keep the same k-gram of them, whatever surrounds them.
    """
    h, whole = ngram_hashes(words, first_word, gram)
    wide = window - gram + 1
    n = len(words)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, where = h[:n - window + 1].copy(), np.arange(n - window + 1)
    for j in range(1, wide):
        other = h[j:n - window + 1 + j]
        lower = other <= best
        best[lower] = other[lower]
        where[lower] = np.flatnonzero(lower) + j
    ends = np.repeat(first_word[1:], np.diff(first_word))
    inside = np.arange(n - window + 1) + window <= ends[:n - window + 1]
    at = np.unique(where[inside])
    return at, h[at]


class BenchmarkBlock:
    """Index of some benchmark items: their words, and winnowed or whole-item hashes sorted for lookup."""

    def __init__(self, item_ids: list, words: list[np.ndarray], window: int, gram: int):
        self.window, self.gram = window, gram
        self.item_ids = item_ids
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(lengths)])
        self.words = np.concatenate([*words, np.zeros(0, np.uint64)])
        self.item_of = rows_of(self.first)
        at, h = winnow(self.words, self.first, window, gram)
        order = np.argsort(h, kind="stable")
        self.keys, self.at = h[order], at[order]
        #: Items shorter than a window, by length: sorted hashes of whole items, and the items' numbers.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in sorted({int(x) for x in lengths if 0 < x < window}):
            items = np.flatnonzero(lengths == size)
            h = ngram_hashes(self.words, self.first, size)[0][self.first[items]]
            order = np.argsort(h, kind="stable")
            self.short[size] = h[order], items[order]

    def hits(self, words: np.ndarray, first_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, item number) of spans of document words that lie in an occurrence of a window."""
        spans = [self._windows(words, first_word)]
        for size, (keys, items) in self.short.items():
            h, whole = ngram_hashes(words, first_word, size)
            left, right = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
            at = np.flatnonzero((right > left) & whole)
            n = (right - left)[at]
            spans.append((np.repeat(at, n), np.repeat(at + size, n), items[runs(left[at], n)]))
        return tuple(np.concatenate(x) for x in zip(*spans))

    def _windows(self, words: np.ndarray, first_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints looked up, then extended word by word to both sides; shorter matches are dropped."""
        at, h = winnow(words, first_word, self.window, self.gram)
        left, right = np.searchsorted(self.keys, h, "left"), np.searchsorted(self.keys, h, "right")
        hit = right > left
        n = (right - left)[hit]
        p, q = np.repeat(at[hit], n), self.at[runs(left[hit], n)]
        item = self.item_of[q]
        text = np.searchsorted(first_word, p, "right") - 1
        back = self._extend(words, p, q, -1, first_word[text], self.first[item])
        ahead = self._extend(words, p, q, 1, first_word[text + 1], self.first[item + 1])
        long = back + ahead + 1 >= self.window
        return (p - back)[long], (p + ahead + 1)[long], item[long]

    def _extend(self, words, p, q, step, p_end, q_end) -> np.ndarray:
        """How many words beyond p and q agree, going by ``step``, at most a window's worth."""
        count = np.zeros(len(p), np.int64)
        live = np.arange(len(p))
        for j in range(1, self.window):
            a, b = p[live] + step * j, q[live] + step * j
            ok = (a >= p_end[live]) & (b >= q_end[live]) if step < 0 else (a < p_end[live]) & (b < q_end[live])
            live, a, b = live[ok], a[ok], b[ok]
            live = live[words[a] == self.words[b]]
            count[live] += 1
            if not len(live):
                break
        return count


def merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans sorted by row and start, with those that overlap or touch within a row joined."""
    order = np.lexsort((end, start, row))
    row, start, end = row[order], start[order], end[order]
    if not len(row):
        return row, start, end
    reach = np.maximum.accumulate(end)  # positions rise with the row, so earlier rows end before this one starts
    new = np.concatenate([[True], (start[1:] > reach[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    return row[first], start[first], np.maximum.reduceat(end, first)


def _lists(values: pa.Array, row: np.ndarray, n: int) -> pa.ListArray:
    """One list for each of n rows, from values sorted by row."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32)), values)


def _scan(block: Broadcast, text_col: str, add: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = block.value
        ids = pa.array([str(x) for x in bench.item_ids], pa.string())
        for batch in batches:
            for first, end, words, first_word in hashed_words(pc.struct_field(batch.column("row"), text_col)):
                n, part = end - first, batch.slice(first, end - first)
                start, stop, item = bench.hits(words, first_word)
                row = np.searchsorted(first_word, start, "right") - 1
                pair = np.unique(np.stack([row, item], axis=1), axis=0) if len(row) else np.zeros((0, 2), np.int64)
                items = _lists(ids.take(pa.array(pair[:, 1])), pair[:, 0], n)
                row, start, stop = merged(row, start, stop)
                start, stop = start - first_word[row], stop - first_word[row]
                if add:  # what earlier blocks found comes along
                    old = part.column("spans")
                    flat, size = old.flatten(), np.diff(np.asarray(old.offsets))
                    row = np.concatenate([row, np.repeat(np.arange(n), size)])
                    # of two texts' spans the later text's must be larger, as merged() expects
                    base = first_word[row] if len(row) else row
                    start = np.concatenate([start, flat.field("start").to_numpy()]) + base
                    stop = np.concatenate([stop, flat.field("end").to_numpy()]) + base
                    row, start, stop = merged(row, start, stop)
                    start, stop = start - first_word[row], stop - first_word[row]
                    items = pa.array([a + b for a, b in zip(part.column("items").to_pylist(), items.to_pylist())], pa.list_(pa.string()))
                spans = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(stop, pa.int64())], ["start", "end"])
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(np.diff(first_word), pa.int64()), _lists(spans, row, n), items],
                                                 ["row", "n_words", "spans", "items"])
    return scan


def _benchmark_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, words, first_word in hashed_words(batch.column("text")):
            lists = pa.ListArray.from_arrays(pa.array(first_word.astype(np.int32)), pa.array(words.view(np.int64)))
            yield pa.RecordBatch.from_pydict({"item_id": batch.column("item_id").slice(first, end - first), "words": lists})


def blocks_of(benchmark: DataFrame, folder: str, block_words: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """The benchmark's items with words, hashed, in blocks of about ``block_words`` words."""
    items = map_arrow(benchmark.where("item_id is not null").select("item_id", "text"), _benchmark_words, f"item_id {benchmark.schema['item_id'].dataType.simpleString()}, words array<long>")
    items = written(items.where("size(words) > 0"), folder, "benchmark")
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    count = -(-total // block_words) if total else 0
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("words", F.lit(7)), F.lit(count)) == k).toArrow()
        lists = rows.column("words").combine_chunks()
        flat, offsets = lists.flatten().to_numpy().view(np.uint64), np.asarray(lists.offsets)
        yield rows.column("item_id").to_pylist(), [flat[a - offsets[0]:b - offsets[0]] for a, b in zip(offsets, offsets[1:])]


def _contamination(docs: DataFrame, benchmark: DataFrame, text_col: str, window: int, gram: int, block_words: int) -> DataFrame:
    """(row, n_words, spans, items) for every row of ``docs``, whose columns are the fields of ``row``."""
    folder = work_folder(docs.sparkSession)
    done = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = StructType([*done.schema.fields, *_found_fields()])
    sc = docs.sparkSession.sparkContext
    passes = 0
    for ids, words in blocks_of(benchmark, folder, block_words):
        if passes:
            done = written(done, folder, f"pass-{passes}")
        done = map_arrow(done, _scan(sc.broadcast(BenchmarkBlock(ids, words, window, gram)), text_col, passes > 0), schema)
        passes += 1
    if not passes:
        done = map_arrow(done, _scan(sc.broadcast(BenchmarkBlock([], [], window, gram)), text_col, False), schema)
    return done.withColumn("items", F.array_sort(F.array_distinct("items")))


def _found_fields() -> list[StructField]:
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    return [StructField("n_words", LongType()), StructField("spans", ArrayType(span)), StructField("items", ArrayType(StringType()))]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, gram: int = GRAM, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Where documents repeat benchmark items: (doc_id, n_words, spans, items), one row per input row.

    ``spans`` holds the merged [start, end) word positions inside any occurrence of ``window`` consecutive words
    of an item, or of a whole item that has fewer; ``items`` the ids (as strings) of the items that occur.
    Documents are never shuffled. The benchmark is read in blocks of about ``block_words`` words; a block's index
    is broadcast, and each further block makes one more pass over the documents, through a written table.

    Null or empty texts have no words and no spans; items without words never occur, and neither do items with a null
    id. Repeated rows give repeated results, and items with equal texts all occur. Empty tables give no rows or no
    spans. Other columns are ignored. A single item longer than a block makes a block of its own.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    found = _contamination(rows, benchmark, "body", window, gram, block_words)
    return found.select("row.doc_id", "n_words", "spans", "items")


def judged(found: DataFrame) -> DataFrame:
    """``contamination`` rows with n_hit (words hit) and contaminated: hit, and at least 5 % of the words are."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    found = found.withColumn("n_hit", n_hit)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, gram: int = GRAM, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without contaminated rows; all columns stay as they are, without a shuffle.

    Each row is judged by its own text: of rows that share an id only the contaminated ones go, null ids included. Null
    and empty texts stay; an empty table or benchmark drops nothing.
    """
    found = judged(_contamination(docs, benchmark, text_col, window, gram, block_words))
    return found.where(~F.col("contaminated")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
