"""Pattern packing: documents into sequences of a fixed length, planned on the histogram of their lengths.

Patterns of a few length bins that fill a sequence are enumerated; non-negative least squares fits how often each is
repeated so that the histogram is used up; the counts are rounded down and given lengths that fill the sequence exactly,
and what is left is packed best-fit. The plan needs only the histogram, whose size does not grow with the data; each document then finds
its place by its length and its rank among equal lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from periodix.llm.text import runs
from periodix.llm.tokens import PieceEncoder, encoded
from periodix.llm.work import map_arrow, work_folder, written

CAPACITY = 4096
#: Length bins of the patterns, and documents of a pattern at most.
BINS = 48
PATTERN_DOCS = 4
#: Shares of the fitted repeats that plans are made with.
SHARES = (1.0, 0.5, 0.25, 0.1, 0.05, 0.0)


def patterns(bins: int = BINS, docs: int = PATTERN_DOCS) -> np.ndarray:
    """How many documents of each bin every pattern of at most ``docs`` documents has; bin sizes sum to ``bins``.

    Bin b holds documents of about b parts of the capacity (b = 1 to ``bins``); which lengths fit is settled later.
    """
    found: list[list[int]] = []

    def extend(parts: list[int], left: int, largest: int) -> None:
        if left == 0:
            found.append(parts)
        elif len(parts) < docs:
            for b in range(min(left, largest), 0, -1):
                if b * (docs - len(parts)) < left:
                    break  # too small to fill what is left
                extend([*parts, b], left - b, b)

    extend([], bins, bins)
    out = np.zeros((len(found), bins + 1))
    for i, parts in enumerate(found):
        np.add.at(out[i], parts, 1)
    return out[:, 1:]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative x that make a @ x close to b: accelerated projected gradient, which keeps x at or above 0."""
    x = look = np.zeros(a.shape[1])
    v = np.ones(a.shape[1])
    for _ in range(12):
        v = a.T @ (a @ v)
        size = np.linalg.norm(v)
        v /= size
    step, t = 1 / size, 1.0
    for _ in range(rounds):
        was = x
        x = np.maximum(look - step * (a.T @ (a @ look - b)), 0)
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look = x + (old - 1) / t * (x - was)
    return x


@dataclass
class Plan:
    """Segments of equal lengths: the documents of ``length`` with ranks [first, first + count) go to sequences
    base, base + 1, ..., each at ``offset``. Sorted by length and first rank."""

    length: np.ndarray
    first: np.ndarray
    count: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each (length, rank)."""
        most = int(self.first.max(initial=0)) + int(rank.max(initial=0)) + 1
        at = np.searchsorted(self.length * most + self.first, length * most + rank, "right") - 1
        return self.base[at] + rank - self.first[at], self.offset[at]


def _planned(counts: dict[int, int], capacity: int, share: float) -> Plan:
    """Places for all: that share of the patterns' repeats, and the rest best-fit."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    used = np.zeros(capacity + 1, np.int64)  # ranks given out, by length
    segments: list[tuple[int, int, int, int, int]] = []
    groups: dict[int, list[tuple[int, int, int]]] = {}  # open sequences by room left: (first sequence, count, fill)
    sequences = 0

    def take(length: int, count: int, base: int, offset: int) -> None:
        segments.append((length, int(used[length]), count, base, offset))
        used[length] += count
        left[length] -= count

    full = int(left[capacity])
    if full:
        take(capacity, full, 0, 0)
        sequences = full
    part = capacity / BINS
    bin_of = np.rint(np.arange(capacity + 1) / part).astype(int).clip(1, BINS)
    histogram = np.bincount(bin_of, left, BINS + 1)[1:].astype(float)
    if share and histogram.sum():
        table = patterns()
        # larger documents are harder to place later, so a miss in their bins weighs more
        weight = np.arange(1, BINS + 1) / BINS
        repeats = nnls((table * weight).T / histogram.max(), histogram * weight / histogram.max())
        repeats = np.floor(repeats * share + 1e-6).astype(np.int64)
        members = [[length for length in range(capacity, 0, -1) if bin_of[length] == b + 1] for b in range(BINS)]
        for i in np.argsort(-repeats, kind="stable"):
            *larger, _ = np.repeat(np.arange(BINS), table[i].astype(int))[::-1].tolist()
            todo = int(repeats[i])
            while todo > 0:
                lengths: list[int] = []
                taken: dict[int, int] = {}
                room = capacity
                for b in larger:  # the longest of the bin that are left and fit
                    length = next((x for x in members[b] if x <= room and left[x] > taken.get(x, 0)), 0)
                    if not length:
                        break
                    lengths.append(length)
                    taken[length] = taken.get(length, 0) + 1
                    room -= length
                if len(lengths) < len(larger):
                    break
                if not room or left[room] <= taken.get(room, 0):  # the last one must fill the sequence
                    break  # what a pattern leaves empty is not worth a sequence; the rest is packed best-fit
                lengths.append(room)
                taken[room] = taken.get(room, 0) + 1
                times = min(todo, *(int(left[x]) // n for x, n in taken.items()))
                offset = 0
                for length in lengths:
                    take(length, times, sequences, offset)
                    offset += length
                sequences += times
                todo -= times
    # the rest, longest first, each into the fullest sequence that still has room
    rooms = np.zeros(capacity + 1, bool)
    for length in range(capacity, 0, -1):
        while left[length]:
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                room = length + int(fits[0])
                first, many, fill = groups[room].pop()
                if not groups[room]:
                    rooms[room] = False
                times = min(many, int(left[length]))
                if times < many:
                    groups.setdefault(room, []).append((first + times, many - times, fill))
                    rooms[room] = True
                take(length, times, first, fill)
                room, fill, first = room - length, fill + length, first
            else:
                per = max(1, min(capacity // length, int(left[length])))
                times = max(1, int(left[length]) // per)
                first, fill = sequences, 0
                for _ in range(per):
                    take(length, times, first, fill)
                    fill += length
                sequences += times
                room = capacity - fill
            if room:
                groups.setdefault(room, []).append((first, times, fill))
                rooms[room] = True
    table = np.array(sorted(segments), dtype=np.int64).reshape(-1, 5)
    return Plan(*table.T, sequences)


def plan_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Places for ``counts`` documents of each length, 1 to ``capacity``.

    The work depends on the number of different lengths, not on how many documents have them. Plans by all and by smaller
    shares of the fitted patterns, and by best-fit decreasing alone, are compared: the one with fewest sequences is taken,
    of equal ones that with the largest share.
    """
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    best: Plan | None = None
    for share in SHARES:
        plan = _planned(counts, capacity, share)
        if best is None or plan.sequences < best.sequences:
            best = plan
        if best.sequences == least:
            break
    return best


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's ids and ``end_id``, cut where longer than ``capacity``.

    Rows (doc_id, piece, start, length, ids, ids_crc32, part, row): ``row`` numbers the pieces of a task and ``part`` is the
    task. Write the rows before using these two: a task run again may number its rows anew.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, part, encoder = 0, TaskContext.get().partitionId(), PieceEncoder(tokenizer)
        for batch in batches:
            for first, _, ids, count in encoded(batch.column("text"), encoder, end_id):
                many = -(-count // capacity)
                doc = np.repeat(np.arange(len(count)), many)
                piece = runs(np.zeros(len(many), np.int64), many)
                start = piece * capacity
                length = np.minimum(count[doc] - start, capacity)
                ends = np.cumsum(length)
                crc = [zlib.crc32(ids[b - n:b].astype("<u4").tobytes()) for b, n in zip(ends, length)]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").take(pa.array(doc + first)), "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids": lists,
                    "ids_crc32": pa.array(crc, pa.int64()), "part": pa.array(np.full(len(doc), part), pa.int32()),
                    "row": pa.array(np.arange(seen, seen + len(doc)), pa.int64())})
                seen += len(doc)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(rows, cut, f"doc_id {kind}, piece int, start long, length long, ids array<int>, ids_crc32 long, part int, row long")


def ranked(rows: DataFrame, folder: str) -> DataFrame:
    """``rows``, without ids, with ``rank``: a number for each piece among those of its length, from 0.

    Pieces are dealt by ranges of (length, part, row) and numbered where they land. A length that goes on in several tasks
    begins in each where the ones before end; there are at most as many such offsets as lengths and tasks.
    """
    placed = rows.select("doc_id", "piece", "start", "length", "ids_crc32", "part", "row")
    placed = placed.repartitionByRange("length", "part", "row").sortWithinPartitions("length", "part", "row")
    at = F.monotonically_increasing_id()
    placed = written(placed.select("*", F.shiftright(at, 33).alias("task"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("index")), folder, "ranked")
    here = placed.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"), F.min("index").alias("first"))
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    shift = here.select("length", "task", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(shift, ["length", "task"]).withColumn("rank", F.col("index") + F.col("shift")).drop("task", "index", "shift")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = True) -> DataFrame:
    """Packed pieces: (doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset), one row per piece.

    A document's ids are those of its whole text and ``end_id``; only longer ones than ``capacity`` are cut. Sequences
    are filled without gaps from offset 0. Ids are written to the shared folder once; places are found from the lengths
    alone and joined to the ids, which shuffles them, unless ``with_ids`` is false. No length is gathered in one task. The
    plan, bounded by the number of lengths, is broadcast.

    A null text is empty and has only the end id. Rows repeated with one id are documents of their own. An empty table
    gives an empty result; other columns are ignored.
    """
    folder = work_folder(docs.sparkSession)
    rows = written(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), folder, "pieces")
    counts = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    shared = docs.sparkSession.sparkContext.broadcast(plan_histogram({r["length"]: r["n"] for r in counts}, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = shared.value.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = ranked(rows, folder).withColumn("place", place("length", "rank"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset"]
    if not with_ids:
        return placed.select(*columns)
    placed = written(placed.select("part", "row", "place"), folder, "places")
    return rows.join(placed, ["part", "row"]).select(*columns[:4], "ids", *columns[4:])
