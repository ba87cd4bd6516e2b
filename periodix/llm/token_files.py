"""Token-id files with shuffled bit planes.

Ids are cut into blocks of a fixed size. A block's 32-bit integers are transposed into bit planes (or byte planes), so
that bits of one weight lie together, and each plane is compressed with zstandard. A chunk is a row of the written
table: whole documents with their blocks one after the other, and the index that finds every document, block and plane
in it. Spark's writer commits chunks task by task, so a lost executor leaves no partial file behind, and the files may
lie in any store that Spark reads.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodix.llm.tokens import PieceEncoder, encoded
from periodix.llm.work import map_arrow

#: Ids per block; the last of a chunk may be shorter.
BLOCK_IDS = 1 << 16
#: A chunk is closed at the first document end at or after so many ids.
CHUNK_IDS = 1 << 18
LEVEL = 3

CHUNK_SCHEMA = ("shard int, chunk int, first_id long, shard_start long, n_ids long, unit string, block_ids int, doc_ids array<long>, "
                "doc_lengths array<long>, plane_sizes array<int>, planes binary")


def split_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """The planes of a block, lowest first: 32 of bits (padded to whole bytes) or 4 of bytes."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if unit == "byte":
        return [raw[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [row.tobytes() for row in np.packbits(bits.T, axis=1, bitorder="little")]


def join_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    """The block of n ids that ``split_planes`` gave these planes of."""
    if unit == "byte":
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).reshape(-1).view("<u4")
    packed = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    bits = np.unpackbits(packed, axis=1, bitorder="little")[:, :n]
    return np.packbits(bits.T, axis=1, bitorder="little").reshape(-1).view("<u4")


def pack_chunk(ids: np.ndarray, unit: str, block_ids: int) -> tuple[list[int], bytes]:
    """(compressed size of every plane of every block, all planes one after the other)."""
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    parts = [compress(plane) for at in range(0, len(ids), block_ids) for plane in split_planes(ids[at:at + block_ids], unit)]
    return [len(p) for p in parts], b"".join(parts)


def unpack_chunk(planes: bytes, sizes: np.ndarray, n_ids: int, unit: str, block_ids: int) -> np.ndarray:
    """The ids of a chunk, block by block."""
    expand = zstandard.ZstdDecompressor().decompress
    per = 4 if unit == "byte" else 32
    ends = np.concatenate([[0], np.cumsum(sizes)])
    blocks = []
    for b, at in enumerate(range(0, n_ids, block_ids)):
        parts = [expand(planes[ends[k]:ends[k + 1]]) for k in range(b * per, (b + 1) * per)]
        blocks.append(join_planes(parts, min(block_ids, n_ids - at), unit))
    return np.concatenate(blocks) if blocks else np.zeros(0, np.uint32)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, unit: str = "byte", id_col: str = "doc_id", text_col: str = "text",
                      block_ids: int = BLOCK_IDS, chunk_ids: int = CHUNK_IDS) -> None:
    """Writes the ids of every whole text, each closed by ``end_id``, in ascending order of the integer id.

    Texts are range-partitioned by id, sorted and encoded where they land; each partition is a shard, numbered in the
    order of its ids, and a stream of chunks. A null text is empty and has only the end id; a null id comes first.
    Rows repeated with one id follow each other, in the order of their texts. An empty table writes no chunks; other
    columns are ignored. A chunk holds at least one whole document, however long.
    """
    if unit not in ("bit", "byte"):
        raise ValueError("unit must be 'bit' or 'byte'")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, start = TaskContext.get().partitionId(), 0, 0
        encoder = PieceEncoder(tokenizer)
        doc_ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(held)
            sizes, planes = pack_chunk(ids, unit, block_ids)
            values = [shard, number, next((d for d in doc_ids if d is not None), None), start, len(ids), unit, block_ids, list(doc_ids), np.concatenate(lengths), sizes, planes]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, ARROW)], schema=ARROW)

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, end, ids, count in encoded(batch.column("text"), encoder, end_id):
                before = np.concatenate([[0], np.cumsum(count)])
                at = 0
                while at < len(count):
                    # up to the document that brings the chunk to its size
                    stop = min(len(count), int(np.searchsorted(before, before[at] + chunk_ids - size, "left")))
                    stop = max(stop, at + 1)
                    held.append(ids[before[at]:before[stop]])
                    lengths.append(count[at:stop])
                    doc_ids += names[first + at:first + stop]
                    size += int(before[stop] - before[at])
                    at = stop
                    if size >= chunk_ids:
                        yield close()
                        number, start, size = number + 1, start + size, 0
                        doc_ids, lengths, held = [], [], []
        if held:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    map_arrow(rows, chunks, CHUNK_SCHEMA).write.option("compression", "uncompressed").parquet(path)


ARROW = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("shard_start", pa.int64()), ("n_ids", pa.int64()),
                   ("unit", pa.string()), ("block_ids", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
                   ("plane_sizes", pa.list_(pa.int32())), ("planes", pa.binary())])


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """(shard, chunk, first_id, start, n_ids, doc_ids, doc_lengths): where each chunk's ids begin among all ids.

    Read from the index columns alone. Only shard totals, one row each, are summed up in one task.
    """
    index = spark.read.schema(CHUNK_SCHEMA).parquet(path).select("shard", "chunk", "first_id", "shard_start", "n_ids", "doc_ids", "doc_lengths")
    totals = index.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    return index.join(offsets, "shard").withColumn("start", F.col("before") + F.col("shard_start")).drop("before", "shard_start")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """(a chunk's columns, its ids, where its documents begin, and the end)."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = {c: batch.column(c)[row] for c in batch.schema.names}
            ids = unpack_chunk(one["planes"].as_py(), one["plane_sizes"].values.to_numpy(), one["n_ids"].as_py(), one["unit"].as_py(), one["block_ids"].as_py())
            yield one, ids, np.concatenate([[0], np.cumsum(one["doc_lengths"].values.to_numpy())])


def _of_chunk(one: dict, ends: np.ndarray) -> dict[str, pa.Array]:
    n = len(ends) - 1
    return {"shard": pa.array(np.full(n, one["shard"].as_py()), pa.int32()), "chunk": pa.array(np.full(n, one["chunk"].as_py()), pa.int32()),
            "doc_id": one["doc_ids"].values, "chunk_start": pa.array(ends[:-1], pa.int64())}


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, chunk, doc_id, chunk_start, ids) of every document, decoded chunk by chunk in any order."""
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, ids, ends in _decoded(batches):
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_pydict(_of_chunk(one, ends) | {"ids": lists})

    rows = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    return map_arrow(rows, documents, "shard int, chunk int, doc_id long, chunk_start long, ids array<int>")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(shard, chunk, doc_id, chunk_start, n_tokens, ids_crc32) of every document: what its ids, decoded from the files, add
    up to as little-endian 32-bit integers. The ids themselves stay in the task that reads them."""
    def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, ids, ends in _decoded(batches):
            raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
            at = (4 * ends).tolist()
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_pydict(_of_chunk(one, ends) | {"n_tokens": pa.array(np.diff(ends), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    rows = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    return map_arrow(rows, checksums, "shard int, chunk int, doc_id long, chunk_start long, n_tokens long, ids_crc32 long")
