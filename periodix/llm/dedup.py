"""Exact duplicates: group by a 128-bit content hash, keep the smallest id, compare bytes within groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodix.llm.work import repeated_ids, work_folder, written


def normalised(text: str) -> Column:
    """The text with every run of ASCII white space replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _classes(keyed: DataFrame) -> DataFrame:
    """(hash, text_sha256, keep_id, group_size) of each class of two or more rows of ``keyed`` (doc_id, body, hash), written."""
    classes = (keyed.groupBy("hash", "body")
               .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .where("group_size > 1"))
    return written(classes.select("hash", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size"),
                   work_folder(keyed.sparkSession), "classes")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """Duplicate classes: (doc_id, keep_id, group_size, kept, text_sha256), one row per input row.

    Rows are grouped by (hash, normalised text), so equal hashes of different bytes never share a class; copies
    combine within each task before the shuffle, whatever share of the rows they hold. Classes of two rows or
    more are written to the shared folder without their texts, and rows look theirs up by hash and SHA-256.

    Null and empty texts are equal. The smallest id stays; a row with a null id stays only if its class has no
    other id. A row repeated with the same id and text is one document: all its copies carry the same verdict.
    An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("body"))
    keyed = rows.select("doc_id", "body", content_hash(F.col("body")).alias("hash"))
    classes = _classes(keyed)
    looked = keyed.select("doc_id", "hash", F.sha2("body", 256).alias("text_sha256"))
    found = looked.join(classes, ["hash", "text_sha256"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each class of equal texts, of those with the smallest id; all columns stay as they are.

    Rows are told apart by their texts, not by their ids: rows that share an id but not a text are judged on their own. Of
    a row repeated with id and text one stays, a null id counts as larger than any other, and null and empty texts are one
    class. An empty table gives an empty result.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col(id_col).alias("doc_id"), normalised(text_col).alias("body"))
    classes = _classes(rows.select("doc_id", "body", F.md5("body").alias("hash")))
    rows = rows.select("row", "doc_id", F.md5("body").alias("hash"), F.sha2("body", 256).alias("text_sha256"))
    found = rows.join(classes, ["hash", "text_sha256"], "left")
    kept = found.where(F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    if not repeated_ids(docs, id_col).isEmpty():  # a class may have several rows of its smallest id
        kept = written(kept, work_folder(docs.sparkSession), "kept")
        firsts = kept.where("group_size is not null").dropDuplicates(["hash", "text_sha256"])
        kept = kept.where("group_size is null").select("row").unionAll(firsts.select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
