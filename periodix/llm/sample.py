"""Labelled rows for fitting a classifier: a bounded sample in hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(id_col: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id, as text, leaves ``fold`` when divided by ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, held_out: Column, bound: int) -> DataFrame:
    """(doc_id, text, label) of at most ``bound`` labelled ids that are not held out, by the hash of the id.

    ``held_out`` is an expression over a column ``doc_id``. Null labels and ids are left out. The ids are bounded,
    so they are broadcast; each sampled id's texts all count.
    """
    ids = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    ids = ids.where("doc_id is not null and label is not null").where(~held_out)
    ids = ids.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(ids), "doc_id")
