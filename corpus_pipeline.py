"""A corpus pipeline over ``documents``: toxic texts go, then exact and near copies, then benchmark passages; what is
left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return the
columns of ``documents``. Stages are written as Parquet and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodix.llm import decontaminate, dedup, ngram_join, packing, toxicity
from periodix.llm.queries import tokenizer_path
from periodix.llm.sample import in_fold
from periodix.llm.work import ship_package, work_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5; labels of one fold in five are never learned.

    Each row is judged by its text, whatever its id; null and empty texts stay, equal rows share their fate, and an empty
    table stays empty."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels, in_fold(F.col("doc_id"), 5, 0)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of equal texts, of those with the smallest id; a null id counts as larger than any.

    Null and empty texts are one class; rows that share an id but not a text are judged on their own."""
    return dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class linked by a Jaccard similarity of 0.8 or more of five-word shingles, of those with the smallest id.

    Texts without words all stay; rows that share an id but not a text are judged on their own, equal rows leave one."""
    ship_package(spark)
    return ngram_join.one_of_each(docs, rule=ngram_join.Jaccard(words=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than 5 % of the words repeat benchmark windows of 13 words.

    Each row is judged by its text; null and empty texts stay, and items without an id or without words never occur."""
    ship_package(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and places in sequences of 4096.

    A null text is empty and has only the end id; rows with null or repeated ids are documents of their own."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("ngram_jaccard_join", drop_near_copies),
          ("benchmark_decontamination", drop_contaminated), ("best_fit_packing", pack_sequences)]

#: Toxicity and packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder before the next."""
    folder = work_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
