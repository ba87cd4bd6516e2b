import hashlib
import re

from pyspark.sql import functions as F

from periodix.llm.dedup import deduplicate, exact_duplicates
from tests.llm.conftest import TEXTS


def expected(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out = []
    for i, t in norm:
        ids = [j for j, u in norm if u == t]
        keep = min((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_odd_rows(odd_docs):
    assert sorted(map(tuple, exact_duplicates(odd_docs).collect()), key=str) == expected(TEXTS)


def test_equal_hashes_of_different_bytes_stay_apart(odd_docs):
    found = exact_duplicates(odd_docs, content_hash=lambda body: (F.length(body) % 2).cast("string"))
    assert sorted(map(tuple, found.collect()), key=str) == expected(TEXTS)


def test_empty_table_and_columns(odd_docs, no_docs):
    assert exact_duplicates(no_docs).count() == 0
    kept = deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str) == sorted([1, 2, 3, 4, 6, 7, 9, 10, 11, 12], key=str)


def test_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("text"))
    rows = exact_duplicates(docs)
    assert rows.where("group_size = 1000 and keep_id = 0").count() == 1000
    assert rows.where("kept").count() == 2001


def test_no_python_in_the_plan(odd_docs):
    plan = exact_duplicates(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Pandas" not in plan


def test_rows_that_share_an_id_are_told_apart(spark):
    rows = [(1, "a", 1), (5, "a", 2), (5, "b", 3), (7, "x", 4), (7, "x", 5), (9, None, 6), (None, "", 7), (None, "c", 8), (None, "c", 9)]
    kept = deduplicate(spark.createDataFrame(rows, "doc_id long, text string, hash int"))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(1, "a"), (5, "b"), (7, "x"), (9, None), (None, "c")]
