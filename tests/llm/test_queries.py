"""Registered queries against DuckDB, and the pipeline against brute force, stage by stage."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from periodix.llm import toxicity
from periodix.llm.ngram_join import Jaccard
from periodix.llm.queries import ORACLE_SQL, QUERIES
from periodix.llm.sample import in_fold
from tests.conftest import SF_SMALL
from tests.llm.conftest import TEXTS
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_ngram_join import brute as components


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    columns, kept = docs.columns, set(rows)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        now = [(i, rows[i]) for i in sorted(kept)]
        if name == "toxicity":
            model = toxicity.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"), in_fold(F.col("doc_id"), 5, 0))
            kept = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").collect()}
        elif name == "exact_dedup":
            first = {}
            for i, t in now:
                first.setdefault(" ".join(__import__("re").split(r"[\x20\x09-\x0D]+", t or "")), i)
            kept = set(first.values())
        elif name == "ngram_jaccard_join":
            kept = {i for i, (_, c) in components(now, Jaccard(5, 80)).items() if i == c}
        elif name == "benchmark_decontamination":
            kept = {i for i, _, _, _, bad in contaminated(now, items, 13) if not bad}
        else:
            whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            got = {}
            for r in out.collect():
                assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32
                got.setdefault(r.doc_id, []).append((r.start, list(r.ids)))
            assert {i: [x for _, p in sorted(parts) for x in p] for i, parts in got.items()} == {
                i: [*whole.encode(t or "", add_special_tokens=False).ids, 1] for i, t in now}
            continue
        assert out.columns == columns
        assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(kept)
        assert {r.doc_id: r.text for r in out.select("doc_id", "text").collect()} == {i: rows[i] for i in kept}
        docs = out


def test_stages_on_odd_rows(spark, odd_docs, no_docs, tmp_path):
    """Rows that share an id, equal rows, nulls and an empty table through every stage."""
    passage = " ".join(f"w{i}" for i in range(20))
    texts = TEXTS + [(5, "a text of its own under an id that is taken"), (21, passage), (21, passage + " and so on " * 200), (None, "nobody's words, said once")]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("labels", "benchmark"):
        table = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "labels":  # of documents that are none of these: whatever they say, nothing here is toxic
            table = table.withColumn("toxic", F.lit(0).cast(table.schema["toxic"].dataType))
        if name == "benchmark":
            table = table.union(spark.createDataFrame([(10**6, passage), (None, "one two")], table.schema))
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        none = stage(spark, docs.where("false"), str(tmp_path))
        out = spark.read.parquet(f"{tmp_path}/{name}")
        assert none.count() == 0 and none.columns == out.columns
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            docs = out
        kept[name] = sorted(map(tuple, out.select("doc_id", *(["text"] if "text" in out.columns else [])).collect()), key=str)
    assert len(kept["toxicity"]) == len(texts)
    texts = kept["exact_dedup"]
    assert (5, "a text of its own under an id that is taken") in texts and (None, "nobody's words, said once") in texts
    assert [i for i, t in texts if t == "one"] == [7] and [i for i, t in texts if not t] == [4] and len(texts) == 14
    near = kept["ngram_jaccard_join"]
    assert set(near) <= set(texts) and [i for i, t in near if t and t.startswith("word0x0")] == [10]
    clean = kept["benchmark_decontamination"]
    assert set(near) - set(clean) == {(21, passage)} and (21, passage + " and so on " * 200) in clean
    assert sorted({i for i, in kept["best_fit_packing"]}, key=str) == sorted({i for i, _ in clean}, key=str)
