import numpy as np
import pytest
from pyspark.sql import functions as F

from periodix.llm import quality, toxicity
from periodix.llm.queries import QUERIES
from periodix.llm.sample import in_fold, labelled
from tests.conftest import SF_MID
from tests.llm.conftest import TEXTS


@pytest.mark.parametrize("name,label", [("op5_quality_classifier", "quality"), ("op6_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    scored = QUERIES[name](spark, SF_MID)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert scored.count() == docs.count()
    rows = scored.join(spark.read.parquet(f"{SF_MID}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (rows.predicted == rows[label]).mean() >= 0.93
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.5) == (rows.predicted == 1)).all()


def test_held_out_labels_are_never_read(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    held = in_fold(F.col("doc_id"), 5, 0)
    import zlib

    got = {r.doc_id for r in labelled(docs, labels, "doc_id", "text", "toxic", held, 100).collect()}
    assert got == {i for i in range(30) if zlib.crc32(str(i).encode()) % 5}
    assert labelled(docs, labels, "doc_id", "text", "toxic", held, 7).count() == 7


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, odd_docs, no_docs, module, label):
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 1), (7, 0), (10, None), (None, 1), (99, 1)], f"doc_id long, {label} int")
    for part in (labels, labels.where("false"), labels.where(f"{label} = 1")):
        model = module.train(odd_docs, part, F.lit(False))
        rows = module.score(odd_docs, model).collect()
        assert sorted((str(r.doc_id) for r in rows)) == sorted(str(i) for i, _ in TEXTS)
        assert all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (4, 5)}) == 1  # null and empty
        assert module.score(no_docs, model).count() == 0
    assert module.train(no_docs, labels, F.lit(False)) is not None


def test_dropping_toxic_rows_keeps_the_columns(spark, odd_docs):
    model = toxicity.train(odd_docs, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(False))
    assert toxicity.without_toxic(odd_docs, model).columns == odd_docs.columns


def _rows(texts):
    [(_, _, row, feature, value)] = list(toxicity.features_of(toxicity.pa.array(texts)))
    return row, feature, value


def _words_in(text):
    feature = _rows([text])[1]
    return feature[feature % 2 == 0]


def test_swapping_groups_matters_less_with_the_penalty():
    rng = np.random.default_rng(0)
    neutral = [f"w{i}" for i in range(50)]
    texts, labels = [], []
    for i in range(300):  # one group is named in most toxic texts, another in most others
        bad = i % 3 == 0
        group = "muslim" if rng.random() < (0.9 if bad else 0.1) else "christian"
        texts.append(" ".join([*rng.choice(neutral, 8), group, *(["scum"] if bad and rng.random() < 0.8 else [])]))
        labels.append(int(bad))
    labels, sets = np.array(labels), toxicity.swap_sets([], 1, 1, toxicity.IDENTITY_TERMS)
    gap = {}
    for weight in (0.0, 5.0):
        model = toxicity.fit(*_rows(texts), labels, [_words_in(t) for t in texts], sets, fairness=weight)
        assert model.pairs > len(texts)
        a, b = model.margins(*_rows(["the muslim w1 spoke", "the christian w1 spoke"]), 2)
        gap[weight] = abs(a - b) / np.abs(model.weights).max()
    assert gap[5.0] < 0.3 * gap[0.0]


def test_additive_model_learns_main_effects_and_a_pair():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int)  # nothing but an interaction
    model = quality.fit(x[:3000], y[:3000], rounds=20, n_pairs=1)
    assert list(model.pairs) == [(0, 1)]
    assert ((model.margins(x[3000:]) > 0) == y[3000:]).mean() > 0.85
    y = (x[:, 2] ** 2 > 0.5).astype(int)
    model = quality.fit(x[:3000], y[:3000], rounds=60)
    assert ((model.margins(x[3000:]) > 0) == y[3000:]).mean() > 0.9


def test_features_match_plain_counting():
    text = "Ab, cd 12!\nAb, cd 12!\nÉ | x\n"
    [(_, _, x)] = list(quality.features(toxicity.pa.array([text, None, ""])))
    got = dict(zip(quality.FEATURES, x[0]))
    size = len(text.encode())
    assert np.isclose(got["log_bytes"], np.log1p(size)) and np.isclose(got["upper"], 2 / size) and np.isclose(got["digits"], 4 / size)
    assert np.isclose(got["pipes"], 1 / size) and np.isclose(got["non_ascii"], 2 / size) and np.isclose(got["words_per_line"], 3)
    assert np.isclose(got["distinct_words"], 6 / 9) and np.isclose(got["top_word"], 2 / 9) and np.isclose(got["repeated_lines"], 1 / 3)
    assert np.isclose(got["shouted"], 2 / 9) and (x[1] == 0).all() and (x[2] == 0).all()


def test_swaps_occur_on_the_registered_tables_and_most_toxic_texts_are_found(spark):
    """The penalty sees swaps, held-out toxic documents are found, clean ones stay, and swaps hardly change a score."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = toxicity.train(docs, labels, held_out)
    assert model.pairs > 1000
    judged = toxicity.score(docs, model).where(held_out).join(labels.where("toxic is not null"), "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in judged.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) >= 0.9 and n.get((0, 1), 0) / n[0, 0] <= 0.01, n


def test_identity_terms_are_a_parameter(spark):
    rows = [(i, f"w{i % 7} the {'zorg' if i % 2 else 'blip'} said {'scum' if i % 3 == 0 else 'hello'}.") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) as toxic")
    assert toxicity.train(docs, labels, F.lit(False), identity_terms={"g": ["zorg", "blip"]}).pairs > 0
    few = docs.selectExpr("doc_id", "concat(case when doc_id % 3 = 0 then 'scum' else 'hello' end, doc_id) as text")
    with pytest.warns(UserWarning, match="counterfactual"):
        fitted = toxicity.train(docs.selectExpr("doc_id", "if(doc_id % 3 = 0, 'scum', 'hello') as text").unionByName(few.limit(0)), labels, F.lit(False), identity_terms={})
    assert fitted.pairs == 0

