import random
import re

import pytest

from periodix.llm.decontaminate import contamination, decontaminate, judged
from tests.llm.conftest import TEXTS


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, window):
    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else []:
            grams.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(g) for g in grams}:
            for at in range(len(w) - size + 1):
                if tuple(w[at:at + size]) in grams:
                    hit |= set(range(at, at + size))
                    found |= grams[tuple(w[at:at + size])]
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def found(docs, items, **options):
    rows = judged(contamination(docs, items, **options)).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in rows), key=str)


def random_case(seed):
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([1, 3, 5, 12, 13, 14, 40])))) for i in range(12)] + [(50, None), (51, ""), (52, "")]
    items += [(60, items[5][1]), (61, "v1 " * 30)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(r.choice([1, 2, 4])):
            w = (r.choice(items)[1] or "x").split()
            at = r.randrange(max(1, len(w)))
            parts += r.choices(vocabulary, k=r.choice([0, 5, 30])) + w[at:at + r.choice([4, 12, 13, 20, 60])]
        docs.append((i, ", ".join(parts)))
    return docs, items


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 40)])
def test_against_brute_force(spark, seed, block):
    docs, items = random_case(seed)
    got = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_words=block)
    assert got == brute(docs, items, 13)


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, TEXTS[0][1]), (2, "one"), (3, None), (4, "word1x1 word2x2 word3x3"), (5, " ")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    assert found(odd_docs, bench) == brute(TEXTS, items, 13)
    assert found(no_docs, bench) == []
    assert found(odd_docs, bench.where("false")) == brute(TEXTS, [], 13)
    clean = decontaminate(odd_docs, bench)
    assert clean.columns == odd_docs.columns
    assert sorted((r.doc_id for r in clean.select("doc_id").collect()), key=str) == sorted([4, 5, 6, 10, 11, 12, None], key=str)


def test_rows_that_share_an_id_and_items_without_one(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(5, passage, 1), (5, "clean words", 2), (None, passage, 3), (None, None, 4)], "doc_id long, text string, spans int")
    bench = spark.createDataFrame([(1, passage), (None, "clean words")], "item_id long, text string")
    kept = decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == [(5, "clean words", 2), (None, None, 4)]
    items = {tuple(r["items"]) for r in contamination(docs, bench).collect()}
    assert items == {("1",), ()}
