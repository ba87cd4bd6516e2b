"""Runs of words against a search of every period, on random and on odd texts."""

import random
import re

import numpy as np
import pytest

from periodix.llm import periodic_runs as P


def brute(words, periods=4, least=6):
    found, n = {}, len(words)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, periods * q):
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted((s, length, q) for (s, length), q in found.items())


def repeating(rng, n, letters):
    words = [rng.randrange(letters) for _ in range(n)]
    if words and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + rng.randrange((n - a) // 3 + 1)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if rng.random() < 0.3:
            words[rng.randrange(n)] = letters
    return words


def test_runs_match_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        texts = [repeating(rng, rng.randint(0, 70), rng.choice([1, 2, 3, 7])) for _ in range(rng.randint(1, 4))]
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        got = P.find_runs(np.array([w for t in texts for w in t], np.int64), first)
        want = [(s + int(f), s + int(f) + length, q) for t, f in zip(texts, first) for s, length, q in brute(t)]
        assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(0, P.PRIME, (3, 64)).astype(np.uint64)
    assert (P.restore(P.transform(x)) == x).all()
    words = rng.integers(0, 2**40, 90).astype(np.uint64)
    words[40:56] = words[13:29]
    squares = np.concatenate([[0], np.cumsum([pow(int(w), 2, P.PRIME) for w in words])]).astype(np.int64)
    at, distance = P.occurrences(words % np.uint64(P.PRIME), squares, np.array([13, 14]), 16)
    assert (at.tolist(), distance.tolist()) == ([13], [27])


def test_long_period_and_low_power():
    words = np.random.default_rng(2).integers(0, 1000, 5000)
    again = words[200 + np.arange(4800) % 1111]
    text = np.concatenate([words[:200], again])
    start = 200 - next(k for k in range(200) if words[199 - k] != words[200 + 1110 - k])
    assert P.find_runs(text, np.array([0, 5000])) == [(start, 5000, 1111)]
    with pytest.raises(ValueError):
        P.find_runs(text, np.array([0, 5000]), periods=3)


def test_odd_texts(spark, odd_docs, no_docs):
    rows = P.periodic_runs(odd_docs).collect()
    texts = odd_docs.select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for got, given in zip(rows, texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", given.text or "")
        assert got.doc_id == given.doc_id and got.n_words == len(words)
        if len(words) < 1000:
            assert [tuple(r) for r in got.runs] == brute(words)
            kept = [w for i, w in enumerate(words) if not any(r.start + r.period <= i < r.start + r.length for r in got.runs)]
            assert got.collapsed == " ".join(kept) and (got.top is None) == (not got.runs)
    assert P.periodic_runs(no_docs).count() == 0


def test_top_and_collapsed(spark):
    docs = spark.createDataFrame([(1, "x a a a a a a y " + "b c " * 5 + "z"), (2, "é " * 6), (3, "q q q q q q r r r r r r"), (3, None)], "doc_id long, text string")
    a, b, c, d = P.periodic_runs(docs).collect()
    assert [tuple(r) for r in a.runs] == [(1, 6, 1), (8, 10, 2)] and a.top == 0 and a.collapsed == "x a y b c z"
    assert [tuple(r) for r in b.runs] == [(0, 6, 1)] and b.collapsed == "é"
    assert [tuple(r) for r in c.runs] == [(0, 6, 1), (6, 6, 1)] and c.top == 0 and c.collapsed == "q r"
    assert (d.doc_id, d.n_words, d.runs, d.top, d.collapsed) == (3, 0, [], None, "")
