import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from periodix.llm import ngram_join
from periodix.llm.ngram_join import CountTree, Jaccard, one_of_each, routes, shingle_sets, similar_sets
from tests.llm.conftest import TEXTS


def sets_of(docs, k):
    out = {}
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        out[i] = frozenset(tuple(words[j:j + k]) for j in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])
    return out


def brute(docs, rule):
    """Components by counting common shingles over an inverted index of all sets."""
    sets = sets_of(docs, rule.words)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, s in sorted(sets.items()):
        for j, n in Counter(j for g in s for j in index[g]).items():
            if 100 * n >= rule.percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for g in s:
            index[g].append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(seed, n):
    """Texts with near copies at all distances, shared lines and a large family."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    lines = [" ".join(r.choices(vocabulary, k=25)) for _ in range(4)]
    texts = []
    for i in range(n):
        if texts and r.random() < 0.6:
            words = (texts[0] if r.random() < 0.4 else r.choice(texts)).split()
            for _ in range(r.choice([0, 1, 1, 2, 3, 6])):
                at = r.randrange(len(words))
                words[at:at + r.choice([0, 1, 1])] = r.choices(vocabulary, k=1)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join([r.choice(lines), *r.choices(vocabulary, k=r.choice([1, 3, 8, 20, 60, 150])), r.choice(lines)][r.randrange(2):]))
    return list(enumerate(texts))


@pytest.mark.parametrize("rule", [Jaccard(3, 90), Jaccard(5, 80), Jaccard(2, 50)])
def test_linked_sets_share_kept_keys(rule):
    """Without Spark: whatever is linked has a key in common after the most frequent ones are left out."""
    docs = corpus(1, 300)
    sets = sets_of(docs, rule.words)
    [(_, _, h, first)] = list(shingle_sets(pa.array([t for _, t in docs]), rule.words))
    row, key, code = routes(h, first, rule)
    count = Counter(key.tolist())
    parts = defaultdict(list)
    for r, k, c in zip(row.tolist(), key.tolist(), code.tolist()):
        parts[r, c % 2].append((-min(count[k], ngram_join.FREQUENT), -k, c // 2, k))
    kept = defaultdict(set)
    for (r, _), keys in parts.items():
        kept[r] |= {x[3] for x in sorted(keys)[keys[0][2]:]}
    links = 0
    for i in sets:
        for j in sets:
            if i < j and sets[i] != sets[j] and sets[i] and 100 * len(sets[i] & sets[j]) >= rule.percent * len(sets[i] | sets[j]):
                links += 1
                assert kept[i] & kept[j], (i, j)
    assert links > 20


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_tree_finds_what_brute_force_finds(percent):
    docs, rule = corpus(2, 200), Jaccard(3, percent)
    sets = list(set(sets_of(docs, 3).values()))
    [(_, _, h, first)] = list(shingle_sets(pa.array([t for _, t in docs]), 3))
    arrays = list({tuple(h[a:b].tolist()) for a, b in zip(first, first[1:]) if b > a})
    arrays = [np.array(a, dtype=np.uint64) for a in arrays]
    tree = CountTree(arrays, rule)
    for i in range(0, len(arrays), 7):
        found = set(tree.linked(0, tree.points[i], tree.sets[i], np.zeros(len(arrays), bool)).tolist())
        mine = set(tree.sets[i].tolist())
        want = {j for j, s in enumerate(tree.sets) if 100 * len(mine & set(s.tolist())) >= percent * len(mine | set(s.tolist()))}
        assert found == want
    assert len(sets) == len(arrays)


def check(spark, docs, rule):
    found = similar_sets(spark.createDataFrame(docs, "doc_id long, text string"), rule=rule)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    assert got == brute(docs, rule)


def test_components(spark):
    check(spark, corpus(3, 400), Jaccard(3, 90))


def test_components_with_many_small_trees(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TREE_DOCS", 4)
    check(spark, corpus(4, 300), Jaccard(5, 80))


def test_odd_rows(odd_docs, no_docs):
    rule = Jaccard(3, 90)
    want = brute([(i, t) for i, t in dict(x for x in TEXTS if x[0] is not None).items()], rule)
    rows = similar_sets(odd_docs, rule=rule).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    assert similar_sets(no_docs, rule=rule).count() == 0
    kept = one_of_each(odd_docs, rule=rule)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str) == sorted([1, 4, 5, 6, 7, 9, 10, 12, None], key=str)


def test_rows_that_share_an_id_are_told_apart(spark):
    a, b, c = ("alpha beta gamma delta", "one two three four", "red green blue grey")
    rows = [(1, a), (5, a), (5, b), (7, c), (7, c), (None, b), (None, "x y z"), (None, "x y z"), (8, ""), (8, None)]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), rule=Jaccard(3, 90))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, a), (5, b), (7, c), (None, "x y z"), (8, ""), (8, None)], key=str)


def test_near_stars_keeps_components_with_few_edges(spark):
    """A family whose documents have many heads in common: about one edge for each document is left."""
    heads, docs = 20, 400
    edges = [(d, h) for d in range(heads, docs) for h in range(heads) if (d * 7 + h) % 3] + [(1000, 1000), (1002, 1001), (1002, 1000)]
    near = [tuple(e) for e in ngram_join.near_stars(spark.createDataFrame(edges, "a long, b long")).select("a", "b").collect()]
    assert len(near) == len(set(near)) < docs + heads * 3
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in near:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {find(d) for d in range(docs)} == {0} and {find(d) for d in (1000, 1001, 1002)} == {1000}


def test_spanning_links_are_no_more_than_join_something():
    """Sets joined already count as one: a tree of n sets has n - 1 links at most, and loses no component."""
    r = np.random.default_rng(3)
    base = np.sort(r.choice(2**40, 60, replace=False)).astype(np.uint64)
    sets = []
    for i in range(120):  # a chain of near copies, so that later points meet large clusters
        if i % 3 == 0:
            base = np.sort(np.concatenate([np.delete(base, r.integers(len(base), size=2)), r.integers(2**40, size=2).astype(np.uint64)]))
        sets.append(np.unique(np.concatenate([np.delete(base, r.integers(len(base))), r.integers(2**40, size=1).astype(np.uint64)])))
    rule = Jaccard(5, 80)
    links = list(ngram_join.spanning_links(sets, np.arange(len(sets)), np.ones(len(sets), bool), rule))
    assert len(links) <= len(sets) - 1

    def classes(pairs):
        label = list(range(len(sets)))
        for i, j in pairs:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
        return {frozenset(k for k, x in enumerate(label) if x == y) for y in set(label)}

    every = [(i, j) for i in range(len(sets)) for j in range(i) for n in [len(np.intersect1d(sets[i], sets[j]))]
             if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n)]
    assert classes(links) == classes(every)
