"""The trie against one of Python dictionaries, with one shard and with many."""

import hashlib
import random

import numpy as np
import pytest

from periodix.llm import prefix_trie as T


def brute(conversations):
    """Rows of the trie of {id: [(key, words), ...]}."""
    nodes = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(k for k, _ in turns[:d]), []).append((c, len(turns) == d, turns[d - 1][1] if d else 0))
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below)]
        ends = ",".join(str(c) for c in sorted(c for c, last, _ in members if last))
        out.append((min(c for c, _, _ in members), len(path), min(c for c, _, _ in nodes[path[:-1]]) if path else None, len(members), len(children), len(leaves),
                    sum((len(nodes[p]) - 1) * nodes[p][0][2] for p in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def lists_of(spark, conversations):
    rows = [(c, [(hashlib.md5(k.encode()).hexdigest(), w) for k, w in turns]) for c, turns in conversations.items()]
    return spark.createDataFrame(rows, "conv_id long, turns array<struct<digest:string,words:int>>")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_closing_parentheses():
    rng = random.Random(3)
    for _ in range(60):
        letters = rng.choice([2, 3, 8])
        paths = sorted({tuple(rng.randrange(letters) for _ in range(rng.randint(0, rng.choice([3, 6, 40])))) for _ in range(rng.randint(1, 60))})
        first = np.concatenate([[0], np.cumsum([len(p) for p in paths])]).astype(np.int64)
        tree = T.Parentheses(np.diff(first), T.shared_lengths(np.array([x for p in paths for x in p], np.int64), first))
        for node, at in enumerate(tree.opens):
            stop = at + 1
            while tree.excess[stop] >= tree.excess[at]:
                stop += 1
            assert tree.close[node] == stop


@pytest.mark.parametrize("shard_turns", [2, 9, 1 << 16])
def test_trie_matches_brute_force(spark, shard_turns):
    rng = random.Random(shard_turns)
    conversations = {c: [(f"{k}", 3 + k) for k in (rng.randrange(2) for _ in range(rng.choice([0, 1, 2, 3, 5])))] for c in range(-3, 60)}
    conversations |= {c: [("hot", 7), ("hotter", 1)] for c in range(100, 140)}  # one path of very many
    conversations[500] = [(f"{i % 3}", i % 3) for i in range(300)]
    assert rows(T.prefix_trie(lists_of(spark, conversations), shard_turns)) == brute(conversations)


def test_turn_lists_of_odd_rows(spark):
    given = [(1, 2, "user", "b c"), (1, None, None, None), (1, 1, "user", ""), (1, 1, "user", "x\ty"), (1, 1, "user", "x\ty"), (None, 0, "user", "z"), (2, None, "a", "1"),
             (3, 0, "", "a1"), (4, 0, "a", "1")]
    conversations = spark.createDataFrame([(*r, "x", 1) for r in given], "conv_id long, turn long, role string, text string, turns string, digest int")
    got = {r.conv_id: [(t.digest, t.words) for t in r.turns] for r in T.turn_lists(conversations).collect()}
    assert set(got) == {1, 2, 3, 4} and [w for _, w in got[1]][0] == 0 and [w for _, w in got[1]][-1] == 2 and len(got[1]) == 5
    assert got[3] != got[4] and got[2] == got[4]
    assert sorted(w for _, w in got[1]) == [0, 0, 2, 2, 2]
    trie = rows(T.prefix_trie(T.turn_lists(conversations)))
    assert trie == brute({c: turns for c, turns in got.items()})
    none = conversations.where("false")
    assert T.prefix_trie(T.turn_lists(none)).count() == 0
