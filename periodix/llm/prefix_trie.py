"""The prefix trie of conversations, as balanced parentheses per shard.

Conversations are sorted by their turns' digests, so every subtree of the trie is a run of rows, and dealt to shards by
range. A shard writes its trie as a sequence of parentheses, depth first. Range minima over blocks of the excess find the
parenthesis that closes a node, which delimits its subtree; the rank of "()" pairs counts its leaves; cumulative arrays
over the nodes in order give how many conversations it has and the tokens that sharing saves.

Only nodes above a shard's first or last row can go on in another shard. These spines, two short paths for each shard,
carry what hangs off them and are merged as one more, small trie. A conversation is one row of 16 bytes and a count for
each turn; one path with very many conversations is split between shards like any other run of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodix.llm.text import runs
from periodix.llm.work import map_arrow, work_folder, written

#: Turns of a shard, about; its trie takes some hundred bytes a turn.
SHARD_TURNS = 1 << 16
BLOCK = 64
#: Stands for no conversation in minima.
NONE = np.iinfo(np.int64).max


def turn_lists(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, null turns first, as (digest, words).

    The digest is the md5 of role and text, null being empty; words are counted between ASCII white space. Equal turn
    numbers are ordered by digest. Rows with a null id belong to no conversation and are left out; other columns are
    ignored. Texts stay where they are read: only digests are shuffled.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col(turn_col).isNotNull().alias("numbered"), F.col(turn_col).alias("turn"), digest.alias("digest"),
                    F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    rows = conversations.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), turn.alias("turn"))
    lists = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t.digest.alias("digest"), t.words.alias("words"))).alias("turns"))


class Parentheses:
    """The trie of sorted paths: one node, in depth-first order, for the root and for each element that a path does not
    share with the path before it. ``shared`` is how many it shares."""

    def __init__(self, lengths: np.ndarray, shared: np.ndarray):
        before = np.concatenate([[0], lengths[:-1]])
        counts = np.stack([before - shared, lengths - shared], axis=1).reshape(-1)
        closes = np.zeros(int(lengths[-1]) + 1, np.int8)
        self.bits = np.concatenate([[1], np.repeat(np.tile(np.array([0, 1], np.int8), len(lengths)), counts), closes]).astype(np.int8)
        self.excess = np.cumsum(2 * self.bits.astype(np.int32) - 1)
        self.opens = np.flatnonzero(self.bits)
        self.depth = self.excess[self.opens] - 1
        #: the node at which each path ends
        self.ends = np.cumsum(lengths - shared)
        self.close = self._find_close()
        self.size = (self.close - self.opens + 1) // 2
        n = len(self.opens)
        order = np.argsort(self.depth, kind="stable")
        keys = self.depth[order].astype(np.int64) * n + order
        #: the last node before, one level up
        self.parent = order[np.searchsorted(keys, (self.depth.astype(np.int64) - 1) * n + np.arange(n)) - 1]
        self.parent[0] = -1
        self.by_depth = np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1)

    def _find_close(self) -> np.ndarray:
        """For every node the first place where the excess falls below the one at its opening parenthesis."""
        n, want = len(self.excess), self.excess[self.opens]
        padded = np.concatenate([self.excess, np.zeros(-n % BLOCK, np.int32)])
        levels = [padded.reshape(-1, BLOCK).min(axis=1)]
        while len(levels[-1]) > 1:
            last = levels[-1] if len(levels[-1]) % 2 == 0 else np.append(levels[-1], np.iinfo(np.int32).max)
            levels.append(last.reshape(-1, 2).min(axis=1))
        close = np.full(len(self.opens), -1)
        todo = np.arange(len(self.opens))
        for k in range(1, BLOCK):  # in the block of the opening parenthesis
            at = self.opens[todo] + k
            inside = at // BLOCK == self.opens[todo] // BLOCK
            todo, at = todo[inside], at[inside]
            found = padded[at] < want[todo]
            close[todo[found]] = at[found]
            todo = todo[~found]
            if not len(todo):
                break
        todo = np.flatnonzero(close < 0)
        if len(todo):
            block, level, below = self.opens[todo] // BLOCK + 1, np.full(len(todo), -1), want[todo]
            for up, minima in enumerate(levels):  # upwards, from range to next range, to one with a smaller excess
                minima = np.append(minima, np.iinfo(np.int32).max)
                for step in (0, 1):  # an even range and the odd one after it have one parent
                    hit = (level < 0) & (minima[np.minimum(block + step, len(minima) - 1)] < below)
                    if step:
                        hit &= block % 2 == 0
                    level[hit] = up
                    block[hit] += step
                block = np.where(level < 0, block // 2 + 1, block)
            for down in range(len(levels) - 2, -1, -1):  # and down to the block
                deeper = level > down
                block = np.where(deeper, block * 2, block)
                block += deeper & (levels[down][np.minimum(block, len(levels[down]) - 1)] >= below)
            for first in range(0, len(todo), 1 << 14):
                part = slice(first, first + (1 << 14))
                here = padded[block[part, None] * BLOCK + np.arange(BLOCK)] < want[todo[part], None]
                close[todo[part]] = block[part] * BLOCK + here.argmax(axis=1)
        return close

    def over_subtrees(self, own: np.ndarray) -> np.ndarray:
        """For every node the sum of ``own`` over its subtree, from one cumulative array."""
        total = np.concatenate([[0], np.cumsum(own)])
        at = np.arange(len(own))
        return total[at + self.size] - total[at]

    def leaves(self, counted: np.ndarray) -> np.ndarray:
        """For every node the number of "()" pairs in its subtree that open a node of ``counted``."""
        pair = np.zeros(len(self.bits), np.int64)
        pair[self.opens] = (self.size == 1) & counted
        rank = np.concatenate([[0], np.cumsum(pair)])
        return rank[self.close] - rank[self.opens]

    def least(self, own: np.ndarray) -> np.ndarray:
        """For every node the minimum of ``own`` over its subtree, from the deepest level up."""
        out = own.copy()
        for nodes in self.by_depth[:0:-1]:
            np.minimum.at(out, self.parent[nodes], out[nodes])
        return out


def measures(tree: Parentheses, words: np.ndarray, ends: np.ndarray, first_id: np.ndarray, aside: dict[str, np.ndarray] | None = None) -> dict[str, np.ndarray]:
    """Per node: conversations, children, leaves, saved tokens and the smallest id, subtrees included.

    ``ends`` and ``first_id`` are of the conversations that end at the node; ``aside`` adds what hangs off a node but is
    not in the tree.
    """
    n = len(tree.opens)
    more = aside or {c: np.zeros(n, np.int64) for c in ("convs", "children", "leaves", "saved")}
    convs = tree.over_subtrees(ends + more["convs"])
    return {
        "convs": convs,
        "children": np.bincount(tree.parent[1:], minlength=n) + more["children"],
        "leaves": tree.leaves(more["children"] == 0) + tree.over_subtrees(more["leaves"]),
        "saved": tree.over_subtrees((convs - 1) * words + more["saved"]),
        "first": tree.least(first_id if aside is None else np.minimum(first_id, more["first"])),
    }


def shared_lengths(elements: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many leading elements each path has in common with the one before it; path i is first[i] to first[i + 1]."""
    lengths = np.diff(first)
    before = np.concatenate([[0], lengths[:-1]])
    shared = np.minimum(lengths, before)
    path = np.repeat(np.arange(len(lengths)), shared)
    k = runs(np.zeros(len(shared), np.int64), shared)
    differs = elements[first[path] + k] != elements[first[np.maximum(path - 1, 0)] + k]
    np.minimum.at(shared, path[differs], k[differs])
    return shared


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(digests of all rows as numbers, equal for equal digests, and the first of each row)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    halves = np.ascontiguousarray(raw).view(np.uint64).reshape(-1, 2)
    pairs = np.empty(len(halves), [("a", np.uint64), ("b", np.uint64)])
    pairs["a"], pairs["b"] = halves[:, 0], halves[:, 1]
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64).reshape(-1), (offsets - offsets[0]) // 16


def _keys(path: bytes) -> list[bytes]:
    """A name for each node on a path, the root first."""
    state = hashlib.md5()
    out = [state.digest()]
    for at in range(0, len(path), 16):
        state.update(path[at:at + 16])
        out.append(state.digest())
    return out


_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_SIDES = ("ends", "first", "convs", "children", "leaves", "saved")
SHARD_SCHEMA = ("kind string, shard int, conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long, n_leaves long, "
                "saved_tokens long, ends_sha256 string, path binary, words array<long>, " + ", ".join(f"{c} array<long>" for c in _SIDES) + ", key binary, ids string")
_SHARD_ARROW = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
                          ("parent_key", pa.binary()), *[(c, pa.int64()) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], ("ends_sha256", pa.string()),
                          ("path", pa.binary()), ("words", pa.list_(pa.int64())), *[(c, pa.list_(pa.int64())) for c in _SIDES], ("key", pa.binary()), ("ids", pa.string())])


def _batch(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _SHARD_ARROW], schema=_SHARD_ARROW)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's finished nodes, its spines, and the ids that end on them; rows come sorted by path and id."""
    table = pa.Table.from_batches([b for b in batches if b.num_rows])
    if not table.num_rows:
        return
    shard = TaskContext.get().partitionId()
    table = table.combine_chunks()
    ids = table.column("conv_id").to_numpy()
    paths = table.column("path").chunk(0)
    elements, first = _flat(paths)
    words = table.column("words").chunk(0).flatten().to_numpy().astype(np.int64)
    lengths, shared = np.diff(first), shared_lengths(elements, first)
    # rows of one path are neighbours, their ids ascending
    new = np.concatenate([[True], ~((lengths[1:] == lengths[:-1]) & (shared[1:] == lengths[1:]))])
    row = np.flatnonzero(new)
    stop = np.append(row[1:], len(ids))
    tree = Parentheses(lengths[row], shared[row])
    n = len(tree.opens)
    fresh = runs(first[row] + shared[row], lengths[row] - shared[row])
    node_words = np.concatenate([[0], words[fresh]])
    ends, first_id = np.zeros(n, np.int64), np.full(n, NONE)
    ends[tree.ends], first_id[tree.ends] = stop - row, ids[row]
    found = measures(tree, node_words, ends, first_id)

    def spine(node: int) -> np.ndarray:
        out = [node]
        while tree.parent[out[-1]] >= 0:
            out.append(int(tree.parent[out[-1]]))
        return np.array(out[::-1])

    left, right = spine(int(tree.ends[0])), spine(int(tree.ends[-1]))
    on_spine = np.zeros(n, bool)
    on_spine[left] = on_spine[right] = True
    inner = np.flatnonzero(~on_spine)
    key_of: dict[int, bytes] = {}
    for nodes, at in ((left, row[0]), (right, row[-1])):
        key_of |= dict(zip(nodes.tolist(), _keys(paths[int(at)].as_py())))

    # ids that end at a node, joined: their digest where the node is finished, the text itself on a spine
    digest = [_EMPTY_SHA] * n
    texts: list[tuple[bytes, str]] = []
    for node, a, b in zip(tree.ends.tolist(), row.tolist(), stop.tolist()):
        joined = ",".join(map(str, ids[a:b].tolist()))
        if on_spine[node]:
            texts.append((key_of[node], joined))
        else:
            digest[node] = hashlib.sha256(joined.encode()).hexdigest()
    parents = tree.parent[inner]
    known = ~on_spine[parents]
    parent_id = pa.array(found["first"][parents], mask=~known)
    parent_key = pa.array([None if k else key_of[p] for p, k in zip(parents.tolist(), known.tolist())], pa.binary())
    for at in range(0, len(inner), 1 << 13):
        part = slice(at, at + (1 << 13))
        nodes = inner[part]
        yield _batch(len(nodes), kind=pa.array(["node"] * len(nodes)), shard=pa.array(np.full(len(nodes), shard, np.int32)), conv_id=pa.array(found["first"][nodes]),
                     depth=pa.array(tree.depth[nodes].astype(np.int64)), parent_conv_id=parent_id[at:at + (1 << 13)], parent_key=parent_key[at:at + (1 << 13)],
                     n_convs=pa.array(found["convs"][nodes]), n_children=pa.array(found["children"][nodes]), n_leaves=pa.array(found["leaves"][nodes]),
                     saved_tokens=pa.array(found["saved"][nodes]), ends_sha256=pa.array([digest[i] for i in nodes.tolist()]))

    # what hangs off the spines
    side = {c: np.zeros(n, np.int64) for c in ("convs", "children", "leaves", "saved")}
    side["ends"], side["first"] = ends, first_id.copy()
    off = inner[on_spine[parents]]
    to = tree.parent[off]
    np.add.at(side["children"], to, 1)
    for c in ("convs", "leaves", "saved"):
        np.add.at(side[c], to, found[c][off])
    np.minimum.at(side["first"], to, found["first"][off])
    listed = pa.list_(pa.int64())
    fork = int((left[:min(len(left), len(right))] == right[:min(len(left), len(right))]).sum())
    for nodes, at, skip in ((left, row[0], 0), (right, row[-1], fork)):
        if skip == len(nodes):
            continue  # one path is the beginning of the other
        own = {}
        for c in _SIDES:
            values = side[c][nodes].copy()
            values[:skip] = NONE if c == "first" else 0
            own[c] = pa.array([values.tolist()], listed)
        yield _batch(1, kind=pa.array(["spine"]), shard=pa.array([shard], pa.int32()), path=pa.array([paths[int(at)].as_py()], pa.binary()),
                     words=pa.array([node_words[nodes].tolist()], listed), **own)
    for key, joined in texts:
        yield _batch(1, kind=pa.array(["ends"]), shard=pa.array([shard], pa.int32()), key=pa.array([key], pa.binary()), ids=pa.array([joined]))


_SPINE_SCHEMA = "key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _merge_spines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of all shards' spines, which form one small trie."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["path"])
    if not rows:
        return
    elements, first = _flat(pa.array([r["path"] for r in rows], pa.binary()))
    lengths, shared = np.diff(first), shared_lengths(elements, first)
    tree = Parentheses(lengths, shared)
    n = len(tree.opens)
    total = {c: np.full(n, NONE) if c == "first" else np.zeros(n, np.int64) for c in _SIDES}
    words, keys = np.zeros(n, np.int64), [b""] * n
    nodes = np.zeros(1, np.int64)  # the nodes on the path of the row before
    for r, same, length, end in zip(rows, shared.tolist(), lengths.tolist(), tree.ends.tolist()):
        nodes = np.concatenate([nodes[:same + 1], np.arange(end - (length - same) + 1, end + 1)])
        for c in _SIDES:
            values = np.array(r[c], np.int64)
            total[c][nodes] = np.minimum(total[c][nodes], values) if c == "first" else total[c][nodes] + values
        words[nodes] = r["words"]
        for node, key in zip(nodes.tolist(), _keys(r["path"])):
            keys[node] = key
    found = measures(tree, words, total["ends"], total["first"], total)
    parent = tree.parent.copy()
    yield pa.RecordBatch.from_pydict({
        "key": pa.array(keys, pa.binary()), "conv_id": pa.array(found["first"]), "depth": pa.array(tree.depth.astype(np.int64)),
        "parent_conv_id": pa.array(found["first"][parent], mask=parent < 0), "n_convs": pa.array(found["convs"]),
        "n_children": pa.array(found["children"].astype(np.int64)), "n_leaves": pa.array(found["leaves"]), "saved_tokens": pa.array(found["saved"])})


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each key of the texts that follow each other; rows come sorted by key and shard."""
    state, now = None, None
    for batch in batches:
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids")):
            if key != now:
                if state is not None:
                    yield pa.RecordBatch.from_pydict({"key": pa.array([now], pa.binary()), "ends_sha256": [state.hexdigest()]})
                state, now = hashlib.sha256(), key
            else:
                state.update(b",")
            state.update(ids.as_py().encode())
    if state is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([now], pa.binary()), "ends_sha256": [state.hexdigest()]})


def prefix_trie(lists: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each distinct sequence of the first d turns of any row of ``lists`` (conv_id, turns), d from 0 on.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the smallest id among the
    conversations that begin so, its parent's, how many there are, childless nodes of its subtree, the words that storing
    each turn once saves in the subtree, and the SHA-256 of the ids, ascending and joined by commas, that end there.

    Ids must be distinct and not null, as ``turn_lists`` makes them. A conversation without turns belongs to the root. An
    empty table gives an empty result. Spines, two for each shard with a value for each turn, are merged in one task; of the
    ids that end on a spine only their text passes through one task, in pieces.
    """
    folder = work_folder(lists.sparkSession)
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t.digest), ""))
    rows = written(lists.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t.words.cast("long")).alias("words")), folder, "paths")
    turns = rows.agg(F.sum(F.size("words") + 1).alias("n")).first()["n"] or 0
    sorted_rows = rows.repartitionByRange(max(1, -(-turns // shard_turns)), "path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = written(map_arrow(sorted_rows, _shard, SHARD_SCHEMA), folder, "shards")
    spines = parts.where("kind = 'spine'").select("path", "words", *_SIDES)
    spine = written(map_arrow(spines.repartition(1), _merge_spines, _SPINE_SCHEMA), folder, "spines")
    texts = parts.where("kind = 'ends'").select("key", "shard", "ids").repartition("key").sortWithinPartitions("key", "shard")
    digests = map_arrow(texts, _end_digests, "key binary, ends_sha256 string")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    spine_rows = spine.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY_SHA))).select(*columns)
    above = spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    inner = parts.where("kind = 'node'").join(above, "parent_key", "left")
    return inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).select(*columns).union(spine_rows)
