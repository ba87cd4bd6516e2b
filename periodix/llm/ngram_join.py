"""N-gram Jaccard join by count vectors in an R-tree.

A document is the set of its distinct word shingles. Its shingles are hashed into groups; the counts by group are a
point, and the overlap of two documents is at most the sum of their points' coordinate minima. Points are packed
into an R-tree whose nodes keep coordinate maxima, so the same sum bounds a whole node; pairs that survive are
verified on the sets themselves.

At thresholds near 1 all documents of a size have nearly the same counts, so one tree over all points would compare
every document with every other of its size. Documents are therefore first routed to families, exactly: of the
groups of a size class, at most D can differ between two linked documents, so with more than D non-empty groups some
group holds the same shingles in both. Each family is one tree, or several when it is large.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from periodix.llm.text import NOT_SPACE, lower_ascii, mix, ngram_hashes, rows_of, runs, slices, word_hashes, word_spans
from periodix.llm.work import components, map_arrow, repeated_ids, work_folder, written

#: Shingles, and documents, that one tree holds on average at most; a family beyond that has several.
TREE_SHINGLES = 3_000_000
TREE_DOCS = 8000
#: Points of a leaf node.
NODE = 16
#: Documents of a key beyond which it counts as equally frequent.
FREQUENT = 1000
#: One group more for so many of those that may differ, so that weak ones need not be keys.
SPARE = 4


@dataclass(frozen=True)
class Jaccard:
    """Shingles of ``words`` words; sets link when 100 * intersection >= ``percent`` * union."""

    words: int = 5
    percent: int = 80

    def overlap(self, total):
        """The least intersection of two linked sets whose sizes add up to ``total``."""
        return -(-self.percent * total // (100 + self.percent))

    def largest_partner(self, size):
        return 100 * size // self.percent

    def differ(self, total):
        """The most shingles that are in only one of two linked sets whose sizes add up to ``total``."""
        return total * (100 - self.percent) // (100 + self.percent)

    def classes(self, largest: int) -> list[tuple[int, int, int]]:
        """Size classes (smallest size, largest size, number of groups) that cover 1 to ``largest``.

        A set's larger partners are in its own class or the next.
        """
        ratio = max(2.0, 100 / self.percent)
        out, low = [], 1
        while low <= largest:
            high = max(low + 1, int(low * ratio)) - 1
            most = self.differ(2 * high)
            out.append((low, high, 1 + most + most // SPARE))
            low = high + 1
        return out


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, shingle hashes, first shingle of each text): distinct, sorted within each text.

    A text of fewer than k words, but not none, has its whole sequence as its one shingle.
    """
    for first, end, raw, offsets in slices(texts):
        raw = lower_ascii(raw)
        starts, ends, first_word = word_spans(raw, offsets, NOT_SPACE)
        words = word_hashes(raw, starts, ends)
        h, whole = ngram_hashes(words, first_word, k)
        row = rows_of(first_word)
        count = np.diff(first_word)
        short = np.flatnonzero((count > 0) & (count < k))
        row, h = row[whole], mix(h[whole])
        if len(short):
            extra = np.zeros(len(short), np.uint64)
            for i, r in enumerate(short):
                for w in words[first_word[r]:first_word[r + 1]]:
                    extra[i:i + 1] = mix(extra[i:i + 1] * np.uint64(0x9E3779B97F4A7C15) + w + np.uint64(1))
            row, h = np.concatenate([row, short]), np.concatenate([h, extra])
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        row, h = row[new], h[new]
        yield first, end, h, np.searchsorted(row, np.arange(end - first + 1))


def _group_of(h: np.ndarray, groups: np.ndarray | int) -> np.ndarray:
    """The group of each shingle hash, of so many."""
    return ((mix(h ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)


def routes(h: np.ndarray, first: np.ndarray, rule: Jaccard) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, code): keys, of which two rows whose sets differ but link have some in common.

    A key is the content of one group of a size class. If at most D groups of a set differ from a partner's, its
    heaviest D + 1 + s keys hold s + 1 common ones, since both order their groups alike; s of them may then be left
    out, and ``rarest_keys`` leaves out the most frequent. A set that fills too few groups of a class for that has
    all its groups as keys, and as many of its smallest shingles as any linked set must share one of.
    ``code`` is twice the number of keys that may be left out, plus 1 for keys of the next larger class.
    """
    size = np.diff(first)
    classes = rule.classes(int(size.max(initial=0)) * 2 + 1)
    own = np.searchsorted(np.array([c[0] for c in classes]), size, "right") - 1
    rows, keys, codes = [], [], []
    for number, (low, high, groups) in enumerate(classes):
        partner = np.minimum(rule.largest_partner(size), high)
        differ = rule.differ(size + partner)  # equal sets are one already, so none need be found where this is 0
        member = np.flatnonzero((size > 0) & ((own == number) | (own == number - 1) & (partner >= low)) & (differ > 0))
        if not len(member):
            continue
        row, mine = np.repeat(member, size[member]), h[runs(first[member], size[member])]
        place = row.astype(np.uint64) * np.uint64(groups) + _group_of(mine, groups)
        order = np.argsort(place, kind="stable")
        place = place[order]
        start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        content = np.add.reduceat(mix(mine[order] + np.uint64(number)), start)
        group_row = (place[start] // np.uint64(groups)).astype(np.int64)
        weight = np.diff(np.concatenate([start, [len(place)]]))
        key = mix(content + mix((place[start] % np.uint64(groups)) * np.uint64(4096) + np.uint64(number)))
        filled = np.bincount(group_row, minlength=len(size))
        most = rule.differ(2 * high)
        spare = np.clip(filled - differ - 1, 0, 4 + most // 8)
        order = np.lexsort((key, -weight, group_row))
        rank = np.arange(len(order)) - (np.cumsum(filled) - filled)[group_row[order]]
        chosen = order[rank <= (differ + spare)[group_row[order]]]
        code = 2 * spare + (own < number)
        rows.append(group_row[chosen])
        keys.append(key[chosen])
        codes.append(code[group_row[chosen]])
        for r in member[filled[member] <= differ[member]]:
            prefix = int(size[r]) - -(-rule.percent * int(size[r]) // 100) + 1
            rows.append(np.full(prefix, r))
            keys.append(mix(h[first[r]:first[r] + prefix] ^ np.uint64((0xABCDEF << 12) + number)))
            codes.append(np.full(prefix, code[r]))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(codes)


def _sizes(rule: Jaccard, keys: bool):
    """Each text's size and a 128-bit digest of its set, with or without the keys of ``routes``."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, h, start in shingle_sets(batch.column("body"), rule.words):
                n = end - first
                total = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (mix(h), mix(h ^ np.uint64(0xD1B54A32D192ED03)))]
                a, b = ((t[start[1:]] - t[start[:-1]]).view(np.int64) for t in total)
                out = {"doc_id": batch.column("doc_id").slice(first, n), "n": pa.array(np.diff(start), pa.int64()), "set_a": pa.array(a), "set_b": pa.array(b)}
                if not keys:
                    yield pa.RecordBatch.from_pydict(out)
                    continue
                row, key, code = routes(h, start, rule)
                order = np.argsort(row, kind="stable")
                items = pa.StructArray.from_arrays([pa.array(key[order].view(np.int64)), pa.array(code[order], pa.int32())], ["key", "code"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[order], np.arange(n + 1)).astype(np.int32)), items)
                yield pa.RecordBatch.from_pydict(out | {"routes": lists})
    return sketch


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (key, doc_id): the rows of keys that several ids have, with how many, at most FREQUENT.

    A partition's first and last keys may go on in another one; they count as FREQUENT in each.
    """
    def out(ids, key, code, count) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(key, pa.int64()), pa.array(code, pa.int32()),
                                           pa.array(np.broadcast_to(count, len(ids)), pa.int32())], ["doc_id", "key", "code", "count"])

    held: list[tuple[np.ndarray, np.ndarray]] = []  # ids and codes of the key that may go on
    held_key, seen, border = None, 0, True
    for batch in batches:
        ids, key, code = (batch.column(c).to_numpy() for c in ("doc_id", "key", "code"))
        if not len(key):
            continue
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        if held_key is not None and key[0] != held_key:
            if border or seen > 1:
                for i, c in held:
                    yield out(i, np.full(len(i), held_key), c, FREQUENT if border else min(seen, FREQUENT))
            held, held_key, seen, border = [], None, 0, False
        stop = begin[1] if len(begin) > 1 else len(key)
        if held_key is None and len(begin) > 1 and not border:
            stop = 0  # the first key is whole in this batch
        if stop:
            held.append((ids[:stop], code[:stop]))
            held_key, seen = key[0], seen + stop
            if len(begin) > 1:
                if border or seen > 1:
                    for i, c in held:
                        yield out(i, np.full(len(i), held_key), c, FREQUENT if border else min(seen, FREQUENT))
                held, held_key, seen, border = [], None, 0, False
        if len(begin) > 1:
            inner = begin[(begin >= stop) & (begin < begin[-1])]
            length = np.diff(np.concatenate([inner, begin[-1:]]))
            many = np.repeat(length > 1, length)
            at = np.flatnonzero(many) + stop
            yield out(ids[at], key[at], code[at], np.minimum(np.repeat(length, length)[many], FREQUENT))
            held, held_key, seen = [(ids[begin[-1]:], code[begin[-1]:])], key[-1], len(key) - begin[-1]
        if seen >= FREQUENT:  # its count is settled, so its rows need not wait
            for i, c in held:
                yield out(i, np.full(len(i), held_key), c, FREQUENT)
            held = []
    for i, c in held:
        yield out(i, np.full(len(i), held_key), c, FREQUENT)


def rarest_keys(shared: DataFrame) -> DataFrame:
    """Of each document's shared keys, all but the most frequent ones that ``routes`` lets go."""
    part = Window.partitionBy("doc_id", F.col("code") % 2).orderBy(F.desc("count"), F.desc("key"))
    return shared.withColumn("rank", F.row_number().over(part)).where(F.col("rank") > F.floor(F.col("code") / 2)).select("key", "doc_id")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, id): an edge from each id of a key to the key's first id here.

    A key may go on in the next partition. The partition's first and last keys are therefore reported too (``key``
    set), with their first ids here.
    """
    key_now, head = None, 0

    def out(a: np.ndarray, b: np.ndarray, key: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "key": pa.array(key, pa.int64())})

    for batch in batches:
        key, ids = batch.column("key").to_numpy(), batch.column("doc_id").to_numpy()
        if not len(key):
            continue
        begin = np.flatnonzero(np.concatenate([[key_now is None or key[0] != key_now], key[1:] != key[:-1]]))
        if key_now is None:
            yield out(ids[:1], ids[:1], [int(key[0])])
        run = np.searchsorted(begin, np.arange(len(key)), "right") - 1
        heads = np.concatenate([ids[begin], [head]])[run]  # run -1: the key of the batch before
        edge = ids != heads
        yield out(ids[edge], heads[edge], [None] * int(edge.sum()))
        key_now, head = int(key[-1]), int(heads[-1])
    if key_now is not None:
        yield out([head], [head], [key_now])


def near_stars(edges: DataFrame) -> DataFrame:
    """The components of ``edges`` (a, b), a >= b, with fewer edges: each a is joined with its smallest b alone, and that one
    with the other b.

    Documents of one large family have many heads between them, the same ones over and over; so their edges become one for
    each document and few between heads. A document has no more heads than keys.
    """
    heads = edges.groupBy("a").agg(F.collect_set("b").alias("heads")).select("a", F.array_min("heads").alias("b"), "heads")
    return heads.select("a", "b").union(heads.select(F.explode("heads").alias("a"), "b")).distinct()


class _Forest:
    """Labels of what is linked so far."""

    def __init__(self, labels: np.ndarray):
        self.label = np.unique(labels, return_inverse=True)[1]

    def merge(self, i: int, others: np.ndarray) -> None:
        old = np.unique(self.label[others])
        self.label[np.isin(self.label, old)] = self.label[i]


class CountTree:
    """A packed R-tree over the count vectors of sets: points sorted by size, then by coordinates, cut into nodes."""

    def __init__(self, sets: list[np.ndarray], rule: Jaccard):
        self.rule = rule
        size = np.array([len(s) for s in sets])
        # about half as many groups as a set has shingles, so that points take no more room than the sets
        self.groups = 1 << int(np.clip(np.ceil(np.log2(size.mean() / 2)), 5, 12))
        points = np.zeros((len(sets), self.groups), np.int32)
        first = np.concatenate([[0], np.cumsum(size)])
        flat = np.concatenate(sets)
        np.add.at(points, (rows_of(first), _group_of(flat, self.groups).astype(np.int64)), 1)
        self.order = np.lexsort((*points[:, :3].T[::-1], size))
        self.points, self.size = points[self.order], size[self.order]
        self.sets = [sets[i] for i in self.order]
        self.node = np.arange(0, len(sets), NODE)
        self.top = np.maximum.reduceat(self.points, self.node)  # coordinate maxima of each node
        self.low = self.size[self.node]
        self.high = np.maximum.reduceat(self.size, self.node)

    def linked(self, i: int, point: np.ndarray, shingles: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Points, but those to ``skip`` and those before ``i``, whose sets link with the given one."""
        n = len(shingles)
        near = (self.high * 100 >= self.rule.percent * n) & (self.low * self.rule.percent <= 100 * n)
        near &= self.node + NODE > i
        near = np.flatnonzero(near)
        bound = np.minimum(self.top[near], point).sum(axis=1)
        near = near[bound >= self.rule.overlap(n + self.low[near])]
        at = (self.node[near][:, None] + np.arange(NODE)).ravel()
        at = at[(at >= i) & (at < len(self.size))]
        at = at[~skip[at]]
        need = self.rule.overlap(n + self.size[at])
        at = at[np.minimum(self.points[at], point).sum(axis=1) >= need]
        if not len(at):
            return at
        first = np.concatenate([[0], np.cumsum(self.size[at])])
        flat = np.concatenate([self.sets[j] for j in at])
        found = np.minimum(np.searchsorted(shingles, flat), n - 1)
        both = np.add.reduceat((shingles[found] == flat).astype(np.int64), first[:-1])
        return at[both >= self.rule.overlap(n + self.size[at])]


def spanning_links(sets: list[np.ndarray], labels: np.ndarray, probes: np.ndarray, rule: Jaccard) -> Iterator[tuple[int, int]]:
    """Links that join all that is linked among ``sets``, some having one label already.

    Each marked probe is looked up in the tree of all sets; what is joined already is not looked at again.
    """
    tree = CountTree(sets, rule)
    forest = _Forest(labels[tree.order])
    probe = probes[tree.order]
    every = bool(probe.all())
    for i in range(len(sets)):
        if not probe[i]:
            continue
        skip = forest.label == forest.label[i]
        if skip.all():
            return
        # when all probe all, earlier points have met this one
        found = tree.linked(i + 1 if every else 0, tree.points[i], tree.sets[i], skip)
        if len(found):
            for j in found[np.unique(forest.label[found], return_index=True)[1]]:  # one of what is joined already
                yield int(tree.order[i]), int(tree.order[j])
            forest.merge(i, found)


def _verified(rule: Jaccard):
    """Over rows sorted by ``tree``: spanning links within each tree."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks()
            ids = rows.column("doc_id").to_numpy()
            sets = []
            for _, _, h, first in shingle_sets(rows.column("body").combine_chunks(), rule.words):
                sets += [h[a:b] for a, b in zip(first, first[1:])]
            some = np.flatnonzero([len(s) > 0 for s in sets])  # an id may come back with an empty text too
            sets, ids = [sets[i] for i in some], ids[some]
            label, probe = (rows.column(c).to_numpy(zero_copy_only=False)[some] for c in ("label", "probe"))
            pairs = list(spanning_links(sets, label, probe, rule)) if sets else []
            a, b = (ids[[p[k] for p in pairs]] if pairs else np.zeros(0, np.int64) for k in (0, 1))
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        held: list[pa.RecordBatch] = []
        for batch in batches:
            tree = batch.column("tree").to_numpy()
            cuts = [0, *(np.flatnonzero(tree[1:] != tree[:-1]) + 1), len(tree)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and held[0].column("tree")[0].as_py() != int(tree[a]):
                    yield flush(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield flush(held)
    return links


def _links_within(members: DataFrame, rule: Jaccard) -> DataFrame:
    """Spanning links of the trees that ``members`` (doc_id, tree, label, probe, body) form."""
    rows = members.select("doc_id", "tree", "label", "probe", "body")
    return map_arrow(rows.repartition("tree").sortWithinPartitions("tree", "doc_id"), _verified(rule), "a long, b long")


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Jaccard = Jaccard()) -> DataFrame:
    """Classes of documents connected by links: (doc_id, n_shingles, component_id), one row per input row.

    Words are runs of anything but ASCII white space, A-Z lower-cased; whole texts count. Linked are sets with
    100 * intersection >= percent * union; component_id is the smallest id reachable. Documents with equal sets are
    one point, so copies are never paired; within a family only links that join something are produced, so the output
    is linear however large a family is, and no link between different sets is lost.

    Null and empty texts have no shingles and stay alone. Rows with a null id get a null component. Rows repeated with
    one id share that id's component (the smallest, if its texts fall into several). Empty tables give an empty
    result; other columns are ignored. Ids must be integers.
    """
    folder = work_folder(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body"))
    schema = "doc_id long, n long, set_a long, set_b long"
    real = map_arrow(rows, _sizes(rule, True), schema + ", routes array<struct<key:long,code:int>>").where("n > 0 and doc_id is not null")
    # one document stands for all that have its set; copies combine before the shuffle
    sets = written(real.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.min_by("routes", "doc_id").alias("routes")),
                   folder, "sets")
    routed = sets.select(F.col("rep").alias("doc_id"), F.inline("routes"))
    shared = written(map_arrow(routed.orderBy("key", "doc_id"), _counted, "doc_id long, key long, code int, count int"), folder, "shared")
    kept = written(rarest_keys(shared), folder, "keys")
    stars = written(map_arrow(kept.orderBy("key", "doc_id"), _stars, "a long, b long, key long"), folder, "stars")
    joints = stars.where("key is not null").select("key", "a")
    joints = joints.join(joints.groupBy("key").agg(F.min("a").alias("b")), "key").select("a", "b")
    near = written(near_stars(stars.where("key is null").select("a", "b").union(joints)), folder, "near")
    family = components(near, folder, "family")
    family = written(family.join(sets.select(F.col("rep").alias("id"), "n"), "id").select(F.col("id").alias("doc_id"), F.col("component").alias("family"), "n"),
                     folder, "families")
    links = _family_links(family, rows.where("doc_id is not null"), rule, folder)
    joined = components(links, folder, "links")
    same = sets.select("set_a", "set_b", "rep").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    same = written(same.select("set_a", "set_b", F.coalesce("component", "rep").alias("component_id")), folder, "classes")
    sizes = written(map_arrow(rows, _sizes(rule, False), schema), folder, "sizes")
    found = sizes.join(same, ["set_a", "set_b"], "left")
    alone = F.col("n").eqNullSafe(0) | F.col("doc_id").isNull()
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _family_links(family: DataFrame, docs: DataFrame, rule: Jaccard, folder: str) -> DataFrame:
    """Spanning links of every family.

    A small family is one tree. A large one is dealt to several by hash; what the trees join is then compared by one
    head each, and whatever is still apart exhaustively: each of its documents against the whole family.
    """
    weight = family.groupBy("family").agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("docs"))
    trees = F.greatest(F.ceil(F.col("shingles") / TREE_SHINGLES), F.ceil(F.col("docs") / TREE_DOCS)).cast("int")
    weight = written(weight.select("family", trees.alias("trees")), folder, "weights")
    tree = F.xxhash64("family", F.pmod(F.xxhash64("doc_id"), F.col("trees")))
    dealt = written(family.join(weight, "family").select("doc_id", "family", "n", "trees", tree.alias("tree")), folder, "dealt")
    # texts are shuffled once, whatever the size of the families; those of members are kept
    members = dealt.select("doc_id", "tree", F.col("doc_id").alias("label"), F.lit(True).alias("probe")).hint("merge").join(docs, "doc_id")
    members = written(members, folder, "members")
    links = written(_links_within(members, rule), folder, "verified")
    texts = members.select("doc_id", "body")

    large = dealt.where("trees > 1")
    for turn in ("heads", "rest"):
        if large.isEmpty():
            break
        label = components(links, folder, f"joined-{turn}").withColumnRenamed("id", "doc_id")
        now = large.select("doc_id", "family", "n", "trees").join(label, "doc_id", "left").withColumn("label", F.coalesce("component", "doc_id")).drop("component")
        now = written(now, folder, f"labelled-{turn}")
        parts = now.groupBy("family", "label").agg(F.count(F.lit(1)).alias("docs"))
        open_ = parts.groupBy("family").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("docs", "label")).alias("main"))
        open_ = written(open_.where("parts > 1").select("family", F.col("main.label").alias("main")), folder, f"open-{turn}")
        large = now.join(open_, "family")
        if turn == "heads":
            heads = large.where("doc_id = label")
            size = heads.groupBy("family").agg(F.greatest(F.ceil(F.sum("n") / TREE_SHINGLES), F.ceil(F.count(F.lit(1)) / TREE_DOCS)).cast("int").alias("head_trees"))
            heads = heads.join(size, "family")
            tree = F.xxhash64("family", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("head_trees")))
            step = heads.select("doc_id", tree.alias("tree"), "label", F.lit(True).alias("probe"))
        else:
            apart = large.where("label <> main")
            blocks = apart.groupBy("family").agg(F.greatest(F.ceil(F.sum("n") / TREE_SHINGLES), F.ceil(F.count(F.lit(1)) / TREE_DOCS)).cast("int").alias("blocks"))
            large = large.join(blocks, "family")
            block, leaf = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("blocks")), F.pmod(F.xxhash64("doc_id"), F.col("trees"))
            each = lambda many, name: F.explode(F.sequence(F.lit(0), F.col(many) - 1)).alias(name)
            probes = large.where("label <> main").select("doc_id", "family", "label", block.alias("block"), each("trees", "leaf"), F.lit(True).alias("probe"))
            targets = large.select("doc_id", "family", "label", each("blocks", "block"), leaf.alias("leaf"), F.lit(False).alias("probe"))
            step = probes.union(targets.select(*probes.columns)).groupBy("doc_id", "family", "label", "block", "leaf").agg(F.max("probe").alias("probe"))
            step = step.select("doc_id", F.xxhash64("family", "block", "leaf").alias("tree"), "label", "probe")
        links = written(links.union(_links_within(step.join(texts, "doc_id"), rule)), folder, f"verified-{turn}")
    return links


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Jaccard = Jaccard()) -> DataFrame:
    """One row of ``docs`` for each class of similar sets, of those with the smallest id; all columns stay as they are.

    Rows are told apart by id and text: texts of ids that occur more than once, and of null ids, get numbers of their own
    beyond the largest id, so texts that share an id are judged on their own. Of a row repeated with id and text one stays,
    a null id counts as larger than any other, and rows without words all stay. An empty table gives an empty result.
    """
    folder = work_folder(docs.sparkSession)
    key = F.col(f"`{id_col}`").cast("long")
    repeated = written(repeated_ids(docs, id_col), folder, "repeated")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, key.alias("doc_id"), F.col(f"`{text_col}`").alias("body")).withColumn("node", F.col("doc_id"))
    several = not repeated.isEmpty()
    if several:
        digest = F.md5(F.coalesce("body", F.lit("")))
        texts = rows.join(repeated.withColumnRenamed("doc_id", "again"), F.col("doc_id").eqNullSafe(F.col("again")))
        texts = texts.select("again", digest.alias("digest")).distinct()
        most = docs.agg(F.max(key).alias("most")).first()["most"] or 0
        named = written(texts.withColumn("own", F.monotonically_increasing_id() + F.lit(most + 1)), folder, "named")
        rows = rows.join(named, F.col("doc_id").eqNullSafe(F.col("again")) & (digest == F.col("digest")), "left")
        rows = rows.select("row", "doc_id", "body", F.coalesce("own", "doc_id").alias("node"), F.col("own").isNotNull().alias("again"))
    found = similar_sets(rows, "node", "body", rule).where("n_shingles > 0")
    if not several:  # a component's number is its smallest id
        dropped = written(found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct(), folder, "dropped")
        kept = rows.join(dropped, F.col("node") == F.col("gone"), "left_anti")
    else:
        ids = named.select(F.col("again").alias("real"), F.col("own").alias("doc_id"))
        nodes = found.select("doc_id", "component_id").distinct().join(ids, "doc_id", "left")
        real = F.when(F.col("doc_id") <= F.lit(most), F.col("doc_id")).otherwise(F.col("real"))
        nodes = written(nodes.select("component_id", F.struct(real.isNull().alias("none"), real.alias("real"), F.col("doc_id").alias("node")).alias("name")), folder, "nodes")
        best = nodes.groupBy("component_id").agg(F.min("name").alias("best"))
        dropped = nodes.join(best, "component_id").where("name <> best").select(F.col("name.node").alias("gone"))
        kept = rows.join(written(dropped, folder, "dropped"), F.col("node") == F.col("gone"), "left_anti")
        worded = F.regexp_count(F.coalesce("body", F.lit("")), F.lit(r"[^\x20\x09-\x0D]")) > 0
        kept = written(kept, folder, "kept")  # read twice
        kept = kept.where(~(F.col("again") & worded)).unionAll(kept.where(F.col("again") & worded).dropDuplicates(["node"]))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
