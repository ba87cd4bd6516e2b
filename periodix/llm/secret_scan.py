"""Secret scans: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

Two first-order Markov chains over characters are counted from labelled strings, one from random strings and one from
ordinary words. A long run of key characters is a secret when its log-likelihood ratio between the chains, per
transition, reaches a margin. Everything is a DataFrame or SQL function: patterns are found by splitting a text at its
matches, places are running sums of the lengths in between, and a run's score is a sum of looked-up transition weights.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _either_case(words: tuple[str, ...]) -> str:
    """A pattern for any of the words in lower and upper case letters, without the wider folding of a case flag."""
    return "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words)


#: The fixed kinds, in the order in which they are listed; for hex and access keys the shortest length is part of the
#: pattern, which changes nothing because a shorter run holds no match.
ASSIGN = rf"""({_either_case(("password", "passwd", "secret", "token", "api_?key"))})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGNED_LENGTH = 12
KINDS = ("assign", "access", "hex", "markov")

#: Characters of the models, and runs of them that are scored.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
#: Words that count as ordinary, in documents without a fixed secret.
ORDINARY = r"[A-Za-z0-9+/_=-]{4,}"
#: Documents of at most so many ids, by md5 of the id, whose words are labelled ordinary; as many random strings are made.
SAMPLE_IDS = 2000
#: A run is a secret from so many thousandths of a nat a transition on.
MARGIN = 1000

_CHUNK = 64


def _total(part: Column) -> Column:
    return F.aggregate(part, F.lit(0).cast("long"), lambda s, x: s + x)


def with_running_sums(rows: DataFrame, sizes: str, out: str) -> DataFrame:
    """``rows`` with a column ``out``: for each element of the array of longs ``sizes``, the sum of those before it.

    Sums of blocks come first, as a column of their own, so a long array costs little more than its length.
    """
    blocks = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _CHUNK).cast("int"))
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("_sums", F.when(F.size(sizes) > 0, F.transform(
        blocks, lambda b: _total(F.slice(sizes, b * _CHUNK + 1, F.lit(_CHUNK))))).otherwise(none))
    rows = rows.withColumn("_bases", F.transform("_sums", lambda _, b: _total(F.slice("_sums", F.lit(1), b))))
    inside = F.transform("_bases", lambda base, b: F.transform(
        F.slice(sizes, b * _CHUNK + 1, F.lit(_CHUNK)), lambda _, i: base + _total(F.slice(sizes, b * _CHUNK + 1, i))))
    return rows.withColumn(out, F.flatten(inside)).drop("_sums", "_bases")


def _located(rows: DataFrame, kind: str, pattern: str) -> DataFrame:
    """``rows`` with a column ``kind``: every leftmost non-overlapping match in ``text`` as (start, end, value)."""
    hits, gaps, steps, starts = f"_{kind}_hits", f"_{kind}_gaps", f"_{kind}_steps", f"_{kind}_starts"
    rows = rows.withColumn(hits, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    # a text splits into what lies before, between and after its matches
    rows = rows.withColumn(gaps, F.when(F.size(hits) > 0, F.slice(F.split("text", pattern, -1), F.lit(1), F.size(hits)))
                           .otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn(steps, F.zip_with(gaps, hits, lambda g, h: (F.length(g) + F.length(h)).cast("long")))
    rows = with_running_sums(rows, steps, starts)
    before = F.zip_with(starts, gaps, lambda s, g: s + F.length(g))
    places = F.zip_with(before, hits, lambda s, h: F.struct(s.alias("start"), (s + F.length(h)).alias("end"), h.alias("value")))
    return rows.withColumn(kind, places).drop(hits, gaps, steps, starts)


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, assign, access, hex): every match of the fixed kinds as an array of (start, end, value).

    Places are code points, the end exclusive; a null text is empty. Of an assignment the whole match is the span.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)):
        rows = _located(rows, kind, pattern)
    return rows.withColumn("assign", F.filter("assign", lambda s: F.length(F.regexp_extract(s.value, ASSIGN, 2)) >= ASSIGNED_LENGTH))


def labelled_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ids: int = SAMPLE_IDS) -> DataFrame:
    """(value, random): strings to train on.

    Random are the values of the fixed kinds in all documents, and the SHA-256 digests of a bounded sample of ids in base
    64; ordinary are the words of those ids' documents unless a fixed kind occurs in them. The sample is the ``ids`` ids
    of the smallest md5 digests.
    """
    names = docs.select(F.col(id_col).alias("doc_id")).where("doc_id is not null").distinct()
    sampled = names.select("doc_id", F.col("doc_id").cast("string").alias("name")).orderBy(F.md5("name"), "name").limit(ids)
    values = F.concat(F.transform("assign", lambda s: F.regexp_extract(s.value, ASSIGN, 2)), F.transform("access", lambda s: s.value),
                      F.transform("hex", lambda s: s.value))
    fixed = base_spans(docs, id_col, text_col).select(F.explode(values).alias("value"))
    made = sampled.select(F.base64(F.unhex(F.sha2("name", 256))).alias("value"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sampled.select("doc_id")), "doc_id")
    free = (F.size("assign") == 0) & (F.size("access") == 0) & (F.size("hex") == 0)
    words = base_spans(texts).select(F.explode(F.when(free, F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0)))).alias("value"))
    return fixed.union(made).withColumn("random", F.lit(True)).union(words.withColumn("random", F.lit(False)))


def _pairs(chars: Column) -> Column:
    """An array of adjacent characters, as two-character strings."""
    n = F.greatest(F.size(chars) - 1, F.lit(0))
    return F.zip_with(F.slice(chars, F.lit(1), n), F.slice(chars, F.lit(2), n), lambda a, b: F.concat(a, b))


@dataclass(frozen=True)
class Model:
    """Weights of transitions in thousandths of a nat, row by row of the alphabet: the log of their probability among
    random strings over that among ordinary ones."""

    weights: tuple[int, ...]

    def score(self, value: Column) -> Column:
        """The sum of the weights of a string's transitions, a long; characters must be of the alphabet."""
        table = F.split(F.lit(",".join(map(str, self.weights))), ",").cast("array<int>")
        chars = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
        n = F.greatest(F.size(chars) - 1, F.lit(0))
        steps = F.zip_with(F.slice(chars, F.lit(1), n), F.slice(chars, F.lit(2), n), lambda a, b: F.get(table, a * len(ALPHABET) + b))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)


def train(strings: DataFrame, value_col: str = "value", random_col: str = "random") -> Model:
    """The two chains of ``strings``, each count one more than seen, as transition weights.

    Counting is one aggregate; at most two counts for each pair of characters reach the driver. Null strings and labels
    and characters outside the alphabet are left out; without any strings all weights are 0, so nothing is a secret.
    """
    rows = strings.select(F.col(value_col).alias("value"), F.col(random_col).cast("boolean").alias("random")).where("random is not null")
    rows = rows.select("random", F.explode(_pairs(F.split("value", ""))).alias("pair")).groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n"))
    size = len(ALPHABET)
    counts = {True: [[1] * size for _ in ALPHABET], False: [[1] * size for _ in ALPHABET]}
    for r in rows.collect():
        if r["pair"][0] in ALPHABET and r["pair"][1] in ALPHABET:
            counts[r["random"]][ALPHABET.index(r["pair"][0])][ALPHABET.index(r["pair"][1])] += r["n"]
    weights = []
    for yes, no in zip(counts[True], counts[False]):
        yes_all, no_all = sum(yes), sum(no)
        weights += [round(1000 * (math.log(y / yes_all) - math.log(n / no_all))) for y, n in zip(yes, no)]
    return Model(tuple(weights))


def find_secrets(base: DataFrame, model: Model, margin: int = MARGIN) -> DataFrame:
    """(doc_id, spans): all secrets of every row of ``base_spans``, by start, then kind as listed.

    A span is (start, rank, end, kind, value), places in code points, the end exclusive. The fixed kinds stay as they are;
    the models add runs of 20 or more key characters that overlap none of them and score ``margin`` or more a transition.
    """
    rows = _located(base, "markov", RUN)
    near = F.concat("assign", "access", "hex")
    rows = rows.withColumn("markov", F.when(F.size("markov") > 0, F.filter(
        "markov", lambda m: ~F.exists(near, lambda s: (s.start < m.end) & (m.start < s.end))
        & (model.score(m.value) >= margin * (m.end - m.start - 1)))).otherwise(F.col("markov")))

    def ranked(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s.start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s.end.alias("end"),
                                                    F.lit(kind).alias("kind"), s.value.alias("value")))

    return rows.select("doc_id", F.array_sort(F.concat(*map(ranked, KINDS))).alias("spans"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ids: int = SAMPLE_IDS, margin: int = MARGIN) -> DataFrame:
    """(doc_id, spans) as ``find_secrets`` gives them, with models trained from the documents themselves.

    One row per input row. Null and empty texts have no secrets; null and repeated ids are kept row by row; an empty table
    gives an empty result; other columns are ignored.
    """
    base = base_spans(docs, id_col, text_col)
    return find_secrets(base, train(labelled_strings(docs, id_col, text_col, ids)), margin)
