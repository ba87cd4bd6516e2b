"""Counterfactually regularised toxicity classifier: a sparse linear model over the words and word beginnings of a text.

Besides fitting the labels, training swaps identity terms in the labelled sentences for other terms and penalises
any change of score, so a sentence scores alike whichever group it mentions. Terms come from the caller's list and, where
a corpus hardly mentions those, from its own frequent words that go with neither label.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodix.llm.sample import labelled
from periodix.llm.text import ALNUM, lower_ascii, rows_of, slices, word_hashes, word_spans
from periodix.llm.work import map_arrow, work_folder, written

#: Identity terms by group; a term is swapped for the others of its group and for the neutral ones.
IDENTITY_TERMS = {
    "gender": ["woman", "man", "women", "men", "girl", "boy", "female", "male", "transgender", "nonbinary"],
    "orientation": ["gay", "lesbian", "bisexual", "straight", "queer", "heterosexual"],
    "religion": ["muslim", "jewish", "christian", "hindu", "buddhist", "sikh", "atheist", "catholic"],
    "origin": ["african", "asian", "european", "american", "mexican", "arab", "immigrant", "refugee"],
    "colour": ["black", "white", "brown"],
    "ability": ["disabled", "deaf", "blind", "autistic"],
    "age": ["old", "young", "elderly", "teenage"],
}
NEUTRAL_TERMS = ["person", "people"]

#: Labelled documents that are fitted at most, in hash order of their ids.
FIT_ROWS = 16000
#: Swap sets taken from the corpus at most, and words of each: neighbours in frequency whose shares of toxic and of clean
#: documents differ by less than two standard errors, in at least this share of the fitted documents.
CORPUS_SETS, SET_WORDS, SET_SHARE = 16, 4, 0.01
#: Sentences whose terms are swapped at most, in hash order: a bound on labelled rows, like FIT_ROWS.
FIT_SENTENCES = 4000
#: Bytes of a word's beginning, and the share of a text's words from which on a beginning counts fully.
STEM_BYTES, STEM_SHARE = 5, 1 / 32
#: The bound on weights, and how often features may join the fit at most; few times are needed.
L1, TURNS = 1e-3, 12


@dataclass
class ToxicityModel:
    """Weights of features (sorted by hash) and a bias; ``pairs`` is how many swaps the penalty saw."""

    words: np.ndarray
    weights: np.ndarray
    bias: float
    pairs: int = 0

    def margins(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Sums of weight times value of each row's features, plus the bias."""
        out = np.full(n, self.bias)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, feature), len(self.words) - 1)
            known = self.words[at] == feature
            np.add.at(out, row[known], self.weights[at[known]] * value[known])
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """An even hash of each word."""
    return word_hashes(raw, starts, ends) & ~np.uint64(1)


def _stems(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """An odd hash of the first bytes of each word."""
    return word_hashes(raw, starts, np.minimum(ends, starts + STEM_BYTES)) | np.uint64(1)


def features_of(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, row, feature, value) for slices of texts, each feature of a row once.

    A word has the value 1; a beginning grows with its share of the text's words up to 1, in steps of 1/64, so that sums of
    values are exact.
    """
    for first, end, raw, offsets in slices(texts):
        raw = lower_ascii(raw)
        starts, ends, first_word = word_spans(raw, offsets, ALNUM)
        row = rows_of(first_word)
        word, stem = (_distinct(row, h) for h in (_words(raw, starts, ends), _stems(raw, starts, ends)))
        share = stem[2] / np.maximum(1, np.diff(first_word))[stem[0]]
        value = np.ceil(np.minimum(1, share / STEM_SHARE) * 64) / 64
        yield (first, end, np.concatenate([word[0], stem[0]]), np.concatenate([word[1], stem[1]]),
               np.concatenate([np.ones(len(word[0])), value]))


def _distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of each hash of a row, once."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, bool))
    return row[new], h[new], np.diff(np.append(new, len(h)))


def _hash_of(terms: list[str]) -> dict[str, tuple[int, int]]:
    """The features of a term: its word and its beginning."""
    out = {}
    for t in terms:
        raw = lower_ascii(np.frombuffer(t.encode(), np.uint8))
        a, b = np.zeros(1, np.int64), np.array([len(raw)])
        out[t] = int(_words(raw, a, b)[0]), int(_stems(raw, a, b)[0])
    return out


def _pulls(words: np.ndarray, weights: np.ndarray, bias: float, amount: tuple[float, float]):
    """Per batch and feature: how much there is of it in toxic and in clean texts, and the slope of the loss of a model."""
    def pulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ToxicityModel(words, weights, bias)
        for batch in batches:
            labels = batch.column("label").to_numpy()
            for first, end, row, feature, value in features_of(batch.column("text")):
                y = labels[first:end]
                error = np.where(y == 1, amount[1], amount[0]) * (sigmoid(model.margins(row, feature, value, end - first)) - y)
                known, at = np.unique(feature, return_inverse=True)
                at = at.reshape(-1)
                sums = [np.bincount(at, x, len(known)).astype(float) for x in (value * (y[row] == 1), value * (y[row] == 0), value * error[row])]
                yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), *map(pa.array, sums)], ["feature", "toxic", "clean", "slope"])
    return pulls


def _examples(kept: np.ndarray):
    """Each labelled text's features among ``kept``, and their values."""
    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, row, feature, value in features_of(batch.column("text")):
                ok = kept[np.minimum(np.searchsorted(kept, feature), len(kept) - 1)] == feature if len(kept) else np.zeros(len(row), bool)
                order = np.flatnonzero(ok)[np.lexsort((feature[ok], row[ok]))]
                bounds = pa.array(np.searchsorted(row[order], np.arange(end - first + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(first, end - first), pa.ListArray.from_arrays(bounds, pa.array(feature[order].view(np.int64))),
                     pa.ListArray.from_arrays(bounds, pa.array(value[order].astype(float)))], ["label", "features", "amounts"])
    return examples


#: Words on each side of a term that count as its sentence at most.
SENTENCE_WORDS = 40


def _with_terms(terms: np.ndarray):
    """The word hashes around each term in a text, up to the ends of its sentence."""
    def sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, offsets in slices(batch.column("text")):
                raw = lower_ascii(raw)
                starts, ends, first_word = word_spans(raw, offsets, ALNUM)
                h, text = _words(raw, starts, ends), rows_of(first_word)
                breaks = np.cumsum(np.isin(raw, np.frombuffer(b".!?\n", np.uint8)))
                sentence = breaks[starts] if len(starts) else starts
                found = []
                for at in np.flatnonzero(np.isin(h, terms)).tolist():
                    a, b = max(first_word[text[at]], at - SENTENCE_WORDS), min(first_word[text[at] + 1], at + SENTENCE_WORDS + 1)
                    found.append(np.unique(h[a:b][sentence[a:b] == sentence[at]]).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64()))], ["words"])
    return sentences


def _sentences(rows: DataFrame, terms: np.ndarray) -> list[np.ndarray]:
    """At most ``FIT_SENTENCES`` different sentences with a term, in hash order."""
    found = map_arrow(rows.select("text"), _with_terms(terms), "words array<long>").distinct()
    found = found.orderBy(F.xxhash64("words"), "words").limit(FIT_SENTENCES).toArrow().column("words")
    return [np.array(s, np.int64).view(np.uint64) for s in found.to_pylist()]


def swap_sets(totals: list[tuple[int, float, float]], toxic: int, clean: int, terms: dict[str, list[str]],
              neutral: list[str] = NEUTRAL_TERMS) -> list[list[tuple[int, int]]]:
    """Sets of (word, beginning) features that are swapped for each other: the caller's groups, each with the neutral terms,
    and sets of frequent words (feature, toxic documents, clean documents) that go with neither label."""
    of = _hash_of([t for group in terms.values() for t in group] + list(neutral))
    sets = [[of[t] for t in [*group, *neutral]] for group in terms.values()]
    known = {w for group in sets for w, _ in group}
    even = []
    for feature, a, b in totals:
        share = (a + b) / max(1, toxic + clean)
        error = np.sqrt(share * (1 - share) * (1 / max(1, toxic) + 1 / max(1, clean)))
        if feature % 2 == 0 and share >= SET_SHARE and feature not in known and abs(a / max(1, toxic) - b / max(1, clean)) < 2 * error:
            even.append((-(a + b), feature))
    even.sort()
    for k in range(0, min(len(even), CORPUS_SETS * SET_WORDS) - SET_WORDS + 1, SET_WORDS):
        sets.append([(feature, 0) for _, feature in even[k:k + SET_WORDS]])
    return sets


def _counterfactuals(sentences: list[np.ndarray], sets: list[list[tuple[int, int]]], known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Rows (pair, feature, +1 or -1): what each swap of a term takes out of and puts into a sentence; and the number of pairs."""
    of = {word: k for k, group in enumerate(sets) for word, _ in group}
    pair, feature, sign, n = [], [], [], 0
    for sentence in sentences:
        have = set(sentence.tolist())
        for term in have & of.keys():
            own = next(t for t in sets[of[term]] if t[0] == term)
            for other in sets[of[term]]:
                if other[0] not in have:
                    for part, at in ((own, 1.0), (other, -1.0)):
                        pair += [n, n]
                        feature += list(part)
                        sign += [at, at]
                    n += 1
    feature = np.array(feature, dtype=np.uint64)
    at = np.minimum(np.searchsorted(known, feature), max(0, len(known) - 1))
    ok = known[at] == feature if len(known) else np.zeros(len(feature), bool)
    return np.array(pair, dtype=np.int64)[ok], at[ok], np.array(sign)[ok], n


def _class_weights(labels: np.ndarray) -> tuple[float, float]:
    """What a clean and a toxic text weigh, so that both classes count alike and all texts together 1."""
    return 0.5 / max(1, int((labels == 0).sum())), 0.5 / max(1, int((labels == 1).sum()))


def descend(row: np.ndarray, column: np.ndarray, value: np.ndarray, labels: np.ndarray, swaps: tuple[np.ndarray, np.ndarray, np.ndarray, int],
            w: np.ndarray, b: float, fairness: float = 1.0, l1: float = L1, l2: float = 1e-4, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic loss with an L1 bound and the swap penalty, by accelerated proximal steps from (w, b).

    ``column`` numbers the features, ``swaps`` are those of :func:`_counterfactuals`.
    """
    pair, at, sign, pairs = swaps
    clean, toxic = _class_weights(labels)
    weight, n, m = np.where(labels == 1, toxic, clean), len(labels), len(w)
    v, size = np.ones(m), 1.0
    for _ in range(8):  # a bound on the curvature, from a few power iterations on the design
        v = np.bincount(column, (weight * np.bincount(row, v[column] * value, n))[row] * value, m)
        size = np.linalg.norm(v)
        v = v / max(size, 1e-300)
    step = 1 / (0.25 * size + 0.25 + l2 + (4 * fairness if len(pair) else 0))
    look, look_b, t = w, b, 1.0
    for _ in range(rounds):
        error = weight * (sigmoid(np.bincount(row, look[column] * value, n) + look_b) - labels)
        g = np.bincount(column, error[row] * value, m) + l2 * look
        if len(pair):
            g += 2 * fairness / pairs * np.bincount(at, sign * np.bincount(pair, sign * look[at], pairs)[pair], m)
        was, was_b = w, b
        w = look - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        b = look_b - step * error.sum()
        if np.abs(w - was).max(initial=0) <= 1e-3 * np.abs(w).max(initial=0):
            break
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look, look_b = w + (old - 1) / t * (w - was), b + (old - 1) / t * (b - was_b)
    return w, b


def fit(row: np.ndarray, feature: np.ndarray, value: np.ndarray, labels: np.ndarray, sentences: list[np.ndarray],
        sets: list[list[tuple[int, int]]], **options) -> ToxicityModel:
    """A model of all the features given. Without both labels it is a constant."""
    known, column = np.unique(feature, return_inverse=True)
    swaps = _counterfactuals(sentences, sets, known)
    if not len(known) or len(set(labels.tolist())) < 2:
        return _constant(labels)
    w, b = descend(row, column.reshape(-1), value, labels, swaps, np.zeros(len(known)), 0.0, **options)
    used = w != 0
    return _calibrated(ToxicityModel(known[used], w[used], float(b), swaps[3]), row, feature, value, labels)


def _constant(labels: np.ndarray) -> ToxicityModel:
    rate = (labels.sum() + 0.5) / (len(labels) + 2)  # without any label under a half, so nothing is dropped
    return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(rate / (1 - rate))))


def _calibrated(model: ToxicityModel, rows: np.ndarray, features: np.ndarray, values: np.ndarray, labels: np.ndarray) -> ToxicityModel:
    """The model with margins shrunk by L1 stretched again, and the cut that separates the fitted labels best at 0."""
    margin = model.margins(rows, features, values, len(labels)) - model.bias
    order = np.argsort(margin, kind="stable")
    m, y = margin[order], labels[order]
    # errors when everything from position i on is called toxic; cuts lie between different margins
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    edge = np.concatenate([[True], m[1:] > m[:-1], [True]])
    best = np.flatnonzero(edge & (errors == errors[edge].min()))
    i = best[len(best) // 2]
    low, high = m[i - 1] if i > 0 else m[0] - 1, m[i] if i < len(m) else m[-1] + 1
    scale = 4 / max(1e-6, high - low, np.std(m))
    return ToxicityModel(model.words, model.weights * scale, float(-scale * (low + high) / 2), model.pairs)


def train(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", fit_rows: int = FIT_ROWS, identity_terms: dict[str, list[str]] | None = None,
          l1: float = L1, **options) -> ToxicityModel:
    """A model fitted on at most ``fit_rows`` labelled documents that are not held out (an expression over doc_id).

    Features join the fit as the conditions of optimality ask for them: Spark sums the slope of the loss over the labelled
    texts for every feature, those past the L1 bound come to the driver with the texts that have them, the weights are
    fitted, and so on until no feature is left that would change the optimum. All others have the weight 0 there, so none is
    dropped by a count or a cap. ``identity_terms`` are groups of words that are swapped for each other (``IDENTITY_TERMS``
    if not given). The model says how many swaps there were; none is a warning, because the penalty then has no effect. Null
    labels are ignored, a null text has no words.
    """
    folder = work_folder(docs.sparkSession)
    rows = written(labelled(docs, labels, id_col, text_col, label_col, held_out, fit_rows).select("label", "text"), folder, "labelled")
    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    y = np.repeat([0, 1], [size.get(0, 0), size.get(1, 0)])
    if not y.any() or y.all():
        return _constant(y)
    known, w, b = np.zeros(0, np.uint64), np.zeros(0), 0.0
    sets: list[list[tuple[int, int]]] = []
    for turn in range(TURNS):
        pulls = map_arrow(rows, _pulls(known, w, b, _class_weights(y)), "feature long, toxic double, clean double, slope double")
        pulls = pulls.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("slope").alias("slope"))
        asked = F.abs("slope") > 1.01 * l1
        frequent = (F.col("toxic") + F.col("clean") >= SET_SHARE * len(y)) if turn == 0 else F.lit(False)
        found = pulls.where(asked | frequent).select("feature", "toxic", "clean", asked.alias("asked")).toArrow()
        features = found.column("feature").to_numpy().view(np.uint64)
        if turn == 0:
            amounts = zip(features.tolist(), found.column("toxic").to_pylist(), found.column("clean").to_pylist())
            sets = swap_sets(list(amounts), int(y.sum()), int((1 - y).sum()), IDENTITY_TERMS if identity_terms is None else identity_terms)
            terms = np.array(sorted({t for group in sets for t, _ in group}), np.uint64)
            swapped = np.array(sorted({t for group in sets for pair in group for t in pair if t}), np.uint64)
            sentences = _sentences(rows, terms)
        fresh = np.setdiff1d(features[found.column("asked").to_numpy()], known)
        if turn and not len(fresh):
            break
        wider = np.union1d(np.union1d(known, fresh), swapped)
        now = np.zeros(len(wider))
        now[np.searchsorted(wider, known)] = w
        sample = map_arrow(rows, _examples(wider), "label int, features array<long>, amounts array<double>")
        kept = sample.orderBy("label", "features", "amounts").toArrow()  # a fixed order
        lists = kept.column("features").combine_chunks()
        row = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
        feature, value = lists.flatten().to_numpy().view(np.uint64), kept.column("amounts").combine_chunks().flatten().to_numpy()
        labelled_as = kept.column("label").to_numpy()
        swaps = _counterfactuals(sentences, sets, wider)
        known = wider
        w, b = descend(row, np.searchsorted(known, feature), value, labelled_as, swaps, now, b, l1=l1, **options)
    used = w != 0
    model = _calibrated(ToxicityModel(known[used], w[used], float(b), swaps[3]), row, feature, value, labelled_as)
    if not model.pairs:
        warnings.warn("no sentence holds a term that can be swapped: the counterfactual penalty has no effect", stacklevel=2)
    return model


def _scorer(shared, text_col: str, keep=None, schema: pa.Schema | None = None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for first, end, row, feature, value in features_of(batch.column(text_col)):
                scores[first:end] = sigmoid(shared.value.margins(row, feature, value, end - first))
            if keep:
                yield batch.filter(pa.array(scores < 0.5))
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])
    return score


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row: the probability of the toxic label, and whether it is 0.5 or more.

    The whole text counts; a null or empty one scores what the bias says. Repeated rows score alike, an empty table
    gives an empty result, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    scored = map_arrow(rows, _scorer(shared, "text"), f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with all their columns, in one pass and without a shuffle.

    Each row is judged by its whole text, whatever its id. Null and empty texts score what the bias says; equal rows stay or
    go together; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(docs, _scorer(shared, text_col, keep=True), docs.schema)
