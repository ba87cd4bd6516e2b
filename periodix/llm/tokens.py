"""Whole texts to token ids, by a public tokenizer file, with the repeated work of a task kept.

Where a tokenizer's normaliser and splitter are the known ones below, a text's ids are those of its pieces, one after the
other: runs of letters, runs of punctuation and single digits between white space. Pieces are cut and numbered in Arrow and
numpy, and a task encodes each distinct one once. Chunks with other characters, and all texts of any other tokenizer, go
through the tokenizer itself.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from periodix.llm.text import NOT_SPACE, lower_ascii, runs, slices, word_spans

#: Pieces whose ids a task keeps, and their bytes together; beyond either, pieces used once go, and the rarer half.
KEPT_PIECES = 200_000
KEPT_BYTES = 16 << 20
#: Longer pieces are not kept.
LONG_PIECE = 64
#: Texts are encoded this many bytes at a time; one longer text goes alone.
STEP_BYTES = 1 << 21

# The normaliser and the splitter that allow a text to be cut into pieces.
NORMALISERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

LETTER, DIGIT, SIGN, OTHER = range(4)
_KIND = np.full(256, OTHER, np.uint8)
_KIND[33:127] = SIGN
_KIND[48:58] = DIGIT
_KIND[97:123] = LETTER
_KIND[[39, 60]] = OTHER  # apostrophes may begin an ending of their own, and '<' a special token


def cuts_into_pieces(spec: dict) -> bool:
    """Whether the tokenizer of this file gives a text the ids of its pieces, one after the other."""
    normal, split, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    parts = split.get("pretokenizers") or [{}]
    level = parts[-1]
    return (normal.get("type") == "Sequence" and normal.get("normalizers") == NORMALISERS
            and split.get("type") == "Sequence" and len(parts) == 2 and parts[0].get("type") == "Split"
            and parts[0].get("pattern") == {"Regex": SPLITTER} and parts[0].get("behavior") == "Removed" and parts[0].get("invert") is True
            and level.get("type") == "ByteLevel" and not level.get("add_prefix_space") and level.get("use_regex") is False
            and model.get("type") == "BPE" and not model.get("dropout") and not spec.get("truncation") and not spec.get("padding")
            and all("<" in t["content"] for t in spec.get("added_tokens") or []))


@functools.cache
def _loaded(path: str):
    """Once per Python worker: the tokenizer, and how its byte-level splitter writes each character of a piece, or None."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        if not cuts_into_pieces(json.load(file)):
            return tokenizer, None
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer, {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(33, 256) if c < 127 or c >= 192}


def pieces_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(pieces, lower-cased; whether each goes through the tokenizer; the first piece of each text, and the end)."""
    starts, ends, first_word = word_spans(raw, offsets, NOT_SPACE)
    low = lower_ascii(raw)
    kind = _KIND[low]
    lead = np.flatnonzero(low[:-1] == 0xC3)  # Latin letters of two bytes, but the signs of multiplication and division
    lead = lead[(low[lead + 1] != 0x97) & (low[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    capital = lead[low[lead + 1] <= 0x9E] + 1
    low[capital] += 0x20
    inside = NOT_SPACE[raw]
    size = ends - starts
    word_at = np.concatenate([[0], np.cumsum(size)])
    packed, kind = low[inside], kind[inside]
    odd = np.flatnonzero(kind == OTHER)
    if len(odd):  # words with such characters stay as they are
        word = np.unique(np.searchsorted(word_at, odd, "right") - 1)
        whole = runs(word_at[word], size[word])
        packed[whole] = raw[inside][whole]
        kind[whole] = OTHER
    new = np.empty(len(packed), bool)
    if len(new):
        new[0] = True
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    new[word_at[:-1]] = True
    at = np.flatnonzero(new)
    first = np.searchsorted(at, word_at[first_word])
    column = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(packed)).astype(np.int64)), pa.py_buffer(packed)])
    return column, kind[at] == OTHER, first


class PieceEncoder:
    """Ids of texts by ``tokenizers`` from the file at ``path``, without special tokens being added. One per task."""

    def __init__(self, path: str):
        self.tokenizer, self.spelled = _loaded(path)
        self.model = self.tokenizer.model
        self.known = pa.array([], pa.large_binary())  # pieces whose ids are kept
        self.start = np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self.uses = np.zeros(0, np.int64)

    def _keep(self, keep: np.ndarray) -> None:
        length = self.start[keep + 1] - self.start[keep]
        self.known = self.known.take(pa.array(keep))
        self.pool = self.pool[runs(self.start[keep], length)]
        self.start = np.concatenate([[0], np.cumsum(length)])
        self.uses = self.uses[keep]

    def _forget_rare(self) -> None:
        """Keeps the pieces used most, at most half of those allowed and none that are long."""
        keep = np.flatnonzero((self.uses > 1) & (pc.binary_length(self.known).to_numpy() < LONG_PIECE))
        self._keep(np.sort(keep[np.argsort(-self.uses[keep], kind="stable")[:KEPT_PIECES // 2]]))

    def _ids(self, piece: bytes, whole: bool) -> list[int]:
        text = piece.decode()
        if whole:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return [t.id for t in self.model.tokenize(text.translate(self.spelled))]

    def _add(self, fresh: pa.Array, whole: np.ndarray) -> None:
        lists = list(map(self._ids, fresh.to_pylist(), whole.tolist()))
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        self.known = pa.concat_arrays([self.known, fresh])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lengths)])
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum()))])
        self.uses = np.concatenate([self.uses, np.zeros(len(lists), np.int64)])

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each text has)."""
        if self.spelled is None:
            texts = [raw[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)
        if len(self.known) > KEPT_PIECES or self.known.nbytes > KEPT_BYTES:
            self._forget_rare()
        column, whole, first = pieces_of(raw, offsets)
        coded = column.dictionary_encode()
        index, distinct = coded.indices.to_numpy(), coded.dictionary
        place = pc.index_in(distinct, value_set=self.known)
        number = pc.fill_null(place, -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            kind = np.zeros(len(distinct), bool)
            kind[index] = whole
            number[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._add(distinct.take(pa.array(new)), kind[new])
        self.uses[number] += np.bincount(index, minlength=len(distinct))
        at = number[index]
        length = self.start[at + 1] - self.start[at]
        before = np.concatenate([[0], np.cumsum(length)])
        return self.pool[runs(self.start[at], length)], np.diff(before[first])


def encoded(texts: pa.Array, encoder: PieceEncoder, end_id: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, ids of each text) for steps of texts, each text closed by ``end_id``."""
    for first, end, raw, offsets in slices(texts, STEP_BYTES):
        ids, count = encoder.encode(raw, offsets)
        closed = np.full(len(ids) + len(count), end_id, np.uint32)
        closed[np.arange(len(ids)) + np.repeat(np.arange(len(count)), count)] = ids
        yield first, end, closed, count + 1
