import bisect
import json
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from periodix.llm import tokens
from periodix.llm.packing import nnls, pack, patterns, plan_histogram
from periodix.llm.token_files import chunk_index, join_planes, pack_chunk, read_token_files, split_planes, unpack_chunk, write_token_files
from tests.llm.conftest import TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1]


def split(texts):
    out = []
    for _, _, ids, count in tokens.encoded(pa.array(texts, pa.string()), tokens.PieceEncoder(PATH), 1):
        out += [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
    return out


def test_encoder_gives_the_tokenizers_ids(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 50)  # forgets often
    monkeypatch.setattr(tokens, "STEP_BYTES", 100)
    texts = [t for _, t in TEXTS] + ["<|endoftext|> a<|startoftext|>b", "İstanbul ΑΣ ﬁ Ǆ é é", "a\x1cb\x85c\xa0d", "we've I'LL 's ''", "x\0y ²³ ½ 12ab 3.5"]
    assert split(texts) == [ids_of(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30) | st.text("aB'é.,<| \n\t1", max_size=20), max_size=4))
def test_encoder_on_any_text(texts):
    assert split(texts) == [ids_of(t) for t in texts]


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_planes_round_trip(unit):
    for n in (1, 7, 8, 65, 1000):
        ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
        assert (join_planes(split_planes(ids, unit), n, unit) == ids).all()
        sizes, planes = pack_chunk(ids, unit, 64)
        assert (unpack_chunk(planes, np.array(sizes), n, unit, 64) == ids).all()


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_files_round_trip(spark, odd_docs, tmp_path, unit):
    write_token_files(odd_docs, f"{tmp_path}/files", PATH, unit=unit, block_ids=100, chunk_ids=50)
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    index = {(r.shard, r.chunk): r.start for r in chunk_index(spark, f"{tmp_path}/files").collect()}
    rows = [(index[r.shard, r.chunk] + r.chunk_start, r.doc_id, list(r.ids)) for r in read_token_files(spark, f"{tmp_path}/files").collect()]
    rows.sort()
    assert [(d, x) for _, d, x in rows] == [(i, ids_of(t)) for i, t in order]
    assert [s for s, _, _ in rows] == np.cumsum([0, *(len(x) for _, _, x in rows)])[:-1].tolist()


def test_empty_table_of_files(spark, no_docs, tmp_path):
    write_token_files(no_docs, f"{tmp_path}/none", PATH)
    assert read_token_files(spark, f"{tmp_path}/none").count() == 0
    assert chunk_index(spark, f"{tmp_path}/none").count() == 0


def test_patterns_fill_the_capacity():
    table = patterns(12, 3)
    assert (table @ np.arange(1, 13) == 12).all() and table.sum(axis=1).max() == 3
    assert len(table) == len(np.unique(table, axis=0)) == 19  # partitions of 12 into at most 3 parts


def test_least_squares_finds_the_counts():
    rng = np.random.default_rng(0)
    a, x = rng.random((30, 10)), np.maximum(rng.normal(size=10), 0)
    assert np.allclose(nnls(a, a @ x, 20000), x, atol=1e-2)


@pytest.mark.parametrize("counts", [{}, {1: 5}, {4096: 3}, {1365: 10_000, 4096: 5, 1: 7}, {2049: 100}, {x: 1 + x % 3 for x in range(1, 4097)}, {700: 10**9, 3396: 10**9}])
def test_plan_places_everything_once(counts):
    plan = plan_histogram(counts)
    assert {int(x): int(plan.count[plan.length == x].sum()) for x in np.unique(plan.length)} == counts
    total = sum(x * n for x, n in counts.items())
    assert plan.sequences >= -(-total // 4096)
    if sum(counts.values()) < 100_000:
        length = np.repeat(list(counts), list(counts.values())).astype(np.int64)
        rank = np.concatenate([np.arange(n) for n in counts.values()] or [np.zeros(0, np.int64)])
        sequence, offset = plan.place(length, rank) if len(length) else (length, rank)
        order = np.lexsort((offset, sequence))
        s, o, x = sequence[order], offset[order], length[order]
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        assert (o[new] == 0).all() and (o[1:] == o[:-1] + x[:-1])[~new[1:]].all() and (o + x <= 4096).all()
        assert new.sum() == plan.sequences
    if 2049 not in counts and total:
        assert plan.sequences <= 1.02 * total / 4096 + 1


def test_pack(spark, odd_docs, no_docs):
    rows = pack(odd_docs, PATH, capacity=4096).collect()
    whole = {}
    for r in rows:
        assert len(r.ids) == r.length and r.start == 4096 * r.piece
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32
        whole.setdefault(r.doc_id, []).append((r.start, list(r.ids)))
    for i, t in TEXTS:
        if i is not None and i != 13:
            assert [x for _, part in sorted(whole[i]) for x in part] == ids_of(t)
    assert sum(len(r.ids) for r in rows) == sum(len(ids_of(t)) for _, t in TEXTS)
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    for (s, o, n), (s2, o2, _) in zip(places, places[1:]):
        assert (s2 > s and o2 == 0) or (s2 == s and o2 == o + n)
    assert pack(no_docs, PATH).count() == 0


def best_fit_decreasing(lengths, capacity):
    """Sequences that best-fit decreasing needs."""
    rooms, sequences = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, length)
        if i == len(rooms):
            sequences += 1
            room = capacity - length
        else:
            room = rooms.pop(i) - length
        if room:
            bisect.insort(rooms, room)
    return sequences


def corpus_lengths():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").combine_chunks()
    return [min(4096, n) for _, _, _, count in tokens.encoded(texts, tokens.PieceEncoder(PATH), 1) for n in count.tolist()]


RNG = np.random.default_rng(4)


@pytest.mark.parametrize("lengths", [
    pytest.param(corpus_lengths, id="corpus"), pytest.param(lambda: RNG.integers(1, 4097, 8000).tolist(), id="uniform"),
    pytest.param(lambda: RNG.lognormal(6, 1, 20000).clip(1, 4096).astype(int).tolist(), id="log-normal"),
    pytest.param(lambda: RNG.integers(1300, 1500, 3000).tolist(), id="narrow"), pytest.param(lambda: [4096] * 5 + [1] * 7, id="few"), pytest.param(lambda: [], id="none")])
def test_no_more_sequences_than_best_fit_decreasing(lengths):
    lengths = lengths()
    plan = plan_histogram(dict(Counter(lengths)))
    assert plan.sequences <= best_fit_decreasing(lengths, 4096)
    assert plan.count.sum() == len(lengths)


def test_other_tokenizers_go_whole():
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert not tokens.cuts_into_pieces(json.load(open(other))) and tokens.cuts_into_pieces(json.load(open(PATH)))
    whole = Tokenizer.from_file(other)
    texts = ["Ab  cd\n\tEF", "", "é ünï 12", None]
    got = []
    for _, _, ids, count in tokens.encoded(pa.array(texts, pa.string()), tokens.PieceEncoder(other), 7):
        got += [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
    assert got == [[*whole.encode(t or "", add_special_tokens=False).ids, 7] for t in texts]
