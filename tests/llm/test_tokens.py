"""Packed and filed ids against the tokenizers library on whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldmart.llm import packing, repair
from fieldmart.llm.common import text_slices
from fieldmart.llm.tokens import encoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def path(name):
    return str(public_tokenizers.path(name))


def slow_ids(name, texts):
    t = Tokenizer.from_file(path(name))
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def fast_ids(name, texts):
    out = []
    for _, data, offsets in text_slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])], 3000):
        ids, ends = encoder(path(name), 2).encode(data, offsets)
        out += [x.tolist() for x in np.split(ids, ends[:-1])]
    return out


@pytest.mark.parametrize("name", FILES)
def test_ids_of_odd_texts(name, odd_texts):
    assert fast_ids(name, odd_texts) == slow_ids(name, odd_texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x0b'.,sStT12aAéÉßſıİḰ  #|"), st.characters(codec="utf-8")), max_size=40), min_size=1, max_size=4))
def test_ids_of_any_text(texts):
    for name in FILES:
        assert fast_ids(name, texts) == slow_ids(name, texts)


def one_by_one(lengths, capacity):
    """Best-fit decreasing, piece by piece: remaining capacities of the bins."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [b for b in bins if b >= n]
        if fit:
            bins.remove(min(fit))
            bins.append(min(fit) - n)
        else:
            bins.append(capacity - n)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([5, 16, 64, 100])
    lengths = [rnd.randint(1, capacity if seed % 2 else max(1, capacity // 3)) for _ in range(rnd.choice([1, 30, 400]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    used = {}
    for length, first_rank, ranks, first, offset in packing.plan(counts, capacity).tolist():
        for b in range(first, first + ranks):
            used.setdefault(b, []).append((offset, length))
    for items in used.values():
        items.sort()
        assert [o for o, _ in items] == [sum(n for _, n in items[:i]) for i in range(len(items))]
    assert sorted(capacity - sum(n for _, n in items) for items in used.values()) == one_by_one(lengths, capacity)
    assert sorted(n for items in used.values() for _, n in items) == sorted(lengths)


def test_packed_documents(docs_of, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    got = packing.pack_documents(docs_of(rows), path(FILES[0]), 2, 64, with_ids=True).collect()
    want, lengths = [], []
    for (i, _), ids in zip(rows, slow_ids(FILES[0], [t for _, t in rows])):
        cut = [ids[:(len(ids) - 1) % 64 + 1]]
        cut += [ids[a:a + 64] for a in range(len(cut[0]), len(ids), 64)]
        at = 0
        for p, c in enumerate(cut):
            want.append((-1 if i is None else i, p, at, len(c), zlib.crc32(np.array(c, "<u4").tobytes())))
            lengths.append(len(c))
            at += len(c)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    assert len(places) == len(one_by_one(lengths, 64))
    for items in places.values():
        items.sort()
        at = 0
        for offset, length, _ in items:
            assert offset == at
            at += length
        assert at <= 64


def test_sequences_hold_their_pieces(docs_of):
    placed = packing.pack_documents(docs_of([(1, "a b c"), (2, "d e"), (3, None)]), path(FILES[0]), 2, 8, with_ids=True)
    whole = {r.sequence_id: r.ids for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == r.ids


def test_packing_an_empty_table(docs_of):
    assert packing.pack_documents(docs_of([(1, "a")]).where("false"), path(FILES[0])).collect() == []


@pytest.mark.parametrize("shard_tokens", [repair.SHARD_TOKENS, 500])
def test_files_round_trip(spark, docs_of, odd_rows, tmp_path, shard_tokens):
    rows = [(r[0], r[1]) for r in odd_rows if r[0] != odd_rows[13][0] and r[0] != odd_rows[15][0]]
    repair.write_ids(docs_of(rows), f"{tmp_path}/ids", path(FILES[1]), 2, shard_tokens, parts=3)
    got = repair.digest(spark, f"{tmp_path}/ids").collect()
    ids = slow_ids(FILES[1], [t for _, t in rows])
    named = sorted(((i, x) for (i, _), x in zip(rows, ids) if i is not None), key=lambda p: p[0])
    start = sum(len(x) for (i, _), x in zip(rows, ids) if i is None)
    want = []
    for i, x in named:
        want.append((i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == want and len(got) == len(rows)
    some = [named[3][0], named[-1][0]]
    assert {r.doc_id: r.ids for r in repair.read_documents(spark, f"{tmp_path}/ids", some).collect()} == {i: x for i, x in named if i in some}


def test_files_of_an_empty_table(spark, docs_of, tmp_path):
    repair.write_ids(docs_of([(1, "a")]).where("false"), f"{tmp_path}/ids", path(FILES[1]), 2)
    assert repair.digest(spark, f"{tmp_path}/ids").collect() == []


@pytest.mark.parametrize("base,top", [(50, 50), (49_408, 300), (70_000, 70_000)])
def test_grammars_decode_and_save(base, top):
    rnd = np.random.default_rng(base)
    phrases = [rnd.integers(0, top, rnd.integers(2, 9)) for _ in range(40)]
    docs = [np.concatenate([phrases[i] for i in rnd.integers(0, 40, rnd.integers(1, 60))]) for _ in range(200)] + [np.full(3000, 7), np.zeros(1, int)]
    ids = np.concatenate(docs).astype(np.uint32)
    ends = np.cumsum([len(d) for d in docs])
    row = repair.compress(ids, ends, base)
    grammar = repair.Grammar(base, row["width"], row["rules"], row["lengths"], row["rounds"])
    assert (grammar.expand(row["symbols"]) == ids).all()
    cut = np.cumsum(row["doc_symbols"])
    symbols = np.frombuffer(row["symbols"], f"<u{row['width']}")
    for d, (a, b) in enumerate(zip(cut - row["doc_symbols"], cut)):
        assert (grammar.expand(symbols[a:b]) == docs[d]).all()
    assert len(symbols) < 0.5 * len(ids)
