"""Groups, links and pair counts against whole-text encoding and plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fieldmart.llm import alignment
from fieldmart.llm.common import written
from pyspark.sql import functions as F

A, B = str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))


def common_ends(a, b):
    both = sorted(set(a) & set(b))
    return [a.index(x) + 1 for x in both], [b.index(x) + 1 for x in both]


def test_diagonal_runs_match_common_ends():
    rnd = random.Random(1)
    for _ in range(2000):
        n = rnd.randrange(90)
        ends = [[x for x in range(1, n) if rnd.random() < share] + [n] * (n > 0) for share in rnd.choices([.1, .5, .9, 1], k=2)]
        if rnd.random() < .5:
            ends[1] = [x for x in ends[0] if rnd.random() < .9 or x == n]
        got = alignment.diagonal_groups(*(np.array(e, np.int64) for e in ends))
        assert (got[0].tolist(), got[1].tolist()) == common_ends(*ends)


class Slow:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.names = {i: s for s, i in self.a.get_vocab().items()}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in shown]
        self.byte = {**{chr(x): x for x in shown}, **{chr(256 + i): x for i, x in enumerate(hidden)}}

    def groups(self, text):
        """[(A ids, B ids)] of a text, [] without tokens."""
        if not text:
            return []
        whole = (" " + text).encode()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        piece = [self.b.id_to_piece(i) for i in b]
        bytes_a = [bytes(self.byte[c] for c in self.names[i]) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, piece)]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return []
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in (bytes_a, bytes_b)]
        out, i, j = [], 0, 0
        where = [{e: k + 1 for k, e in enumerate(s)} for s in ends]
        for e in sorted(set(ends[0]) & set(ends[1])):
            out.append((a[i:where[0][e]], b[j:where[1][e]]))
            i, j = where[0][e], where[1][e]
        return out


def slow_rows(rows):
    slow = Slow()
    groups = [slow.groups(r[1]) for r in rows]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for g in groups]
    count = Counter(p for c in links for p in c)
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for r, g, c in zip(rows, groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((r[0], sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()), sum(n for p, n in c.items() if count[p] == best[p[0]]),
                    sum(n * count[p] for p, n in c.items()), text))
    return out


def found(docs):
    out = alignment.score_links(written(alignment.align_documents(docs, A, B), "aligned"))
    return [tuple(r) for r in out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()]


KEY = lambda r: tuple((x is None, x) for x in r)


@pytest.mark.parametrize("slice_bytes", [1 << 20, 700])
def test_matches_plain_python(docs_of, odd_rows, monkeypatch, slice_bytes):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", slice_bytes)
    odd = ["▁ a", "x▁y", " lead", "trail ", "  two  spaces  ", "ﬁ é é Ａ b", "a\x00b\x7f", "<s> <unk> <0x41> </s> <|endoftext|>", "-" * 300 + "=" * 77, "🙂👩‍👩‍👧 ok", "\r\n\r\n\t x"]
    rows = [*odd_rows, *[(1000 + i, t, None) for i, t in enumerate(odd)]]
    docs = docs_of(rows, extra=["n_a", "chunk", "pair", "groups", "n", "at"])
    assert sorted(found(docs.repartition(3)), key=KEY) == sorted(slow_rows(rows), key=KEY)


def test_links_in_small_steps(docs_of, odd_texts, monkeypatch):
    rows = [(i, t, None) for i, t in enumerate(odd_texts) if not t or len(t) < 5000]
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 3)
    tables = alignment.tokenizers(A, B)
    assert tables[2].by_word
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["doc_id", "text"])
    from fieldmart.llm.common import text_slices

    for small, data, offsets in text_slices(iter([batch])):
        few = alignment.align_slice(small, data, offsets, A, B, 0)
        monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 10 ** 7)
        many = alignment.align_slice(small, data, offsets, A, B, 0)
    pairs = [b.column("chunk_pairs")[0].as_py() for b in (few, many)]
    for a, b in zip(few.to_pylist(), many.to_pylist()):
        assert ({pairs[0][k]: t for k, t in zip(a["pair_at"], a["pair_times"])} == {pairs[1][k]: t for k, t in zip(b["pair_at"], b["pair_times"])})


def test_whole_texts_where_words_may_join(odd_texts, monkeypatch):
    words, whole = alignment.Pieces(B), alignment.Pieces(B)
    whole.by_word = False
    for t in odd_texts:
        if t and "▁" not in t:
            data = np.frombuffer((" " + t).encode(), np.uint8)
            ids = [p.encode(data, np.array([0, len(data)]))[0].tolist() for p in (words, whole)]
            assert ids[0] == ids[1] == words.model.encode(t)


def test_query_digest_and_empty_table(spark, docs_of, tmp_path):
    from fieldmart.llm.queries import op13_cross_tokenizer_alignment

    rows = [(1, "The cat sat"), (2, ""), (3, None), (4, "The dog")]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["groups_sha256"] for r in op13_cross_tokenizer_alignment(spark, str(tmp_path)).collect()}
    assert got == {r[0]: hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "" for r in slow_rows(rows)}
    empty = docs_of(rows).where("false")
    assert found(empty) == []
    assert found(docs_of([(1, None)]).select("doc_id", F.col("text"))) == [(1, 0, 0, 0, 0, 0, 0, "")]
