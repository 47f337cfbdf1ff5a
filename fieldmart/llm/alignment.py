"""Alignment of two tokenizers' ids over the same bytes.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library, B a model of
``sentencepiece``; both see a space and the text. Where a token of A and one of B
end at the same byte, a group of tokens closes. All A-B pairs of token occurrences
in a group are links, and an id pair counts in each document that links it.

Groups come from the two arrays of token ends by running along the diagonal: at the
current index shift, windows of 1, 1, 2, 4, ... ends are compared as bytes and jumped
over while they are equal (one-to-one tokens); within the first unequal window the
stretch's end is found by halving. The irregular group that follows is resolved by
stepping whichever side ends earlier until both agree, which gives the next shift.

The table of aligned documents is written once, in chunks of one slice of text; a
chunk's first row carries the chunk's id pairs with their document counts, so that
pair counts are summed over chunks, not over tokens. Summed counts go back to the
chunks that asked for them (``score_links``): no pair table is broadcast or held
whole. A frequent pair comes once a chunk, and Spark splits such a join partition.

Null, empty or not exactly decoded texts (the joined bytes of A's or B's tokens
differ from space and text): no tokens, zeros and empty groups. Null doc_id and
repeated rows: each row is a document of its own in the counts. Very long texts: one
text and its tokens must fit into a task. Empty table: no rows. Extra columns are
ignored. Ties: every pair that reaches its A id's highest count is best."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.llm.common import gather, text_slices
from fieldmart.llm.tokens import REMEMBERED, byte_letters, encoder

#: Text bytes of one chunk (a longer text is a chunk of its own).
CHUNK_BYTES = 1 << 20
#: Links that one vectorised step lists (a group with more is a step of its own).
LINKS_AT_ONCE = 4_000_000
#: Id pairs are coded as A * 2^32 + B.
SHIFT = 32
ALIGNED = ("doc_id long, chunk long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "pair_at array<int>, pair_times array<int>, chunk_pairs array<long>, chunk_docs array<int>")


class TokenBytes:
    """The bytes of every id of a vocabulary, one after the other."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.starts[ids], self.lengths[ids])


class Pieces:
    """Ids by a sentencepiece model of texts that begin with a space. No piece of the
    vocabulary goes on from a word into a space and the normaliser leaves text as it
    is (else texts are encoded whole), so distinct words are encoded once."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        probe = "Aﬁ½Ⅷ é x  y\tZ"
        self.by_word = (not any(u != "▁" and v == "▁" for name in names for u, v in zip(name, name[1:]))
                        and self.model.normalize(probe) == "▁" + probe.replace(" ", "▁"))
        self.space = self.model.piece_to_id("▁")
        self.bytes = TokenBytes([bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
                                 for i, name in enumerate(names)])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        found = self.model.encode([p[1:] for p in pieces], num_threads=1)
        if " " in pieces:
            found[pieces.index(" ")] = [self.space]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.known.update(zip(pieces, range(len(self.sizes), len(self.sizes) + len(found))))
        self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum())))
        self.sizes = np.append(self.sizes, sizes)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts, and where each text's ids end."""
        cut = np.zeros(len(data), bool)
        cut[offsets[:-1]] = True
        if self.by_word:
            space = data == 32
            cut[1:] |= space[1:] & ~space[:-1]
        starts = np.flatnonzero(cut)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > REMEMBERED or not self.by_word:
            self._forget()
        self._learn([p for p in distinct if p not in self.known])
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        sizes = self.sizes[at]
        ids = gather(self.flat, (np.cumsum(self.sizes) - self.sizes)[at], sizes)
        before = np.concatenate([[0], np.cumsum(sizes)])
        return ids, before[np.searchsorted(starts, offsets[1:])]


_loaded: dict[tuple, tuple] = {}


def tokenizers(path_a: str, path_b: str) -> tuple:
    """(encoder of A, token bytes of A, encoder of B), loaded once a worker."""
    if (path_a, path_b) not in _loaded:
        a = encoder(path_a, None)
        byte_of = {c: b for b, c in byte_letters().items()}
        names = {i: name for name, i in a.tokenizer.get_vocab().items()}
        # entries outside the byte alphabet are special tokens; encoded text holds none
        entries = [bytes(byte_of[c] for c in names[i]) if all(c in byte_of for c in names.get(i, "?\0")) else b"" for i in range(max(names) + 1)]
        _loaded[path_a, path_b] = (a, TokenBytes(entries), Pieces(path_b))
    return _loaded[path_a, path_b]


def diagonal_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): for each group the index after its last token in A and in B. Both
    arrays grow strictly and close with the same end."""
    a, b = ends_a.astype(np.int64).tobytes(), ends_b.astype(np.int64).tobytes()
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    n, i, j = len(list_a), 0, 0
    at_i, at_j, runs = [], [], []

    while i < n:
        at_i.append(i)
        at_j.append(j)
        if list_a[i] == list_b[j]:
            width = 1
            i, j = i + 1, j + 1
            while i < n and a[8 * i:8 * i + 8 * width] == b[8 * j:8 * j + 8 * width]:
                i, j = i + width, j + width   # equal windows that were cut short close both arrays
                width *= 2
            while width > 1 and i < n:
                width >>= 1
                if a[8 * i:8 * i + 8 * width] == b[8 * j:8 * j + 8 * width]:
                    i, j = i + width, j + width
            if i > n:
                i = n
        runs.append(i - at_i[-1])
        if i < n:
            x, y = list_a[i], list_b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = list_a[i]
                else:
                    j += 1
                    y = list_b[j]
            i, j = i + 1, j + 1
        else:
            break
    else:
        if n:  # the last group was irregular: an empty run closes it
            at_i.append(n)
            at_j.append(len(list_b))
            runs.append(0)
    starts_i, starts_j, lengths = (np.array(v, np.int64) for v in (at_i, at_j, runs))
    if not len(lengths):
        return starts_i, starts_j
    closing = np.append(lengths[:-1] + 1, lengths[-1])      # each run but the last is followed by one irregular group
    step = np.arange(int(closing.sum())) - np.repeat(np.cumsum(closing) - closing, closing) + 1
    which = np.repeat(np.arange(len(closing)), closing)
    odd = step > lengths[which]
    out_a, out_b = starts_i[which] + step, starts_j[which] + step
    out_a[odd], out_b[odd] = starts_i[which[odd] + 1], starts_j[which[odd] + 1]
    return out_a, out_b


def decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(flat, lengths) of the numbers 0 to n - 1 as text, each with room for a mark."""
    names = [f"{i},".encode() for i in range(n)]
    return np.frombuffer(b"".join(names), np.uint8), np.fromiter(map(len, names), np.int64, n)


_numbers: dict[int, tuple] = {}


def group_texts(ids_a: np.ndarray, ids_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, of_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, length per document) of a1,a2|b1;a3|b2: each group's ids of A, then of
    B. ``of_doc``: groups of each document."""
    most = int(max(ids_a.max(initial=0), ids_b.max(initial=0))) + 1
    size = max(65_536, most)
    if size not in _numbers:
        _numbers[size] = decimals(size)
    flat, lengths = _numbers[size]
    starts = np.cumsum(lengths) - lengths
    both = size_a + size_b
    end = np.cumsum(both)
    ids = np.empty(int(end[-1]) if len(end) else 0, np.int64)
    place = np.arange(len(ids)) - np.repeat(end - both, both) < np.repeat(size_a, both)
    ids[place], ids[~place] = ids_a, ids_b
    wide = lengths[ids]
    text = gather(flat, starts[ids], wide)
    mark = np.cumsum(wide) - 1
    text[mark[(end - both + size_a - 1)]] = ord("|")
    text[mark[end - 1]] = ord(";")
    closing = end[np.cumsum(of_doc)[of_doc > 0] - 1] - 1     # the last token of each document has no mark
    keep = np.ones(len(text), bool)
    keep[mark[closing]] = False
    doc = np.repeat(np.arange(len(of_doc)), of_doc)
    per_token = np.repeat(doc, both)
    sizes = np.bincount(per_token, weights=wide, minlength=len(of_doc)).astype(np.int64) - (of_doc > 0)
    return text[keep], sizes


def linked(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, pair code) of all links, some groups at a time."""
    first_a, first_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
    per_b = ends_b - first_b
    amount = (ends_a - first_a) * per_b
    total = np.cumsum(amount)
    g = 0
    while g < len(total):
        to = max(g + 1, int(np.searchsorted(total, (total[g - 1] if g else 0) + LINKS_AT_ONCE, side="right")))
        here = amount[g:to]
        which = np.repeat(np.arange(g, to), here)
        step = np.arange(len(which)) - np.repeat(np.cumsum(here) - here, here)
        yield doc[which], ids_a[first_a[which] + step // per_b[which]].astype(np.int64) << SHIFT | ids_b[first_b[which] + step % per_b[which]]
        g = to


def exact_texts(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, ends: np.ndarray, table: TokenBytes) -> np.ndarray:
    """For each text whether its ids' bytes are the text's."""
    first = np.concatenate([[0], ends[:-1]])
    total = np.concatenate([[0], np.cumsum(table.lengths[ids])])
    ok = total[ends] - total[first] == np.diff(offsets)
    sizes = np.where(ok, ends - first, 0)
    made = table.of(gather(ids, first, sizes))
    sizes = np.where(ok, np.diff(offsets), 0)
    wrong = np.flatnonzero(made != gather(data, offsets[:-1], sizes))
    ok[np.searchsorted(np.cumsum(sizes), wrong, side="right")] = False
    return ok


def align_slice(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, path_a: str, path_b: str, chunk: int) -> pa.RecordBatch:
    tok_a, bytes_a, tok_b = tokenizers(path_a, path_b)
    n = batch.num_rows
    row = np.flatnonzero(np.diff(offsets))
    spaced = np.insert(data, offsets[row], np.uint8(32))
    bounds = np.concatenate([[0], np.cumsum(np.diff(offsets)[row] + 1)])
    n_a, n_b, n_groups, n_links = (np.zeros(n, np.int64) for _ in range(4))
    text_sizes, texts = np.zeros(n, np.int64), np.zeros(0, np.uint8)
    doc = code = np.zeros(0, np.int64)
    if len(row):
        ids_a, end_a = tok_a.encode(spaced, bounds)
        ids_b, end_b = tok_b.encode(spaced, bounds)
        ok = exact_texts(spaced, bounds, ids_a, end_a, bytes_a) & exact_texts(spaced, bounds, ids_b, end_b, tok_b.bytes)
        size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        ids_a = gather(ids_a, (end_a - size_a)[ok], size_a[ok]).astype(np.int64)
        ids_b = gather(ids_b, (end_b - size_b)[ok], size_b[ok])
        row = row[ok]
        n_a[row], n_b[row] = size_a[ok], size_b[ok]
        if len(row):
            ends_a, ends_b = diagonal_groups(np.cumsum(bytes_a.lengths[ids_a]), np.cumsum(tok_b.bytes.lengths[ids_b]))
            of = np.searchsorted(np.cumsum(size_a[ok]), ends_a, side="left")     # every text closes a group
            n_groups[row] = np.bincount(of, minlength=len(row))
            group_a, group_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
            n_links[row] = np.bincount(of, weights=group_a * group_b, minlength=len(row)).astype(np.int64)
            texts, sizes = group_texts(ids_a, ids_b, group_a, group_b, n_groups[row])
            text_sizes[row] = sizes
            parts = []
            for d, c in linked(ids_a, ids_b, ends_a, ends_b, row[of]):
                parts.append(count_pairs(d, c))
            doc, code, times = parts[0] if len(parts) == 1 else [np.concatenate(x) for x in zip(*parts)]
    index, pairs = pd.factorize(code)
    if len(code):  # a document's pairs may stand in several parts
        key, where = np.unique(doc * len(pairs) + index, return_inverse=True)
        times = np.bincount(where, weights=times).astype(np.int64)
        doc, index = np.divmod(key, len(pairs))
    else:
        times = code
    at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int32)
    holders = np.bincount(index, minlength=len(pairs)) if len(pairs) else np.zeros(0, np.int64)
    once = pa.array([True] + [False] * (n - 1))
    whole = np.concatenate([[0], np.full(n, len(pairs))]).astype(np.int32)

    def as_list(offs, values, kind):
        return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values, kind))

    def first_row(values, kind):
        return pc.if_else(once, as_list(whole, values, kind), pa.scalar(None, pa.list_(kind)))

    text = pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.concatenate([[0], np.cumsum(text_sizes)]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(texts)))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(np.full(n, chunk)), *(pa.array(v) for v in (n_a, n_b, n_groups, n_links)), text.cast(pa.string()),
         as_list(at, index, pa.int32()), as_list(at, times, pa.int32()), first_row(pairs, pa.int64()), first_row(holders, pa.int32())],
        names=[c.split()[0] for c in ALIGNED.split(", ")])


def count_pairs(doc: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, pair) with how often each occurs."""
    index, pairs = pd.factorize(code)
    key, times = np.unique(doc * len(pairs) + index, return_counts=True)
    return key // len(pairs), pairs[key % len(pairs)], times


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: doc_id, token, group and link counts, the groups as text
    (a1,a2|b1;a3|b2,b3) and its linked id pairs as places in the chunk's list, which
    the chunk's first row holds. Write it once before :func:`score_links`, because
    chunk numbers belong to the tasks that made them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch, data, offsets in text_slices(batches, CHUNK_BYTES):
            yield align_slice(batch, data, offsets, path_a, path_b, chunk)
            chunk += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): documents that link each id pair, and whether its A id has no
    pair with more. An A id meets at most as many pairs as B has ids."""
    pairs = aligned.where(F.col("chunk_pairs").isNotNull()).select(F.inline(F.arrays_zip(F.col("chunk_pairs").alias("pair"), F.col("chunk_docs").alias("docs"))))
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", SHIFT))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def score_links(aligned: DataFrame) -> DataFrame:
    """``aligned`` (a written table) without its pair columns, with n_best and
    count_sum: the links whose pair is best for its A id, and the counts of all."""
    asked = (aligned.where(F.size("chunk_pairs") > 0).select("chunk", F.posexplode("chunk_pairs").alias("at", "pair"))
             .join(pair_counts(aligned), "pair").select(F.col("chunk").alias("asked"), "at", "n", "best"))
    kept = [c for c in aligned.columns if c not in ("pair_at", "pair_times", "chunk_pairs", "chunk_docs")]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right.column("at").to_numpy()
        n, best = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64)
        n[at], best[at] = right.column("n").to_numpy(), right.column("best").to_numpy()
        where = left.column("pair_at").combine_chunks()
        times = left.column("pair_times").combine_chunks()
        if isinstance(where, pa.ChunkedArray):
            where, times = pa.concat_arrays(where.chunks), pa.concat_arrays(times.chunks)
        index, often = where.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(where).to_numpy())])
        sums = [np.concatenate([[0], np.cumsum(often * v[index])]) for v in (best, n)]
        out = left.select([c for c in kept if c != "chunk"])
        for name, s in zip(("n_best", "count_sum"), sums):
            out = out.append_column(name, pa.array(s[ends[1:]] - s[ends[:-1]]))
        return out

    types = dict(aligned.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept if c != "chunk") + ", n_best long, count_sum long"
    left = aligned.select(*kept, "pair_at", "pair_times")
    return left.groupBy("chunk").cogroup(asked.groupBy("asked")).applyInArrow(score, schema)
