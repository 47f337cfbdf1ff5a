"""Periodic runs of words by Kruskal's order over common prefixes.

A run is a stretch of consecutive words with smallest period q that holds at least
``power`` periods and ``least`` words and that no neighbouring word extends with
that period. Inside a task the suffixes of a text are sorted (prefix doubling over
all texts of a slice at once) and neighbours in that order get their common prefix
length. The neighbour pairs are taken by decreasing length; a union-find unites
their classes, each an ordered set of positions (the smaller set goes into the
larger one). All suffixes of two classes united at length l share exactly l words,
so two positions that become adjacent in the united set at a distance d <= l seed
the run with period d that ends l words after the later one; it starts at the
earlier one if the words before both differ. A position between them with a longer
common prefix would show a smaller period, and a smaller period would put such a
position between them: every run comes up once, with its smallest period.

Texts without a chance of a run are left out beforehand: a run repeats the word
sequence (of the shortest common prefix that matters) at its start one period
later, and a third time if its period is long enough for the sequence to end inside
the run. Sequences are compared by hash there, which only lets more texts through.

Rows are independent: no shuffle, and a lost task is redone from its input. One
text must fit into a task's memory, whatever its length (about 60 bytes a word and
doubling round). Null text: like an empty one, no runs and an empty collapsed text.
Null doc_id and repeated rows: each row is answered. Empty table: no rows. Extra
columns are ignored; ties between runs don't matter, since all are returned."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import gather, strings_at, text_slices, word_spans

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def shortest_prefix(least: int, power: int) -> int:
    """The fewest words that two suffixes one period apart share in a run."""
    return min(max(least - q, (power - 1) * q) for q in range(1, least + 1))


def may_run(words: np.ndarray, text: np.ndarray, least: int, power: int) -> np.ndarray:
    """Numbers of the texts that may hold a run (``text``: each word's text)."""
    size = shortest_prefix(least, power)
    if len(words) < size:
        return np.zeros(0, np.int64)
    n = len(words) - size + 1
    code = text[:n].astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[k:k + n].astype(np.uint64) + np.uint64(1)
        code *= np.uint64(0x94D049BB133111EB)
    at = np.flatnonzero(text[:n] == text[size - 1:])
    order = at[np.argsort(code[at], kind="stable")]
    same = code[order[1:]] == code[order[:-1]]
    same &= text[order[1:]] == text[order[:-1]]
    again = np.concatenate([same[1:] & same[:-1], [False]]) if len(same) else same
    # two places suffice only where a third one would not lie inside the run: (power * q - size) // q < 2
    near = max((q for q in range(1, least + size + 1) if max(least, power * q) - size < 2 * q), default=0)
    hit = same & (again | (np.diff(order) <= near))
    return np.unique(text[order[1:][hit]])


def suffix_order(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order, ranks): all suffixes in order (a suffix ends with its text, whose end
    is ``ends`` for each position), and for each round k the ranks of their first
    2^k words; equal ranks mean equal words inside one text."""
    n = len(words)
    order = np.lexsort((words, ends))
    new = np.concatenate([[True], (words[order[1:]] != words[order[:-1]]) | (ends[order[1:]] != ends[order[:-1]])])
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int32)
    rank[order] = head
    ranks, width = [rank.copy()], 1
    while True:
        shared = np.zeros(n, bool)                    # slots of groups with two or more members
        shared[:-1] |= ~new[1:]
        shared[1:] |= ~new[1:]
        slots = np.flatnonzero(shared)
        if not len(slots):
            return order, ranks
        members = order[slots]
        after = members + width
        inside = after < ends[members]
        second = np.where(inside, rank[np.minimum(after, n - 1)], -1).astype(np.int64)
        key = rank[members].astype(np.int64) * (n + 1) + second + 1
        by = np.argsort(key, kind="stable")
        members, key = members[by], key[by]
        order[slots] = members
        new[slots] = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.maximum.accumulate(np.where(new[slots], slots, 0))
        rank[members] = head
        ranks.append(rank.copy())
        width *= 2


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray], ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, l): neighbours in suffix order that share l >= ``least`` words."""
    level = max(k for k in range(len(ranks)) if 1 << k <= least or k == 0)
    a, b = order[:-1], order[1:]
    close = ranks[level][a] == ranks[level][b]
    a, b = a[close], b[close]
    i, j = a.copy(), b.copy()
    for k in range(len(ranks) - 1, -1, -1):
        ok = (i + (1 << k) <= ends[a]) & (j + (1 << k) <= ends[b])
        ok[ok] = ranks[k][i[ok]] == ranks[k][j[ok]]
        i[ok] += 1 << k
        j[ok] += 1 << k
    keep = i - a >= least
    return a[keep], b[keep], (i - a)[keep]


def kruskal_runs(words: list[int], first: list[int], edges: Iterator[tuple[int, int, int]], least: int, power: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs; ``edges`` come by decreasing length.
    ``first[i]`` is the first position of the text that holds position i."""
    root: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    out = []

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    def seed(i: int, j: int, shared: int) -> None:
        d = j - i
        if shared >= (power - 1) * d and shared + d >= least and (i == first[i] or words[i - 1] != words[j - 1]):
            out.append((i, j + shared, d))

    for a, b, shared in edges:
        a, b = find(a), find(b)
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            large, small = small, large
        at = [bisect_left(large, x) for x in small]
        for k, (x, p) in enumerate(zip(small, at)):
            if p and (not k or at[k - 1] != p):
                seed(large[p - 1], x, shared)
            if p < len(large) and (k + 1 == len(at) or at[k + 1] != p):
                seed(x, large[p], shared)
        if len(small) * 8 < len(large):
            for x, p in zip(reversed(small), reversed(at)):
                large.insert(p, x)
        else:
            large += small
            large.sort()
        root[b] = a
        members[a] = large
    return out


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int, power: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs of all texts, by start, then period; text t
    is words[bounds[t]:bounds[t + 1]]."""
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    chosen = may_run(words, text, least, power)
    if not len(chosen):
        return (np.zeros(0, np.int64),) * 3
    took = sizes[chosen]
    to = np.cumsum(took)
    shift = np.repeat(bounds[chosen] - (to - took), took)
    own = words[np.arange(to[-1]) + shift]
    ends, first = np.repeat(to, took), np.repeat(to - took, took)
    prefix = shortest_prefix(least, power)
    a, b, shared = common_prefixes(*suffix_order(own, ends), ends, prefix)
    by = np.argsort(-shared, kind="stable")
    found = kruskal_runs(own.tolist(), first.tolist(), zip(a[by].tolist(), b[by].tolist(), shared[by].tolist()), least, power)
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, end, period = np.array(found, np.int64).T
    by = np.lexsort((period, start))
    start, end, period = start[by], end[by], period[by]
    back = shift[start]
    return start + back, end + back, period


def collapsed_texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, n_docs: int) -> pa.Array:
    """Each text's given words joined by one space."""
    lengths = ends - starts + 1
    last = np.concatenate([doc[1:] != doc[:-1], [True]])[:len(doc)]
    lengths[last] -= 1
    flat = gather(np.append(data, np.uint8(32)), starts, lengths)
    flat[(np.cumsum(lengths) - 1)[~last]] = 32
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=lengths, minlength=n_docs))]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(n_docs, pa.py_buffer(offsets), pa.py_buffer(flat))


def run_batches(batches: Iterator[pa.RecordBatch], least: int, power: int) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in text_slices(batches):
        starts, ends, bounds = word_spans(data, offsets)
        words = strings_at(data, starts, ends).dictionary_encode().indices.to_numpy().astype(np.int64) if len(starts) else np.zeros(0, np.int64)
        a, b, period = find_runs(words, bounds, least, power)
        doc = np.searchsorted(bounds, a, side="right") - 1
        drops = np.zeros(len(words) + 1, np.int64)
        np.add.at(drops, a + period, 1)
        np.add.at(drops, b, -1)
        kept = np.cumsum(drops[:-1]) == 0
        text = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        collapsed = collapsed_texts(data, starts[kept], ends[kept], text[kept], batch.num_rows)
        first = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
        runs = pa.ListArray.from_arrays(pa.array(first), pa.StructArray.from_arrays([pa.array(a - bounds[doc]), pa.array(b - a), pa.array(period)], fields=list(RUN)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(bounds)), runs, collapsed.cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = 6, power: int = 4) -> DataFrame:
    """doc_id, n_words, runs (start, length and period in words, by start, then
    period) and the text without the words that follow the first period of a run,
    for every row of ``docs``. ``power`` is at least 2."""
    if power < 2 or least < 2:
        raise ValueError("a run holds at least two periods and two words")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: run_batches(batches, least, power), SCHEMA)


def repeated_from(text: Column, doc_id: Column) -> Column:
    """The query's texts: one in ten repeats a stretch of its own words to its end
    (start and period follow from the id's CRC), the others stay as they are."""
    h = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, g = F.size(words).cast("long"), F.floor(h / 10)
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (g % 8 + 3))
    block = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    again = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
    out = F.slice(F.concat(F.slice(words, F.lit(1), a.cast("int")), again), F.lit(1), n.cast("int"))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(out, " ")).otherwise(text)
