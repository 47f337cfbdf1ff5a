"""Runs, collapsed texts and the query's digests against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmart.llm import periodic
from fieldmart.llm.queries import run_digest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_runs(w, least=6, power=4):
    out, n = [], len(w)
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if w[i] == w[i + q]:
                j = i
                while j + q < n and w[j] == w[j + q]:
                    j += 1
                size = j - i + q
                if size >= max(least, power * q) and not any(all(w[t] == w[t + d] for t in range(i, i + size - d)) for d in range(1, q)):
                    out.append((i, size, q))
                i = j
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_kept(w, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def some_words(rnd):
    w = [rnd.randrange(rnd.choice([1, 2, 3, 9])) for _ in range(rnd.randrange(60))]
    for _ in range(rnd.choice([0, 1, 3])):
        block = [rnd.randrange(6) for _ in range(rnd.randrange(1, 8))]
        at = rnd.randrange(len(w) + 1)
        w[at:at] = (block * 8)[:rnd.randrange(len(block) * 8)]
    return w


@pytest.mark.parametrize("least, power", [(6, 4), (2, 2), (5, 3), (9, 2), (12, 4)])
def test_runs_match_plain_search(least, power):
    rnd = random.Random(least * 10 + power)
    for _ in range(300):
        texts = [some_words(rnd) for _ in range(rnd.randrange(1, 5))]
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        start, end, period = periodic.find_runs(np.array([x for t in texts for x in t], np.int64), bounds, least, power)
        got = list(zip(start.tolist(), (end - start).tolist(), period.tolist()))
        assert got == [(int(bounds[k]) + s, n, q) for k, t in enumerate(texts) for s, n, q in slow_runs(t, least, power)]


def test_long_repeats_in_one_text():
    for w, want in ((np.zeros(50_000, np.int64), (0, 50_000, 1)), (np.arange(60_000) % 7_000, (0, 60_000, 7_000))):
        start, end, period = periodic.find_runs(w, np.array([0, len(w)]), 6, 4)
        assert [(start[0], end[0] - start[0], period[0])] == [want] and len(start) == 1


def test_power_below_two_is_refused(docs_of):
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs_of([(1, "a")]), power=1)


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_query_digests(docs_of, odd_rows):
    rnd = random.Random(3)
    rows = [*odd_rows, *[(i, " ".join("abcdef"[x % 6] for x in some_words(rnd)), None) for i in range(200, 330)], (331, "one ünder " * 9, None)]
    docs = docs_of(rows).select("*", F.lit(1).alias("runs"), F.lit(2).alias("collapsed"))
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 5
    source = docs.select("doc_id", periodic.repeated_from(F.col("text"), F.col("doc_id")).alias("text"))
    got = run_digest(periodic.periodic_runs(source)).collect()
    want = []
    for doc_id, text, *_ in rows:
        w = planted(doc_id, text)
        runs = slow_runs(w) if len(w) < 5000 else [tuple(r) for r in long_runs(w)]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(slow_kept(w, runs).encode()).hexdigest()))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([tuple(r) for r in got], key=key) == sorted(want, key=key)
    assert any(r[1] > 1 for r in want)


def long_runs(w):
    """The same for a long text: stretches that agree with their own shift by q."""
    a = np.array([hash(x) for x in w])
    out = []
    for q in range(1, len(a) // 4 + 1):
        same = np.flatnonzero(a[q:] != a[:-q])
        edge = np.concatenate([[-1], same, [len(a) - q]])
        for k in np.flatnonzero(np.diff(edge) - 1 >= max(6 - q, 3 * q)):
            s, size = int(edge[k]) + 1, int(edge[k + 1] - edge[k] - 1 + q)
            if not any(t <= s and s + size <= t + m for t, m, _ in out):
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_empty_table(docs_of, spark):
    empty = docs_of([(1, "a")]).where("false")
    assert run_digest(periodic.periodic_runs(empty)).collect() == []
