"""Kept words against all windows of all documents."""

import re

import pytest

from fieldmart.llm import substring_dedup as op

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def slow(rows, window):
    first = {}
    for i, t in rows:
        w = WORDS.findall(t or "")
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = WORDS.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i if i is not None else -1, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [8 << 20, 6000, 300])
def test_matches_all_windows(docs_of, odd_rows, block_bytes):
    rows = [(r[0], r[1]) for r in odd_rows]
    got = op.remove_repeats(docs_of(rows), 13, block_bytes).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == slow(rows, 13)
    for r in got:  # factors are long enough and cover what is removed
        covered = {k for s in r.spans for k in range(s.start, s.end)}
        assert len(covered) == r.n_removed and all(s.end - s.start >= 13 for s in r.spans)


def test_small_window_and_factor_boundaries(docs_of):
    rows = [(1, "a b c d e"), (2, "d e f g"), (3, "a b c d e f g"), (4, "z a b c d e f g h"), (5, "b c d")]
    got = op.remove_repeats(docs_of(rows), 3, 10).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == slow(rows, 3)


def test_many_copies_and_empty_table(docs_of):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(i, text if i % 3 else text + f" tail {i}") for i in range(300)]
    got = op.remove_repeats(docs_of(rows), 13, 2000).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == slow(rows, 13)
    assert op.remove_repeats(docs_of(rows).where("false")).collect() == []
    assert op.remove_repeats(docs_of([(1, None), (2, "")])).count() == 2
