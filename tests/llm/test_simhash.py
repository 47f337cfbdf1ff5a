"""Fingerprints and groups against plain Python over all pairs."""

import random
import re

import pytest
import xxhash

from fieldmart.llm import simhash


def slow_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if hs and 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_groups(fps, k):
    """fps: list; the index of the first member of each one's group."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= k and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def some_texts(n=60, seed=1):
    rnd = random.Random(seed)
    words = ["the", "Of", "and", "blé", "run", "Sun", "x", "ÄB", "lane", "to go"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 3, 4, 5, 40, 200]))) for _ in range(n)]
    for i in range(0, n, 3):  # near copies
        w = texts[i].split(" ")
        w[rnd.randrange(len(w))] = "CHANGED"
        texts.append("\n".join(w))
    return texts + ["", None, "  \t\n", texts[0], texts[0].upper(), "one"]


def check(df, rows, k=4):
    fps = [slow_fp(t) for _, t in rows]
    label = slow_groups(fps, k)
    least = {}
    for (i, _), g in zip(rows, label):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    want = sorted((-1 if i is None else i, f"{fp:016x}", -1 if least.get(g) is None else least[g]) for (i, _), fp, g in zip(rows, fps, label))
    got = sorted((-1 if r.doc_id is None else r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", -1 if r.component_id is None else r.component_id) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("limit", [4096, 1])
def test_groups_match_all_pairs(docs_of, limit):
    rows = [(i * 7 % 101, t) for i, t in enumerate(some_texts())]
    check(simhash.near_duplicates(docs_of(rows, extra=["fp", "component", "component_id", "first_id", "node", "least"]), limit=limit), rows)


def test_null_ids_and_repeated_rows(docs_of):
    rows = [(None, "alone in here"), (None, "alone in here"), (3, "a b c d e"), (3, "a b c d e"), (2, "A b C d e"), (None, None), (5, "")]
    check(simhash.near_duplicates(docs_of(rows)), rows)
    kept = sorted((r.doc_id or -1, r.text) for r in simhash.keep_first(docs_of(rows)).collect())
    assert kept == [(-1, "alone in here"), (2, "A b C d e"), (5, "")]


def some_kept(docs_of, rows):
    return sorted(((-1 if r.doc_id is None else r.doc_id, r.text) for r in simhash.keep_first(docs_of(rows)).collect()), key=str)


def test_one_id_on_different_texts_keeps_a_row_of_every_group(docs_of):
    a, b = "alpha beta gamma delta epsilon", "one two three four five six"
    assert some_kept(docs_of, [(5, a), (5, b), (9, b.upper())]) == [(5, a), (5, b)]
    assert some_kept(docs_of, [(0, a.upper()), (1, a), (1, b)]) == [(0, a.upper()), (1, b)]
    assert some_kept(docs_of, [(5, a), (5, a.upper()), (5, a), (7, a)]) == [(5, a.upper())]  # the smallest text
    assert some_kept(docs_of, [(None, a), (None, a.upper()), (None, ""), (None, None), (None, b), (3, b)]) == [(-1, a.upper()), (-1, None), (3, b)]
    texts = some_texts()
    rows = [((None, 0, 4, 4, 4, i % 7)[i % 6], t) for i, t in enumerate(texts)]
    label, groups = slow_groups([slow_fp(t) for _, t in rows], 4), {}
    for (i, t), g in zip(rows, label):
        groups.setdefault(g, []).append((i is None, -1 if i is None else i, t is not None, t or ""))
    assert some_kept(docs_of, rows) == sorted(((g[1], g[3] if g[2] else None) for g in map(min, groups.values())), key=str)


def test_empty_table(docs_of):
    empty = docs_of([(1, "a")]).where("false")
    assert simhash.near_duplicates(empty).collect() == [] and simhash.keep_first(empty).collect() == []


def test_very_long_text():
    words = [f"w{i * i % 977}" for i in range(200_000)]
    text = "  ".join(words)
    assert simhash.fingerprint(text.encode()) == slow_fp(text)


@pytest.mark.parametrize("k,limit", [(3, 1), (4, 1), (4, 64), (5, 1), (2, 4096)])
@pytest.mark.parametrize("least_seen", [32, 2])
def test_links_of_clustered_fingerprints(spark, k, limit, least_seen, monkeypatch):
    monkeypatch.setattr(simhash, "LEAST_SEEN", least_seen)  # 2: postings are found hot before they are gathered
    rnd = random.Random(k)
    fps = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(25):
            fp = centre
            for _ in range(rnd.randrange(9)):
                fp ^= 1 << rnd.randrange(64)
            fps.add(fp)
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    frame = spark.createDataFrame(signed, "fp long")
    assert any(map(len, simhash.hot_postings(frame, len(fps), k, limit))) == (least_seen == 2 and limit == 1)
    found = simhash.connect(simhash.links(frame, k, limit))
    got = {r.node & (1 << 64) - 1: r.component & (1 << 64) - 1 for r in found.collect()}
    label = slow_groups(fps, k)
    groups = {}
    for f, g in zip(fps, label):
        groups.setdefault(g, set()).add(f)
    mine = {}
    for f in fps:
        mine.setdefault(got.get(f, f), set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r.component for r in simhash.connect(edges).collect()} == {0}
