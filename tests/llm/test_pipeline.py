"""The pipeline's stages on their own inputs, and its rows against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from test_row_operators import slow_spans, slow_targets, toxic_table
from test_simhash import slow_fp, slow_groups
from test_tokens import FILES, one_by_one, slow_ids

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rnd = random.Random(9)
    docs, labels = toxic_table(160, seed=4)
    rows = [(i, t, f"s{i % 5}") for i, t in docs]
    clean = [r for r, (_, _, toxic) in zip(rows, labels) if not toxic]
    for k in range(20):  # copies, near copies and secrets
        i, t, s = rnd.choice(clean)
        rows.append((1000 + k, t, s))
        rows.append((1100 + k, t + " further", s))
        rows.append((1200 + k, t + f" password=hunter2hunter{k} user: bob", s))
    rows += [(2000, None, "s0"), (2001, "", None), (2002, "one", "s1")]
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(full, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, {i: t for i, _, t in labels}


def test_every_stage_against_python(spark, corpus, tmp_path):
    folder, rows, toxic = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == COLUMNS
    bad = {t for i, t, _ in rows if toxic.get(i)}
    first = Counter((r.doc_id, r.text) for r in seen["toxicity"])
    assert first <= Counter((i, t) for i, t, _ in rows)
    gone = Counter((i, t) for i, t, _ in rows) - first
    assert sum(t in bad for _, t in gone) >= 0.9 * sum(bool(x) for x in toxic.values()) and all(t in bad for _, t in gone)
    # near duplicates: the smallest doc_id of each group
    had = sorted(seen["toxicity"], key=lambda r: r.doc_id)
    label = slow_groups([slow_fp(r.text) for r in had], 4)
    want = {had[g].doc_id for g in label}
    assert sorted(r.doc_id for r in seen["near_dedup"]) == sorted(want)

    def masked(t):
        out, at = "", 0
        for a, _, b in slow_spans(t)[1]:
            if a >= at:
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        return None if t is None else out + t[at:]

    assert Counter((r.doc_id, r.text) for r in seen["secrets"]) == Counter((r.doc_id, masked(r.text)) for r in seen["near_dedup"])
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in seen["secrets"]:
        sizes[r.source] += size(r.text)
    goal = slow_targets(sizes)
    mixed, whole = Counter((r.doc_id, r.text) for r in seen["mixing"]), Counter((r.doc_id, r.text) for r in seen["secrets"])
    assert set(mixed) <= set(whole) and max(mixed.values()) <= 2
    for s in sizes:
        words = sum(size(r.text) for r in seen["mixing"] if r.source == s)
        assert goal[s] - 1 <= words <= goal[s] + 1 + max(size(r.text) for r in seen["secrets"] if r.source == s)
    # packing: the pieces of every mixed row, in as many bins as best fit takes one by one
    want, lengths = Counter(), []
    for r, ids in zip(seen["mixing"], slow_ids(FILES[0], [r.text for r in seen["mixing"]])):
        cut = [ids[:(len(ids) - 1) % 1024 + 1]]
        cut += [ids[a:a + 1024] for a in range(len(cut[0]), len(ids), 1024)]
        for p, c in enumerate(cut):
            want[r.doc_id, p, len(c), zlib.crc32(np.array(c, "<u4").tobytes())] += 1
            lengths.append(len(c))
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in seen["packing"]) == want
    assert len({r.sequence_id for r in seen["packing"]}) == len(one_by_one(lengths, 1024))
    ran = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in ran) == want


def test_empty_corpus(spark, corpus, tmp_path):
    folder = corpus[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.collect() == []
