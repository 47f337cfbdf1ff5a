"""Token-id files compressed with Re-Pair grammars, one grammar per shard.

Documents are range-partitioned and sorted by doc_id; a partition is written as
shards of about ``SHARD_TOKENS`` ids, one Parquet row each. Re-Pair replaces
frequent id pairs by nonterminals, round after round: a round counts all
adjacent pairs of the shard (none crosses a document), gives the most frequent
ones a nonterminal each and replaces them at once, where two overlap the more
frequent one, for at most ``ROUNDS`` rounds with an equal share of the free
nonterminals each, or until no pair is frequent. So a rule spans at most 2^ROUNDS
ids; more rounds make the files a few per cent smaller for twice the time. Ids
and nonterminals share one symbol space, so most shards need two bytes a symbol.

Columns of the file: ``part`` and ``at`` place the shard (range partition, ids
before it in the partition); ``doc_ids``, ``doc_tokens`` and ``doc_symbols``
give each document's id, ids and symbols in order; ``rules`` (symbol pairs),
``lengths`` (each rule's expansion length) and ``rounds`` (rules after each
round) are the grammar; ``symbols`` the compressed documents, little-endian.
A document is decoded alone from its own symbols (:func:`read_documents`).

Null or empty text: a document of the end id alone. Null doc_id sorts first;
rows that repeat a doc_id, or have none, stand next to each other in the order of
their texts' hash. Very long texts: a document longer than a shard's share is a shard's
last and stays whole. Empty table: no shards.
Extra columns are ignored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.llm.common import before_each, gather, partitions, text_slices
from fieldmart.llm.tokens import encoder

SHARD_TOKENS = 1_500_000
ROUNDS = 6
#: A pair must be replaced so often in a shard to be worth a rule.
LEAST_USES = 8
FILE = ("part int, at long, n_tokens long, doc_ids array<bigint>, doc_tokens array<int>, doc_symbols array<int>, "
        "base int, width int, rules binary, lengths array<int>, rounds array<int>, symbols binary")
_HASH_BITS = 20


def _positions_of(chosen: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each key its index in ``chosen`` (most frequent first), or len(chosen)."""
    def spot(k):
        return ((k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _HASH_BITS)).astype(np.int64)

    none = len(chosen)
    slots = np.full(1 << _HASH_BITS, none, np.int32)
    slots[spot(chosen)[::-1]] = np.arange(none, dtype=np.int32)[::-1]  # of two in one slot, the more frequent
    index = slots[spot(key)]
    index[np.append(chosen, 0)[index].astype(key.dtype) != key] = none
    return index


def compress(ids: np.ndarray, ends: np.ndarray, base: int, rounds: int = ROUNDS, least: int = LEAST_USES) -> dict:
    """Grammar and symbols of the documents whose ids end at ``ends``."""
    room = (1 << 16) - base if base < (1 << 16) - 256 else 1 << 20
    small = base + room <= 1 << 16
    wide, shift = (np.uint32, np.uint32(16)) if small else (np.uint64, np.uint64(32))
    symbols = ids.astype(wide)
    head = np.zeros(len(symbols) + 1, bool)  # first symbol of a document
    head[ends] = True
    head = head[:-1]
    if len(head):
        head[0] = True
    rules, lengths, after = [], [], []
    size = np.ones(base, np.int32)
    made = 0
    for turn in range(rounds):
        if len(symbols) < 2 or made >= room:
            break
        key = (symbols[:-1] << shift) | symbols[1:]
        inside = ~head[1:]
        ordered = np.sort(key[inside])
        if not len(ordered):
            break
        begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        count = np.diff(np.append(begin, len(ordered)))
        often = np.flatnonzero(count >= least)
        often = often[np.lexsort((ordered[begin[often]], -count[often]))][:-(-(room - made) // (rounds - turn))]
        if not len(often):
            break
        chosen = ordered[begin[often]]
        index = _positions_of(chosen, key)
        index[~inside] = len(chosen)
        before, behind = np.append(np.int32(len(chosen)), index[:-1]), np.append(index[1:], np.int32(len(chosen)))
        hit = np.flatnonzero((index < len(chosen)) & (index < before) & (index <= behind))
        uses = np.bincount(index[hit], minlength=len(chosen))
        worth = uses >= 2
        hit = hit[worth[index[hit]]]
        if not len(hit):
            break
        name = np.cumsum(worth) - 1
        pairs = np.stack([chosen[worth] >> shift, chosen[worth] & wide((1 << int(shift)) - 1)], axis=1)
        rules.append(pairs)
        size = np.append(size, size[pairs].sum(axis=1).astype(np.int32))
        symbols[hit] = (base + made + name[index[hit]]).astype(wide)
        made += len(pairs)
        after.append(made)
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        symbols, head = symbols[keep], head[keep]
    width = 2 if base + made <= 1 << 16 else 4
    rule_rows = np.concatenate(rules) if rules else np.zeros((0, 2), wide)
    starts = np.append(np.flatnonzero(head), len(symbols))
    return {"base": base, "width": width, "rules": rule_rows.astype(f"<u{width}").tobytes(), "lengths": size[base:], "rounds": np.array(after, np.int32),
            "symbols": symbols.astype(f"<u{width}").tobytes(), "doc_symbols": np.diff(starts).astype(np.int32)}


class Grammar:
    """Decoder of one shard's symbols."""

    def __init__(self, base: int, width: int, rules: bytes, lengths: np.ndarray, rounds: np.ndarray):
        self.dtype = f"<u{width}"
        pairs = np.frombuffer(rules, self.dtype).reshape(-1, 2).astype(np.int64)
        self.lengths = np.concatenate([np.ones(base, np.int64), np.asarray(lengths, np.int64)])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat, done = np.arange(base, dtype=np.uint32), 0
        for stop in rounds:  # rules of a round expand to symbols of earlier ones
            children = pairs[done:stop].ravel()
            self.flat = np.append(self.flat, gather(self.flat, self.starts[children], self.lengths[children]))
            done = stop

    def expand(self, symbols: bytes | np.ndarray) -> np.ndarray:
        s = (np.frombuffer(symbols, self.dtype) if isinstance(symbols, bytes) else symbols).astype(np.int64)
        return gather(self.flat, self.starts[s], self.lengths[s])


def _shards(tokenizer: str, end_id: int, shard_tokens: int):
    names = [f.split()[0] for f in FILE.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in FILE.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        code, part = encoder(tokenizer, end_id), TaskContext.get().partitionId()
        held: list[tuple] = []
        held_tokens = at = 0

        def shard():
            nonlocal held, held_tokens, at
            ids = np.concatenate([h[1] for h in held])
            sizes = np.concatenate([h[2] for h in held])
            row = compress(ids, np.cumsum(sizes), code.size) | {
                "part": part, "at": at, "n_tokens": len(ids), "doc_ids": [i for h in held for i in h[0]], "doc_tokens": sizes.astype(np.int32)}
            at += len(ids)
            held, held_tokens = [], 0
            return pa.RecordBatch.from_arrays([pa.array([row[n]], type=schema.field(n).type) for n in names], schema=schema)

        for batch, data, offsets in text_slices(batches):
            ids, ends = code.encode(data, offsets)
            held.append((batch.column("doc_id").to_pylist(), ids, np.diff(ends, prepend=0)))
            held_tokens += len(ids)
            if held_tokens >= shard_tokens:
                yield shard()
        if held:
            yield shard()

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS, parts: int | None = None) -> None:
    """Write the ids of ``docs`` (doc_id, text) in ascending doc_id order."""
    n = parts or partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # rows without an id or of one id may be many: the text's hash cuts them into ranges and fixes their order
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    rows.mapInArrow(_shards(tokenizer, end_id, shard_tokens), FILE).write.mode("overwrite").option("compression", "none").parquet(path)


def _read_batch(batch: pa.RecordBatch) -> Iterator[tuple[dict, Grammar]]:
    for row in batch.to_pylist():
        yield row, Grammar(row["base"], row["width"], row["rules"], row["lengths"], row["rounds"])


def digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    shards = spark.read.parquet(path)
    before = before_each(shards.groupBy("part").agg(F.sum("n_tokens").alias("_n")), "part", "_n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, grammar in _read_batch(batch):
                ids = grammar.expand(row["symbols"])
                sizes = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(sizes)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
                start = row["_before"] + row["at"] + ends - sizes
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(start), pa.array(sizes), pa.array(crc, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row per partition goes to every task, the shards stay where they are
    return shards.join(F.broadcast(before), "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: only their shards' symbols are read
    past the filter, and only their own symbols are expanded."""
    wanted = set(doc_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, grammar in _read_batch(batch):
                symbols = np.frombuffer(row["symbols"], grammar.dtype)
                ends = np.cumsum(row["doc_symbols"])
                for i, doc in enumerate(row["doc_ids"]):
                    if doc in wanted:
                        ids = grammar.expand(symbols[ends[i] - row["doc_symbols"][i]:ends[i]])
                        yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    shards = spark.read.parquet(path).where(F.arrays_overlap("doc_ids", F.array(*[F.lit(int(i)) for i in sorted(wanted)])))
    return shards.mapInArrow(run, "doc_id long, ids array<int>")
