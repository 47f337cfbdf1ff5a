"""Reproducible shuffle into shards by a Feistel permutation.

Rows get dense global numbers in doc_id order. A balanced Feistel network over
2h bits, the smallest even width whose domain holds all row numbers, permutes
the domain; a value outside the numbers in use is encrypted again until it falls
inside (cycle walking), which keeps the map a bijection. The permuted position
gives shard and slot by division, so any row's place can be computed from its
number alone, and shard sizes differ by one row at most (law ``rows``).

Null text: size 1, crc32 of no bytes. Null doc_id sorts first; rows that tie on
doc_id are ordered by crc32 and size. Repeated rows: each has its own place.
Very long texts: one row like any other. Empty table: no rows. Extra columns are ignored."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import number_rows

ROUNDS = 6


class Feistel:
    """A permutation of 0..n-1, fixed by the seed."""

    def __init__(self, n: int, seed: int):
        self.n = n
        self.half = np.uint64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        self.keys = np.random.default_rng(seed).integers(0, 1 << 63, ROUNDS, dtype=np.uint64)

    def _mix(self, right: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (right ^ key) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) & self.mask

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._mix(right, key)
        return (left << self.half) | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ self._mix(left, key), left
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        out = step(np.asarray(x, np.uint64))
        while len(at := np.flatnonzero(out >= self.n)):
            out[at] = step(out[at])
        return out.astype(np.int64)

    def position(self, row: np.ndarray) -> np.ndarray:
        return self._walk(row, self._once)

    def row(self, position: np.ndarray) -> np.ndarray:
        """The row that stands at a position."""
        return self._walk(position, self._back)


def shard(rows: DataFrame, order: list[str], shards: int = 16, seed: int = 7) -> DataFrame:
    """``rows`` with row_number, position, shard and slot. All columns are
    shuffled once, so keep them narrow and join wide ones by key."""
    numbered = number_rows(rows, order, "shard-rows")
    n = numbered.count()
    network = Feistel(n, seed)

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(network.position(row.to_numpy()))

    return (numbered.withColumn("position", place("row_number"))
            .withColumn("shard", F.pmod("position", F.lit(shards)).cast("int"))
            .withColumn("slot", F.floor(F.col("position") / shards) if n < 1 << 52 else F.expr(f"position div {shards}")))


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, row_number, position, shard, slot per document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return shard(rows, ["doc_id", "text_crc32", "size"], shards, seed)
