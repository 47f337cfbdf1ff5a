"""Corpus pipeline over ``documents``: five stages, each written as Parquet and
read again as the next one's input.

1. toxicity: documents that the clause grammar predicts toxic go.
2. near_dedup: one document of each SimHash group stays (4-word shingles, at most
   4 differing bits).
3. secrets: found secrets and linked credential parts are masked in the text.
4. mixing: documents follow the curriculum; a document stands in the output as
   often as the mix takes it (in whole or in part, each time as a row), in order
   of training position.
5. packing: the pieces of the mixed documents and their places in sequences.

Every stage keeps the columns of ``documents`` but the last, which returns the
packed pieces. The stages' own docstrings say how they treat nulls, empty and
very long texts, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fieldmart.llm import mixing, packing, secrets, simhash, toxicity
from fieldmart.llm.common import ship, table
from fieldmart.llm.queries import BYTE_TOKENIZER, END_ID, tokenizer_path
from fieldmart.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.keep_first(docs, shingle=4, max_bits=4)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.training_order(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path(BYTE_TOKENIZER), END_ID, capacity=1024)


STAGES = [("toxicity", drop_toxic), ("near_dedup", near_dedup), ("secrets", mask_secrets), ("mixing", mix_sources), ("packing", pack_sequences)]

#: No SQL: fingerprints, tokens and the learned grammar have no SQL form; tests/llm holds brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    root = scratch_path(spark, "tables", spark.sparkContext.applicationId, f"pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(out)
        docs = spark.read.parquet(out)
    return docs
