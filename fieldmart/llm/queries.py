"""The registered queries ``opN_<name>``: each applies its operator, with
production parameters, to the whole of its table and derives the digest
columns from the operator's outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.llm import (alignment, mixing, neighbours, packing, periodic, quality, quality_model, repair, secrets, sharding, simhash,
                           substring_dedup, toxicity)
from fieldmart.llm.common import table, written
from fieldmart.session import scratch_path

WORD_TOKENIZER, BYTE_TOKENIZER, PIECE_MODEL, END_ID = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model", 2


def tokenizer_path(name: str) -> str:
    """A public tokenizer file; the package is installed on every node."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    path = scratch_path(spark, "tables", spark.sparkContext.applicationId, f"llm-token-ids-{uuid.uuid4().hex}")
    repair.write_ids(table(spark, sf_dir, "documents"), path, tokenizer_path(WORD_TOKENIZER), END_ID)
    return repair.digest(spark, path)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), END_ID, capacity=1024)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.listed("base"), 256).alias("base_sha256"), secrets.listed("all").alias("spans"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op8_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", periodic.repeated_from(F.col("text"), F.col("doc_id")).alias("text"))
    return run_digest(periodic.periodic_runs(docs, least=6, power=4))


def run_digest(found: DataFrame) -> DataFrame:
    """The longest run (ties: smallest start, then period) and the digests."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("often"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    period = -F.col("best.often")
    return best.select("doc_id", "n_runs", (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"), period.alias("period"),
                       F.expr("best.length * 1000 div -best.often").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align_documents(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_MODEL))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    found = alignment.score_links(written(aligned.select(*[c for c in aligned.columns if c != "groups"], digest), "aligned"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_token_ids, op3_best_fit_packing, op4_secret_scan, op5_nearest_neighbours,
    op6_quality_rules, op7_feistel_sharding, op8_curriculum_mixing, op9_simhash_near_dedup, op10_toxicity,
    op11_quality_model, op12_periodic_runs, op13_cross_tokenizer_alignment)}
