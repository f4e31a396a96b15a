"""The registered queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm import cap_filters, conversation_repair, fingerprints, hmm, line_dedup, mixing, near_duplicates, packing, secret_scan, sharding, token_files, toxicity, whitening
from martloom.llm.sql import FAIR_MIX, LINE_DEDUP
from martloom.llm.support import Workspace, prepared, text_of
from martloom.llm.tokens import public_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = Workspace(spark, "token-files").folder("shards")
    token_files.write_token_files(docs, folder, public_path("byte_bpe_50k.json"))
    return token_files.read_digests(spark, folder)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.col("at_least")[0].alias("p_toxic"),
        F.col("at_least")[1].alias("p_severe"),
        "severity",
        "grade",
        (F.col("grade") > 0).alias("toxic"),
    )


def op3_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


def op4_inverted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op5_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = mixing.fair_queue(table(spark, sf_dir, "documents"))
    return queue.select("doc_id", "size", "source_size", "target", "taken")


def op6_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(table(spark, sf_dir, "documents"), hmm.every_seventh())


def op8_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs.select("doc_id", text_of().alias("text")))
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secret_scan.joined_spans("assign", "access", "hex").cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined_spans("assign", "access", "hex", "random").alias("spans"),
        F.size("random").cast("bigint").alias("n_random"),
    )


def op9_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.summaries(conversation_repair.damaged(conversations), conversations)


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_toxicity": op2_toxicity,
    "op3_weighted_sampling": op3_weighted_sampling,
    "op4_inverted_minhash": op4_inverted_minhash,
    "op5_fair_mix": op5_fair_mix,
    "op6_bounded_ring": op6_bounded_ring,
    "op7_hidden_markov": op7_hidden_markov,
    "op8_markov_secrets": op8_markov_secrets,
    "op9_cap_filters": op9_cap_filters,
    "op10_best_fit": op10_best_fit,
    "op11_whitening": op11_whitening,
    "op12_line_dedup": op12_line_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL = {"op5_fair_mix": FAIR_MIX, "op12_line_dedup": LINE_DEDUP}
