"""Registered queries of the llm operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcraft.llm import block_labeller, block_max, byte_bpe, conversation_repair, decontaminate, kd_shards, lm_scoring, mixing, near_dup, passages, quality_classifier, token_index
from cohortcraft.llm import quality_rules as rules
from cohortcraft.llm.storage import folder
from cohortcraft.llm.storage import table as read_table
from cohortcraft.llm.workers import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the package's sources reach the workers with the first one."""
    ship_package(spark)
    return read_table(spark, sf_dir, name)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` against whole ``benchmark``: 13-word phrases found by FM-index."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_contaminated(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` in 24 shards of near-equal bytes."""
    placed = kd_shards.shard(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def token_ids(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write ``docs`` as shards under the shared folder and read every document back from them."""
    path = folder(spark, "token-ids")
    token_index.write_shards(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_index.documents_of(token_index.read_shards(spark, path))


def op3_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: ids written in shards with a perfect-hash index and read back by key."""
    return token_ids(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: measures, base rule and verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.quality_rules(docs).select(
        "doc_id", *rules.MEASURES, "base_failed", "kept", "n_stop_words"
    )


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: near-duplicate components at 85 percent of five-word shingles."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _remainder(modulus: int):
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: unigram base score and attention-model score; crc32 mod 7 = 2 is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_scoring.scored(docs, _remainder(7) == 2, public_tokenizers.path("word_bpe_49k.json"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: held-out flag, score and prediction of quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    weights = quality_classifier.fit(docs, labels)
    scored = quality_classifier.scored(docs, weights)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``pages``: the main text by the recurrent block labeller."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return block_labeller.main_text(pages, block_labeller.fit(pages))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: domain posteriors and the rates that meet the target token shares."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: the documents that share passages, with the words that repeat."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = passages.repeated_spans(docs, passages.repeated_windows(docs, paragraphs=True))
    return passages.repeats_by_document(spans).withColumnRenamed("id", "doc_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``conversations``, damaged by the contract's draw: faults, cheapest repair, digest of the repaired turns."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    summaries, turns = conversation_repair.repair(conversation_repair.damaged(rows))
    hashes = conversation_repair.text_hashes(turns)
    ids = rows.select("conv_id").distinct().alias("i")
    same = lambda other: F.col("i.conv_id").eqNullSafe(F.col(f"{other}.conv_id"))
    counts = [F.coalesce(F.col(f"s.{c}"), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(summaries.alias("s"), same("s"), "left").join(hashes.alias("h"), same("h"), "left").select(
        "i.conv_id",
        *counts,
        F.coalesce("s.audit", F.lit("")).alias("audit"),
        F.coalesce("h.repaired_sha256", F.lit(conversation_repair.EMPTY_HASH)).alias("repaired_sha256"),
    )


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: byte-level BPE ids, digests of the ids and of the bytes they decode to."""
    files = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = byte_bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), *files)
    return byte_bpe.decoded(ids.drop("text"), files[0]).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` ranked for every ``benchmark`` item: shards with block maxima, searched by MaxScore."""
    shards = block_max.build(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return block_max.search(shards, table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_kd_tree_sharding": op2_kd_tree_sharding,
    "op3_token_id_output": op3_token_id_output,
    "op4_quality_rules": op4_quality_rules,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_html_extraction": op8_html_extraction,
    "op9_mixing": op9_mixing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_ranked_search": op13_ranked_search,
}
