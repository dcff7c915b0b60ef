"""The operators as queries over the tables of a folder, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import align, counting, decontaminate, huffman, licenses, lines, packing, quality, simhash, substrings, toxicity, trie, warc
from tidemark.llm.common import table
from tidemark.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string")) % toxicity.FOLDS == 0
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
        F.size("passages").cast("long").alias("n_passages"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = counting.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_fingerprint(F.col("bits")).alias("fingerprint"), "component_id")


def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept")


def op6_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "huffman")
    huffman.write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return huffman.read_ids(spark, folder)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    names = F.sort_array(F.array_distinct(F.transform("found", lambda x: x["license"])))
    return found.select(
        "doc_id",
        "n_blocks",
        F.size("found").cast("long").alias("n_found"),
        F.array_join(names, ",").alias("licenses"),
        F.array_min(F.transform("found", lambda x: x["start"])).cast("long").alias("first_start"),
    )


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a replica that has one byte changed in some records and lacks others, as their page's hash decides."""
    pages = table(spark, sf_dir, "pages")
    good = warc.archive(pages, scratch_dir(spark, "warc"))
    luck = F.pmod(F.xxhash64("page_id"), F.lit(500))
    spoilt = F.concat(F.expr("substring(record, 1, octet_length(record) - 5)"), F.lit(b"?"), F.expr("substring(record, -4)"))
    replica = good.where(luck != 1).withColumn("record", F.when(luck == 0, spoilt).otherwise(F.col("record")))
    folder = scratch_dir(spark, "warc-replica")
    replica.write.option("compression", "zstd").parquet(folder)
    return warc.fixity(spark, good, spark.read.schema(good.schema).parquet(folder))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = decontaminate.scan(documents, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    span = F.transform("spans", lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string")))
    return scanned.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.array_join(span, ",").alias("spans"),
    )


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align.align(table(spark, sf_dir, "documents"), *paths)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


CATALOGUE: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_token_counts,
        op3_harmonic_packing,
        op4_simhash_near_dedup,
        op5_quality_cascade,
        op6_huffman_ids,
        op7_line_dedup,
        op8_license_scan,
        op9_warc_fixity,
        op10_benchmark_decontamination,
        op11_cross_tokenizer_alignment,
        op12_substring_dedup,
        op13_conversation_prefix_trie,
    )
}
