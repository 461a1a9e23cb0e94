"""The queries over the given tables, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import (
    hamming_join,
    host_rules,
    importance,
    jaccard_join,
    license_join,
    line_templates,
    mixing,
    ordinal,
    packing,
    prefix_trie,
    reply_trees,
    sql,
    tag_paths,
    topk,
)
from tallymark.llm.common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicated(table(spark, sf_dir, "documents"))


def op2_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.deduplicated(table(spark, sf_dir, "documents"))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.col("host").alias("source"),
        "host_failed",
        *[F.round(f"rate_{rule}", 9).alias(f"rate_{rule}") for rule in host_rules.RULES],
    )


def pieces(documents: DataFrame) -> DataFrame:
    return packing.packed(documents, tokenizer_path()).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "loss_tokens",
        "row_id",
    )


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return license_join.scanned(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        labels(F.col("base_labels")).alias("base_labels"),
        labels(F.concat("base_labels", "template_labels")).alias("labels"),
        F.round("score", 6).alias("score"),
    )


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.grouped(table(spark, sf_dir, "documents"))


CONTROLS_INSIDE = "</s>[INST] ok [/INST]"


def op7_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROLS_INSIDE), (-7, 1, "assistant", CONTROLS_INSIDE)], "conv_id bigint, turn bigint, role string, text string"
    )
    whole = reply_trees.formatted(reply_trees.chained(given.unionByName(extra)))
    read = whole.withColumn("turns", reply_trees.turns_of(F.col("text"))).withColumn(
        "loss", reply_trees.loss_text(F.col("text"), F.col("loss_spans"))
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("text").cast("bigint").alias("formatted_chars"),
    )


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extracted(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return ordinal.scored(documents, ordinal.fitted(documents, table(spark, sf_dir, "labels")))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_join.grouped(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_line_templates": op2_line_templates,
    "op3_host_rules": op3_host_rules,
    "op4_pack": op4_pack,
    "op5_license_scan": op5_license_scan,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_reply_trees": op7_reply_trees,
    "op8_main_text": op8_main_text,
    "op9_topk": op9_topk,
    "op10_toxicity": op10_toxicity,
    "op11_importance": op11_importance,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_minhash": op13_minhash,
}

#: None for op2, op4, op8 and op10: tests/llm holds these against plain code, round trips and held-out labels.
SQL: dict[str, str] = {
    "op1_mix_sources": sql.OP1,
    "op3_host_rules": sql.OP3,
    "op5_license_scan": sql.OP5,
    "op6_ngram_jaccard": sql.OP6,
    "op7_reply_trees": sql.op7(CONTROLS_INSIDE, reply_trees.BEGIN, reply_trees.END),
    "op9_topk": sql.OP9,
    "op11_importance": sql.OP11,
    "op12_prefix_trie": sql.OP12,
    "op13_minhash": sql.OP13,
}
