"""The registered queries: operators with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, conversation_trie, fill_middle, language_id, license_scan, packing, quality_model, quality_rules, simhash, substring_dedup,
               suffix_dedup, topk, url_filter)
from .common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.verdicts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), window=2048, end_id=1)


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=20, query_every=20, scale=64)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    return bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path).drop("decoded")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, trees).select("doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), size=35)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), size=200)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(conversation_trie.paths(table(spark, sf_dir, "conversations"), family=5, heads=9))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.restore(fill_middle.transform(table(spark, sf_dir, "documents"), seed=7, rate=100, spm_rate=50))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_license_scans, op2_quality_rules, op3_packing, op4_top_k, op5_bpe, op6_quality_classifier,
                                   op7_substring_dedup, op8_simhash, op9_suffix_array, op10_url_filters,
                                   op11_language_id, op12_conversation_trie, op13_fill_middle)}
