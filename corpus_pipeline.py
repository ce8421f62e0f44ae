"""The corpus pipeline: classifier, rules, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; ``run`` writes every stage as Parquet to the shared folder and
reads it again, so a lost executor costs at most one stage. All stages but the
last return the columns of ``documents``, under any further columns' names too.

Null doc_ids, repeated rows, empty and very long texts pass as the operators
define: every stage works on whole texts, and an empty table gives empty stages.
ORACLE_SQL is None: the classifier's trees and XXH64 fingerprints have no SQL;
tests compare rules, near-duplicates and repeated passages with brute force on
their own inputs, the classifier and packing with their operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm import packing, quality_model, quality_rules, simhash, suffix_dedup
from barline.llm.common import table
from barline.llm.queries import tokenizer_path
from barline.session import stored

ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier predicts to be good. The trees learn
    from the labelled rows of the stage's own documents."""
    trees = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, trees, whole_rows=True).filter("predicted = 1").select("row.*")


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that no quality rule rejects."""
    return quality_rules.kept_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the one whose doc_id is the group's
    least (of a group without any doc_id, one). Rows are told apart by doc_id and
    text, so a doc_id in two groups stands in both."""
    leaders = stored(simhash.leaders(docs, shingle=3, max_bits=3), "leaders").select(F.col("doc_id").alias("leader"), "key", "key2", "n")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id",
                       *[x.alias(f"own_{c}") for c, x in simhash.text_keys(F.col("text")).items()])
    same = F.col("doc_id").eqNullSafe(F.col("leader")) & (F.col("own_key") == F.col("key")) & (F.col("own_key2") == F.col("key2"))
    kept = rows.join(leaders, same)
    once = kept.filter("n = 1").select("row.*")
    if leaders.filter("n > 1").isEmpty():
        return once
    again = kept.filter("n > 1").groupBy("doc_id", "key", "key2").agg(F.first("row").alias("row"))
    return once.union(again.select("row.*"))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its text without the repeated passages; n_chars follows the text."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = suffix_dedup.remove_repeats(docs, size=200, keep_text=True, extra=others)
    source = {c: F.col(f"extra.`{c}`") for c in others} | {"doc_id": F.col("doc_id"), "text": F.col("kept_text")}
    if "n_chars" in others:
        source["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return kept.select(*[source[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048, one row per piece."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), window=2048, end_id=1)


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
