"""Corpus pipeline: quality rules, quality classifier, near-duplicate join, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept; all but the
last return the columns of documents. Nulls, empty texts, repeated rows and empty tables pass as the operators'
docstrings say; of equal rows of a document that is no copy of another, the near-duplicate stage keeps one. run() writes each stage's rows to the shared folder and reads them
again, so a lost executor never reaches behind a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ribospark.llm import jaccard_join, packing, quality_classifier, quality_rules, suffix_dedup
from ribospark.llm.common import materialize, table
from ribospark.llm.tokens import tokenizer_path


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose failure bits pass the policy."""
    return quality_rules.quality_ledger(docs).where("kept").select(*docs.columns)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier takes for good.

    It is fitted on the documents as they were read: behind the rules hardly any bad text is left among the
    unlabelled, and a model that must tell some of them from the positives would reject clean ones.
    """
    model = quality_classifier.fit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.score_documents(docs, model).where("predicted = 1").select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the least doc_id."""
    members, _ = jaccard_join.jaccard_join(docs, all_links=False)
    copies = members.where("doc_id <> component_id").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns).dropDuplicates(["doc_id", "text"])


def repeated_passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds; n_chars follows the text."""
    out = suffix_dedup.dedup_texts(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("ngram_jaccard_join", near_duplicates_stage),
    ("suffix_array_dedup", repeated_passages_stage),
    ("best_fit_packing", packing_stage),
]

#: A fitted classifier and byte-pair tokens have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
