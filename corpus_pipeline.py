"""Corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination and mixing, one stage after the other.

Each stage takes all documents that the one before kept and its decisions take effect: documents go, or lose lines, or get
a number of copies. All but the last return the columns of ``documents``, in their order; other columns are not carried on,
whatever their names. A stage's table is written to the shared folder, and the one before it removed once it is.

Nulls: a null text is empty, so the language stage drops it; a null source is a source of its own in the mix; a null doc_id
orders first in line dedup and last in near-dedup; null lang and n_chars change nothing. Of repeated rows near-dedup keeps
one; different texts that share an id are decided on each. Ties stand in the operators' modules. Empty tables pass through all stages; texts may be of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.llm import common, decontam, language_id, line_dedup, mixing, simhash_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose language scores less goes, as do those without letters. Half-known text scores 0.5 and over, letters
#: drawn at random under 0.2.
LEAST_SCORE = 0.25


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters (``und``) or without any likely language."""
    model = language_id.fit(docs, ~language_id.held_out())
    named = language_id.identify(docs.select(COLUMNS), model, keep_text=True)
    return named.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines out of documents that stand in an earlier document; n_chars follows the text."""
    out = line_dedup.drop_lines(docs.select(COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate component: that with the smallest id, null ids last."""
    return simhash_dedup.keep_one(docs.select(COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark item stands."""
    return decontam.clean(docs.select(COLUMNS), common.table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document: doc_id, source, size, source_size, target, taken."""
    return mixing.mix(mixing.sized_documents(docs))


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: SQL has neither the language model, nor the fingerprints, nor the edit matching: tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = common.shared_dir(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                common.remove(spark, before)
            before = path
    return docs
