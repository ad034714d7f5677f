"""Corpus pipeline: quality rules, near-duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``docs``, with ``n_chars`` following the text where it changed.
Nulls, empty tables, repeated rows and further columns are handled as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickrisk.llm import chunks, packing, quality, secrets, setsketch
from tickrisk.llm.common import table
from tickrisk.plans.materialize import materialize


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, is the number of code points of ``text``."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the trees (trained on the labelled ones of ``docs``)."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 5-word shingles, similarity 0.8 or more."""
    return setsketch.drop_near_duplicates(docs, size=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document or place has."""
    return _counted(chunks.remove_repeats(docs))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets masked."""
    return _counted(secrets.redact(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of the remaining documents in sequences of 2048 ids."""
    import public_tokenizers
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# trees, sketches and tokenizers are not SQL: the pipeline is tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
