"""From raw documents to packed training sequences, stage by stage.

Every stage works on all its predecessor kept. All but the last return the
columns of ``documents``."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartlake.llm import decontam, langid, packing, pii, simhash
from chartlake.llm.common import materialise
from chartlake.sources.tables import load_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; ``lang`` is the language found."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, load_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in training sequences."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal_data", personal_data),
          ("best_fit_packing", best_fit_packing)]
# A tokenizer and trained models are beyond SQL; tests/llm has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read
    again before the next one."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
