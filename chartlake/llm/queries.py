"""The registered queries: each applies one operator to its whole table and
derives the columns of its contract from the operator's rows. Oracle SQL (``oracle``)
where SQL can express the rows; the others need an operation SQL lacks (XXH64 with a
seed, code-point spans with a model's, a tokenizer, a trained model) and are compared
with brute force in tests/llm."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import load_table
from . import ann, collocations, decontam, langid, lm, merkle, packing, pii, secrets, shards, simhash, substrings, urlfilter
from .oracle import ORACLE_SQL  # noqa: F401


def op1_simhash_dedup(spark: SparkSession, root: str) -> DataFrame:
    found = simhash.near_duplicates(load_table(spark, root, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op2_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    return secrets.find_secrets(load_table(spark, root, "documents")).drop("found")


def op3_url_filter(spark: SparkSession, root: str) -> DataFrame:
    return urlfilter.filter_urls(load_table(spark, root, "pages"))


def op4_personal_data(spark: SparkSession, root: str) -> DataFrame:
    return pii.find_personal_data(load_table(spark, root, "documents")).drop("found")


def op5_repeated_substrings(spark: SparkSession, root: str) -> DataFrame:
    return substrings.remove_repeats(load_table(spark, root, "documents")).drop("kept", "removed")


def op6_sharding(spark: SparkSession, root: str) -> DataFrame:
    return shards.assign_shards(load_table(spark, root, "documents"))


def op7_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(load_table(spark, root, "documents"))


def op8_nearest_neighbours(spark: SparkSession, root: str) -> DataFrame:
    return ann.nearest(load_table(spark, root, "embeddings"))


def op9_language_id(spark: SparkSession, root: str) -> DataFrame:
    return langid.identify(load_table(spark, root, "documents"))


def op10_decontamination(spark: SparkSession, root: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    found = decontam.find_leaks(load_table(spark, root, "documents"), load_table(spark, root, "benchmark"))
    return found.drop("text_hash")


def op11_merkle_manifest(spark: SparkSession, root: str) -> DataFrame:
    return merkle.manifest(load_table(spark, root, "documents"), merkle.tampered()).drop("version")


def op12_lm_scoring(spark: SparkSession, root: str) -> DataFrame:
    return lm.score_documents(load_table(spark, root, "documents"))


def op13_collocations(spark: SparkSession, root: str) -> DataFrame:
    return collocations.collocations(load_table(spark, root, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_dedup, op2_secret_scan, op3_url_filter, op4_personal_data, op5_repeated_substrings,
    op6_sharding, op7_packing, op8_nearest_neighbours, op9_language_id, op10_decontamination,
    op11_merkle_manifest, op12_lm_scoring, op13_collocations)}
