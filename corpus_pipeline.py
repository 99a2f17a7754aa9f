"""Corpus pipeline over ``documents``: language identification, near-duplicate
removal, secret masking, mixing to target weights, and packing.

Each stage takes all that the one before it kept, written as Parquet and read
again; all but the last return the columns of ``documents``.

Defined cases are those of the operators: null texts have no language and go
with the first stage; repeated rows are one group and one stays; empty input
stays empty through all stages; extra columns are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.llm import langid, mixing, packing, secrets, simhash
from stationkit.llm.common import read_table, written
from stationkit.llm.queries import MIX_WEIGHTS, label_domains


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier accepts."""
    return langid.accepted(docs, langid.train(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    return simhash.one_per_group(docs, shingle=3, max_bits=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secrets.redact_documents(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their rates, which are 1 at most.  A row is known by a
    hash of its id and text, as an id may repeat."""
    keyed = docs.withColumn("_key", F.xxhash64(F.col("doc_id"), F.col("text")))
    labelled = (keyed.select("doc_id", "_key").join(label_domains(read_table(spark, sf_dir, "labels")), "doc_id")
                .select(F.col("_key").alias("doc_id"), "domain"))
    table, _ = mixing.mix_once(keyed.select(F.col("_key").alias("doc_id"), "text"), labelled, MIX_WEIGHTS)
    drawn = (table.where(mixing.chosen_copies(F.col("rate"), F.col("doc_id")) >= 1)
             .select(F.col("doc_id").alias("_key")).distinct())
    return keyed.join(drawn, "_key", "left_semi").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 4096 tokens."""
    return packing.pack_documents(docs, capacity=4096, end_id=1)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("mixing_weights", mixing_weights),
    ("best_fit_packing", best_fit_packing),
]

#: DuckDB SQL for the rows of ``run``: none.  Trained classifiers, 64-bit
#: shingle hashes and tokenizers cannot be put in SQL; tests hold the pipeline
#: against the stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
