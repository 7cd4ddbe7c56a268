"""The corpus pipeline: five stages over the documents, each written as Parquet and read again.

Every stage works on all rows that the one before kept and returns the columns of documents; the last
returns what was written: doc_id, start, n_tokens, ids_crc32, root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeworks.llm import decontam, mixing, neardup, tokenstore, toxicity
from tapeworks.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(toxicity.training_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.clean_rows(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs, shingle=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenstore.read_store(spark, tokenstore.write_store(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_store", write_tokens),
]

#: The first, second and last stage are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
