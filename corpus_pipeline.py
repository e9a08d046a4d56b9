"""Corpus cleaning over ``documents``: five stages, each stored and reread by the next.

Toxic documents go, one document of each SimHash group stays, documents that hold benchmark
items go, personal data is masked, and what is left is packed into windows of token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import decontaminate, packing, pii, simhash, toxicity
from matchlake.llm.common import saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model learns from the labelled ones."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs, simhash.near_duplicates(docs))


def drop_benchmark_holders(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_holders),
    ("pii", mask_personal_data),
    ("packing", pack_windows),
]

# A learned classifier, SimHash and token ids have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
