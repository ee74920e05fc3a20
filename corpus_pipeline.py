"""Corpus pipeline: five stages over ``documents``, each calling one operator of lakecensus.llm.

Every stage takes (spark, docs, sf_dir), is written as Parquet on the session's shared checkpoint
folder and read back as the next one's input, so a lost executor repeats at most one stage. All
but the last return the columns of ``documents``:

1. language_id      documents without a letter or a clear language go
2. quality_rules    documents that fail a rule of policy ``clean-1`` go
3. near_dedup       one document of each near-duplicate group stays, the smallest doc_id
4. source_mixing    copies and passages by the mix's quotas; what it doesn't take goes
5. packing          sequences of 4096 tokens

Defined cases are those of the operators; empty input gives empty output in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakecensus.llm import langid, minhash, mixing, packing, quality
from lakecensus.llm.common import staged, table, tune
from lakecensus.llm.queries import pieces, tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return langid.accepted_documents(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return minhash.kept_documents(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return pieces(packing.pack(docs, tokenizer_path()))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("packing", pack),
]

# a trained classifier and a tokenizer can't be put into SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
