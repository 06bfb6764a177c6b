"""From raw documents to training shards, in five stages.

Every stage is one operator of ``quillstat.llm``, takes the table its predecessor left
and returns a table; ``run`` writes each to the shared folder and reads it again, so a
lost executor costs at most one stage's tasks.

1. Documents without a letter go, and those no nearer to any learned language than zero.
2. Of each group of near-duplicates, by five-word shingles at 80 %, the document with the
   smallest id stays.
3. Documents that hold a benchmark item, copied or edited, go.
4. Sources are mixed to their target weights: documents repeat or drop out.
5. Documents get a shard and a slot in it; copies of a text share a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillstat.llm import decontamination, langid, minhash, mixing, sharding
from quillstat.llm.tables import cut, read

SHINGLE = 5
# Three of the stages run Python on whole texts, which SQL cannot express.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs, shingle=SHINGLE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.deal(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
