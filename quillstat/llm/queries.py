"""The registered queries of the operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quillstat.llm import (
    decontamination,
    langid,
    lempelziv,
    lines,
    minhash,
    mixing,
    parsing,
    quality,
    recompression,
    sharding,
    spelling,
    trie,
    vectors,
)
from quillstat.llm.oracle import ORACLE
from quillstat.llm.tables import read


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lempelziv.compare(read(spark, sf_dir, "documents"))


def op3_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parsing.dedup(read(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recompression.dedup(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.link(read(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(read(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.dedup(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link(read(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefixes(read(spark, sf_dir, "conversations"), graft=True)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(read(spark, sf_dir, "documents"), slip=spelling.SLIP)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = (
    op1_decontamination,
    op2_lempel_ziv,
    op3_prefix_free_parsing,
    op4_recompression,
    op5_minhash,
    op6_sharding,
    op7_quality,
    op8_mixing,
    op9_langid,
    op10_line_dedup,
    op11_vectors,
    op12_prefix_trie,
    op13_spelling,
    pipeline,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
