"""The corpus pipeline: five operators, each over all that its predecessor kept.

``STAGES`` lists (name, function).  A function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twosample.llm.bm25_decontam import drop_contaminated
from twosample.llm.catalog import MIX, domain_of_source
from twosample.llm.common import cut, id_remainder
from twosample.llm.hd_langid import drop_unidentified
from twosample.llm.kd_sharding import kd_shards
from twosample.llm.mixing import mix
from twosample.llm.simhash import keep_one_of_each


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that can be told go."""
    return drop_unidentified(docs, train=id_remainder("doc_id", 4) != 2)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the smallest id."""
    return keep_one_of_each(docs, words=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens stay, shared out by weights, each document once."""
    mixed = mix(docs, domain=domain_of_source(), budget=lambda total: total * 4 // 5, epochs=1, keep=docs.columns, **MIX)
    return mixed.filter("copies > 0").select(*[F.col(f"`kept_{c}`").alias(c) for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes."""
    return kd_shards(docs, shards=8)


STAGES = [("language_id", language_id), ("simhash_dedup", simhash_dedup), ("decontaminate", decontaminate),
          ("mix_sources", mix_sources), ("shard", shard)]

# SQL has no SimHash, BM25 or language model; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
