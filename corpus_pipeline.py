"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next one's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citespark.llm.common import store
from citespark.llm.decontam import drop_leaks
from citespark.llm.langid import drop_unknown
from citespark.llm.mixing import mixed_documents
from citespark.llm.neardup import drop_near_duplicates
from citespark.llm.sharding import shard

#: Least share of words with evidence (known, or of known telling n-grams) of a text that is in a learned language.
EVIDENCE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language: 'und' ones and those of too little evidence go."""
    return drop_unknown(docs, EVIDENCE)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) one document stays."""
    return drop_near_duplicates(docs, shingle=5, least=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, a part counting as a whole; those of which it takes no word go."""
    return mixed_documents(docs)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot of every row."""
    return shard(docs, shards=16)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]

#: SQL expresses none of the learned or alignment stages; tests hold their operators against brute force, and the language stage against planted documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
