"""Registered queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citespark.llm.ann import nearest
from citespark.llm.decontam import find_leaks
from citespark.llm.katz import score_texts
from citespark.llm.langid import held_out, language_id
from citespark.llm.mixing import mix
from citespark.llm.oracles import ORACLE_SQL  # noqa: F401
from citespark.llm.pii import find_pii
from citespark.llm.repeats import remove_repeats
from citespark.llm.sharding import shard
from citespark.llm.simhash import simhash_components
from citespark.llm.warc import archive_round_trip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"), held_out(7, 2))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"), per_lang=2000, most_rows=40_000)


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), every=50, k=5)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), length=200)


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_table(spark, sf_dir, "documents"), shards=16)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark, _table(spark, sf_dir, "pages")).drop("url")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(_table(spark, sf_dir, "documents"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"), weights=(1, 2, 3), cap=3).drop("source")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_katz": op2_katz,
    "op3_language": op3_language,
    "op4_neighbours": op4_neighbours,
    "op5_decontamination": op5_decontamination,
    "op6_repeats": op6_repeats,
    "op7_shards": op7_shards,
    "op8_warc": op8_warc,
    "op9_pii": op9_pii,
    "op10_mix": op10_mix,
}
