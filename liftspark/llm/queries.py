"""One query for each operator of this folder, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftspark.llm import importance, mixture
from liftspark.llm.bfd import pack_documents
from liftspark.llm.chains import repeated_passages
from liftspark.llm.drr import pack_mixture
from liftspark.llm.nearjoin import near_duplicates
from liftspark.llm.onebit import index, neighbours
from liftspark.llm.quality import quality_verdicts
from liftspark.llm.shards import shard_documents
from liftspark.llm.simhash import near_copies
from liftspark.llm.toxicity import toxicity
from liftspark.llm.trielm import score_texts
from liftspark.llm.whitening import whitened

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op7_mix_sources"] = mixture.SQL


@query
def op8_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


@query
def op10_pack_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_mixture(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids", "source")


@query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"), compare=True)


@query
def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(index(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0)


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


@query
def op11_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


ORACLES["op12_importance_resampling"] = importance.SQL


@query
def op13_simhash_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))
