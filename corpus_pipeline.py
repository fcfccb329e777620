"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept and returns documents, the last one packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftspark.llm.chains import without_repeats
from liftspark.llm.common import checked_broadcast, stored, unused
from liftspark.llm.drr import pack_mixture
from liftspark.llm.mixture import mixed_documents
from liftspark.llm.nearjoin import near_duplicates
from liftspark.llm.quality import quality_filter

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row of the least id, of null ids last.

    Rows are told apart by stored running numbers, not by their ids: of repeated rows one stays, and an id that names several
    texts loses only those that are duplicates. Rows without a word are no duplicates and all stay.
    """
    (row,) = unused(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    classes = near_duplicates(rows, id=row).select(F.col("doc_id").alias(row), "class_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("first")
    of = stored(classes.join(rows.select("doc_id", row), row), "classes")
    heads = of.groupBy("class_id").agg(first, F.count("*").alias("n")).filter("n > 1").select("class_id", F.col(f"first.{row}").alias("head"))
    # rows that go: those of classes of several rows, but the first
    gone = stored(of.join(heads, "class_id").filter(F.col(row) != F.col("head")).select(row), "gone")
    return rows.join(checked_broadcast(gone), row, "left_anti").select(*docs.columns)


def repeats_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; ``n_chars`` follows."""
    return without_repeats(docs, compare=True).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares, documents repeated where a source is to give more than it has."""
    return mixed_documents(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences in the shares of the mix."""
    return pack_mixture(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", one_of_each_group),
    ("substring_dedup", repeats_removed),
    ("mix_sources", mixed),
    ("pack", packed),
]

#: Tokenisation, chaining and MinHash aren't SQL; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
