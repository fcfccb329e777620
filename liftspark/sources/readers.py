"""Delimited and columnar scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = "\t",
    null_value: str = "NULL",
) -> DataFrame:
    """Text table with a header. Without a schema, types cost a full extra pass."""
    reader = spark.read.option("sep", sep).option("header", True).option("nullValue", null_value)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", base_path: str | None = None) -> DataFrame:
    """A columnar table, or a glob over parts of one below ``base_path``."""
    reader = spark.read.format(fmt)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    return reader.load(path)


def read_first_existing(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame | None:
    """The first path that exists, or ``None``."""
    for path in paths:
        try:
            return read_table(spark, path, fmt)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return None


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def load_pipeline(spark: SparkSession, paths: Sequence[str], fitted: bool = True) -> Pipeline | PipelineModel | None:
    """The first saved pipeline that exists, or ``None``."""
    for path in paths:
        if path_exists(spark, path):
            return PipelineModel.load(path) if fitted else Pipeline.load(path)
    return None


def count_range(spark: SparkSession, n: int) -> int:
    return spark.range(n).count()


def file_layout(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """Files and bytes per partition.

    Lists the files only: their content column is not selected, so not read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.groupBy(partition).agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))
