"""Views and external tables, in plain Spark SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def query_view(df: DataFrame, sql: str, name: str | None = None) -> DataFrame:
    """Run SQL with ``df`` under a view name (``{view}`` in the text), then drop the view."""
    spark = df.sparkSession
    view = name or f"view_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        return spark.sql(sql.replace("{view}", view))
    finally:
        spark.catalog.dropTempView(view)


def create_external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` USING {fmt} LOCATION '{path}'")


def tables_like(spark: SparkSession, pattern: str) -> DataFrame:
    """``SHOW TABLES LIKE``, where ``*`` stands for any text."""
    return spark.sql(f"SHOW TABLES LIKE '{pattern}'")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
