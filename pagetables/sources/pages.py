"""Stored pages and fetch logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.operators.fetchlog import FETCH_LOG_SCHEMA

PAGE_SCHEMA = "url string, html string, status int, headers map<string,string>, fetched_at timestamp"


def read_pages(spark: SparkSession, path: str, format: str = "parquet", schema: str | None = None) -> DataFrame:
    """Pages with at least (url, html).

    parquet and json files hold those columns; with text and binary every file is one page and its path is the url.
    Bytes of a binary file that are no UTF-8 become replacement characters.
    """
    if format == "parquet":
        return spark.read.parquet(path)
    if format == "json":
        return spark.read.schema(schema or PAGE_SCHEMA).json(path)
    if format == "text":
        return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
    if format == "binary":
        files = spark.read.format("binaryFile").load(path)
        return files.select(F.col("path").alias("url"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"))
    raise ValueError(f"unknown page format {format!r}")


def read_fetch_log(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    return spark.read.schema(FETCH_LOG_SCHEMA).format(format).load(path)
