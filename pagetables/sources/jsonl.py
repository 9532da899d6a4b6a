"""JSON Lines: lenient and strict reading, bad-line report, article writing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.text import strip
from pagetables.operators.articles import ARTICLE_COLUMNS, ARTICLE_SCHEMA

RUN_STAMP = "%Y-%m-%d_%H-%M-%S"
CORRUPT_COLUMN = "_corrupt"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block_start, seq). Within one file split, `seq` counts up line by line without gaps."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"),
    )


def _parsed(value: Column) -> Column:
    return F.try_parse_json(strip(value))


DEFAULT_FIELDS = (*ARTICLE_COLUMNS, "lead")


def _with_fields(parsed: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    is_object = F.coalesce(F.startswith(F.schema_of_variant("_json"), F.lit("OBJECT")), F.lit(False))
    valid = F.col("_json").isNotNull()
    return parsed.select(
        *columns,
        valid.alias("valid"),
        (valid & ~is_object).alias("non_object"),
        *[F.try_variant_get("_json", f"$['{f}']", "variant").alias(f) for f in fields],
    )


def parse_lines(lines: DataFrame, fields: Sequence[str] = DEFAULT_FIELDS) -> DataFrame:
    """Adds valid, non_object and one VARIANT column per field to lines with a `value` column."""
    return _with_fields(lines.withColumn("_json", _parsed(F.col("value"))), lines.columns, fields)


def parsed_records(lines: DataFrame, fields: Sequence[str] = DEFAULT_FIELDS) -> DataFrame:
    """Only the lines that hold JSON. A filter on the parsed value would parse every line twice, a generator does not."""
    parsed = F.explode(F.array_compact(F.array(_parsed(F.col("value")))))
    return _with_fields(lines.select(*lines.columns, parsed.alias("_json")), lines.columns, fields)


def is_bad_line(value: Column) -> Column:
    return (strip(value) != "") & _parsed(value).isNull()


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, raw) of the lines that are neither blank nor JSON; line_no is the 1-based physical line.

    Line numbers come from line counts per file split, one small row each; the lines themselves are not sorted.
    """
    lines = read_lines(spark, path)
    splits = lines.groupBy("file", "block_start").agg(F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("lines_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    bad = lines.filter(is_bad_line(F.col("value")))
    line_no = F.col("lines_before") + F.col("seq") - F.col("first_seq") + 1
    return bad.join(offsets, ["file", "block_start"]).select("file", line_no.alias("line_no"), F.col("value").alias("raw"))


def read_jsonl(
    spark: SparkSession, path: str | list[str], mode: str = "lenient", schema: T.StructType = ARTICLE_SCHEMA
) -> DataFrame:
    """Typed records. `strict` fails on any bad line; `lenient` keeps its text in `_corrupt` with null fields."""
    if mode == "strict":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if mode == "lenient":
        wide = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
        return spark.read.schema(wide).option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(path)
    raise ValueError(f"mode must be 'lenient' or 'strict', not {mode!r}")


def read_lines_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """For command-line use: a missing file is reported, not raised."""
    try:
        return read_lines(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        print(f"File not found: {path}")
        return None


def write_jsonl(articles: DataFrame, path: str, mode: str = "overwrite", limit: int | None = None) -> None:
    """One JSON object per line, fields in record order, nulls written, text not escaped to ASCII."""
    rows = articles.select(*ARTICLE_COLUMNS)
    if limit is not None:
        rows = rows.limit(limit)
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


def json_line(*columns: str) -> Column:
    """The text `write_jsonl` writes for a row."""
    return F.to_json(F.struct(*(columns or ARTICLE_COLUMNS)), {"ignoreNullFields": "false"})


def run_path(base: str, run_ts: dt.datetime) -> str:
    return f"{base.rstrip('/')}/data_{run_ts.strftime(RUN_STAMP)}.jsonl"
