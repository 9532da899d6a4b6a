"""Data-quality reports over article tables or parsed JSON lines. Field columns may be typed or VARIANT."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pagetables.functions.presence import is_present, text_of
from pagetables.functions.text import split_tags, title_prefix

# Report thresholds, field lists and sizes.
LONG_CONTENT_CHARS = 100
OPTIONAL_FIELDS = ("lead", "author", "date_modified", "image_url", "id", "read_time", "section")
FINAL_REPORT_FIELDS = ("lead", "author", "date_modified", "image_url", "id", "read_time")
SAMPLE_ROWS = 3
SAMPLE_TITLE_CHARS = 60
TOP_TAGS_LINES = 10
TOP_TAGS_RECORDS = 15


def _present(df: DataFrame, field: str, rule: str = "truthy") -> Column:
    """Presence of a field; a field the table does not have is missing everywhere."""
    if field not in df.columns:
        return F.lit(False)
    return is_present(F.col(field), df.schema[field].dataType, rule)


def _text(df: DataFrame, field: str) -> Column:
    return text_of(F.col(field), df.schema[field].dataType) if field in df.columns else F.lit(None).cast("string")


def _long_content(df: DataFrame) -> Column:
    return F.coalesce(F.char_length(_text(df, "content")) > LONG_CONTENT_CHARS, F.lit(False))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def summary_lines(lines: DataFrame) -> DataFrame:
    """One row over parsed lines: counts of all lines (blank and bad ones too), percentages of all lines.

    `lines` has `valid` and `non_object` flags and the fields title, content, keywords. An empty file gives null percentages.
    """
    counts = lines.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if("valid").alias("valid_json"),
        F.count_if("non_object").alias("non_object"),
        F.count_if(_present(lines, "title")).alias("with_title"),
        F.count_if(_long_content(lines)).alias("with_content"),
        F.count_if(_present(lines, "keywords")).alias("with_keywords"),
    )
    return counts.withColumns({
        f"{name}_pct": percent(F.col(f"with_{name}"), F.col("total_lines")) for name in ("title", "content", "keywords")
    })


def summary_records(records: DataFrame) -> DataFrame:
    """One row over records: percentages of records, 0 when there are none."""
    counts = records.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_present(records, "title")).alias("with_title"),
        F.count_if(_long_content(records)).alias("with_content"),
        F.count_if(_present(records, "keywords")).alias("with_keywords"),
    ).withColumn("empty_keywords", F.col("total") - F.col("with_keywords"))
    return counts.withColumns({
        f"{name}_pct": F.coalesce(percent(F.col(f"with_{name}"), F.col("total")), F.lit(0.0))
        for name in ("title", "content", "keywords")
    })


def status_bucket(pct: Column) -> Column:
    return F.when(pct == 100, F.lit("ok")).when(pct > 50, F.lit("partial")).otherwise(F.lit("bad"))


def field_completeness(
    records: DataFrame, fields: Sequence[str] = OPTIONAL_FIELDS, presence: str = "filled"
) -> DataFrame:
    """(field, filled, total, empty, pct, status), one row per field, from one pass over the records."""
    counts = records.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(_present(records, f, presence)).alias(f"n_{f}") for f in fields]
    )
    per_field = counts.select(
        "total", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"n_{f}").alias("filled")) for f in fields]))
    )
    pct = F.coalesce(percent(F.col("filled"), F.col("total")), F.lit(0.0))
    return per_field.select(
        "field", "filled", "total", (F.col("total") - F.col("filled")).alias("empty"), pct.alias("pct"), status_bucket(pct).alias("status")
    )


def missing_counts(records: DataFrame, fields: Sequence[str] = ("lead", "author", "date_modified")) -> DataFrame:
    """(field, missing, present) by truthiness."""
    complete = field_completeness(records, fields, presence="truthy")
    return complete.select("field", F.col("empty").alias("missing"), F.col("filled").alias("present"))


def _first_missing(lacking: DataFrame, fields: Sequence[str], order_by: Sequence[str], rows: int) -> DataFrame:
    """What each task has found in its records: per field a row with their number and how many lack the field, and its first `rows` of those.

    `lacking` has absent (a flag per field), the order columns and title. A task keeps `rows` records a field, whatever it reads.
    """
    order = [(c, "ascending") for c in order_by]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[pa.Table | None] = [None] * len(fields)
        missing, total = [0] * len(fields), 0
        for batch in batches:
            total += batch.num_rows
            flags = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(fields))
            held = pa.Table.from_batches([batch.select([*order_by, "title"])])
            for i in range(len(fields)):
                here = held.filter(pa.array(flags[:, i]))
                missing[i] += here.num_rows
                joined = here if best[i] is None else pa.concat_tables([best[i], here])
                best[i] = joined.take(pc.sort_indices(joined, sort_keys=order, null_placement="at_start")[:rows]) if joined.num_rows else best[i]
        for i, found in enumerate(best):
            if total:
                yield from _told(fields[i], missing[i], total, found)

    def _told(field: str, n: int, total: int, found: pa.Table | None) -> Iterator[pa.RecordBatch]:
        size = 0 if found is None else found.num_rows
        columns = [pa.array([field] * (size + 1)), pa.array([False] + [True] * size), pa.array([n] + [0] * size, pa.int64()), pa.array([total] + [0] * size, pa.int64())]
        for name, kind in zip([*order_by, "title"], kinds):
            values = [None] if found is None else [None, *found.column(name).to_pylist()]
            columns.append(pa.array(values, kind))
        yield pa.RecordBatch.from_arrays(columns, names=["field", "sample", "n", "of", *order_by, "title"])

    kinds = [to_arrow_type(lacking.schema[c].dataType) for c in (*order_by, "title")]
    types = ", ".join(f"`{c}` {lacking.schema[c].dataType.simpleString()}" for c in (*order_by, "title"))
    return lacking.select("absent", *order_by, "title").mapInArrow(gather, f"field string, sample boolean, n long, of long, {types}")


def missing_samples(
    records: DataFrame,
    fields: Sequence[str],
    order_by: Sequence[str],
    rows: int = SAMPLE_ROWS,
    title_chars: int = SAMPLE_TITLE_CHARS,
    only_if_at_most: int | None = None,
) -> DataFrame:
    """(field, n_missing, sample_no, title): the first rows without each field, in `order_by` order (nulls first).

    With `only_if_at_most` a field that is missing everywhere is left out, and one missing in more rows than that
    keeps its count but shows no sample (null sample_no and title). The records are read once: every task counts and keeps its first
    `rows` of each field, and only those are shuffled, by field.
    """
    absent = F.array(*[~F.coalesce(_present(records, f), F.lit(False)) for f in fields])
    title = title_prefix(_text(records, "title"), title_chars)
    order = [f"order_{i}" for i in range(len(order_by))]
    named = [F.col(c).alias(name) for c, name in zip(order_by, order)]
    found = _first_missing(records.select(absent.alias("absent"), *named, title.alias("title")), fields, order, rows)
    by_field = Window.partitionBy("field")
    ranked = found.select(
        "field", "sample", "title", F.sum("n").over(by_field).alias("n_missing"), F.sum("of").over(by_field).alias("total"),
        F.row_number().over(by_field.orderBy("sample", *order)).alias("place"), F.count_if(~F.col("sample")).over(by_field).alias("tasks"),
    ).withColumn("sample_no", (F.col("place") - F.col("tasks")).cast("int"))
    samples = F.col("sample") & (F.col("sample_no") <= rows)
    if only_if_at_most is None:
        return ranked.filter(samples).select("field", "n_missing", "sample_no", "title")
    partly = ranked.filter((F.col("n_missing") > 0) & (F.col("n_missing") < F.col("total")))
    shown = F.col("n_missing") <= only_if_at_most
    hidden = ~shown & (F.col("place") == 1)
    return partly.filter(F.when(shown, samples).otherwise(hidden)).select(
        "field", "n_missing", F.when(shown, F.col("sample_no")).alias("sample_no"), F.when(shown, F.col("title")).alias("title"))


def keyword_occurrences(records: DataFrame, keep_empty: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """One row per tag occurrence: the `keep` columns, pos, tag. Keywords that are not text give no tags."""
    keywords = F.nullif(_text(records, "keywords"), F.lit(""))
    return records.select(*keep, F.posexplode(split_tags(keywords, keep_empty)).alias("pos", "tag"))


def _appearance(tags: DataFrame, order_by: Sequence[str]) -> Column:
    """Sort key of an occurrence. One integer column packs into a decimal, which keeps the count a hash aggregation."""
    if len(order_by) == 1 and isinstance(tags.schema[order_by[0]].dataType, (T.IntegerType, T.LongType)):
        return F.col(order_by[0]).cast("decimal(20,0)") * F.lit(2**31).cast("decimal(10,0)") + F.col("pos")
    return F.struct(*order_by, "pos")


def keyword_counts(
    records: DataFrame, order_by: Sequence[str] = (), keep_empty: bool = False
) -> DataFrame:
    """(tag, n) over occurrences, plus `first_seen` when the rows have an order. Partial counts are built before the shuffle."""
    tags = keyword_occurrences(records, keep_empty, order_by)
    first = [F.min(_appearance(tags, order_by)).alias("first_seen")] if order_by else []
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), *first)


def keyword_topk(
    records: DataFrame, k: int, order_by: Sequence[str], keep_empty: bool = False, share: bool = False
) -> DataFrame:
    """The k most frequent tags, ties by first appearance; with `share` also the percentage of records."""
    counts = keyword_counts(records, order_by, keep_empty)
    top = counts.orderBy(F.desc("n"), F.asc("first_seen")).limit(k).select("tag", "n")
    if not share:
        return top
    total = records.agg(F.count(F.lit(1)).alias("total"))
    return top.withColumn("pct", percent(F.col("n"), total.scalar()))


def distinct_keywords(records: DataFrame, keep_empty: bool = False, approximate: bool = False) -> DataFrame:
    tags = keyword_occurrences(records, keep_empty)
    if approximate:
        return tags.agg(F.approx_count_distinct("tag").alias("n_tags"))
    return tags.agg(F.count_distinct("tag").alias("n_tags"))


def store_tag_sketch(records: DataFrame, path: str, keep_empty: bool = False) -> None:
    """Write a sketch of a run's distinct tags, a few kilobytes whatever the run; sketches of runs can be united."""
    keyword_occurrences(records, keep_empty).agg(F.hll_sketch_agg("tag", F.lit(14)).alias("sketch")).write.mode("overwrite").parquet(path)


def distinct_over_runs(sketches: DataFrame) -> DataFrame:
    """(n_tags) over the runs of some stored sketches (column `sketch`), without reading records again; about 1 % off for large counts."""
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("n_tags"))
