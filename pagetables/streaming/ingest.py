"""Incremental page ingest: new page files in, article lines out."""

from __future__ import annotations

import datetime as dt
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pagetables.operators.articles import ACCEPTED, ARTICLE_SCHEMA, extract_records
from pagetables.operators.fetchlog import outcome_counts
from pagetables.profile import SiteProfile
from pagetables.sources.jsonl import read_jsonl, write_jsonl
from pagetables.sources.pages import PAGE_SCHEMA
from pagetables.streaming.ledger import Ledger, Merge, attempt_folder, merge_lines, merge_rows

REPEAT_MICROS = "_repeat_micros"  # column: an article within so much event time of another one of its URL repeats it
DAY_MICROS = 24 * 60 * 60 * 1_000_000


def stream_pages(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: T.StructType | str = PAGE_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def record_stream(
    pages: DataFrame, profile: SiteProfile, as_of: Column | dt.date | str | None = None, delay: str | None = "1 hour"
) -> DataFrame:
    """Records of a page stream with their outcome and errors, stale and rejected ones included; no page is left out, however late.

    By default a page is judged by the day (in UTC) it was fetched, so reruns give the same rows. `delay` is noted on the records
    for `write_record_stream`: a URL gives one article within that much event time (None: every good page gives one).
    """
    fetched_day = F.to_date(F.to_utc_timestamp("fetched_at", F.current_timezone()))
    records = extract_records(pages, profile, fetched_day if as_of is None else as_of, keep_stale=True, keep=["fetched_at"])
    if delay is None:
        return records
    return records.withColumn(REPEAT_MICROS, _span_micros(delay))


def url_key(url: Column) -> list[Column]:
    """128 bits that stand for a URL."""
    return [F.xxhash64(url).alias("k1"), F.xxhash64(url, F.lit(1)).alias("k2")]


def chosen_times(times: DataFrame) -> DataFrame:
    """(row) of the new times that repeat none of their key: no old one within `span` of them on either side, and no chosen one less than `span` before.

    `times` has k1, k2, at, span and row; row is null for old times, which lie in tables of earlier batches. One pass over each
    key's times in order; what waits for a later old time lies within one span, so a task's memory does not grow with a key.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = old = kept = None
        waiting: deque[tuple[int, int, int]] = deque()
        for batch in batches:
            out: list[int] = []

            def settle(until: int | None) -> None:
                nonlocal kept
                while waiting and (until is None or waiting[0][0] + waiting[0][1] <= until):
                    at, span, row = waiting.popleft()
                    if kept is None or at - kept >= span:
                        out.append(row)
                        kept = at

            for k1, k2, at, span, row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (k1, k2) != key:
                    settle(None)
                    key, old, kept = (k1, k2), None, None
                settle(at)
                if row is None:
                    while waiting and at - waiting[-1][0] < waiting[-1][1]:
                        waiting.pop()
                    old = at
                elif old is None or at - old >= span:
                    waiting.append((at, span, row))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["row"])
        last: list[int] = []
        while waiting:
            at, span, row = waiting.popleft()
            if kept is None or at - kept >= span:
                last.append(row)
                kept = at
        yield pa.RecordBatch.from_arrays([pa.array(last, pa.int64())], names=["row"])

    by_key = times.select("k1", "k2", "at", "span", "row").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "at", F.col("row").asc_nulls_first())
    return by_key.mapInArrow(scan, "row long")


def unrepeated(rows: DataFrame, seen: DataFrame, key: str, time: str, span: str, row: str) -> DataFrame:
    """The rows that repeat no row of their key, by event time: see `chosen_times`. `seen` has k1, k2 and at of rows written before.

    `span` is a column of microseconds, `row` one of numbers that tell rows apart. Rows without key or time are no repeats. Equal times
    of a key are one, the row of smallest number. Only hashes, times and numbers are shuffled; rows move only to meet what is chosen, and
    stay where they are if that is small.
    """
    known = rows.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    at = F.unix_micros(F.col(time).cast("timestamp")).alias("at")
    new = known.select(*url_key(F.col(key)), at, F.col(span).alias("span"), F.col(row).alias("row"))
    new = new.groupBy("k1", "k2", "at").agg(F.max("span").alias("span"), F.min("row").alias("row"))
    nothing = F.lit(None).cast("long")
    chosen = chosen_times(new.unionByName(seen.select("k1", "k2", "at", F.lit(0).cast("long").alias("span"), nothing.alias("row"))))
    unknown = rows.filter(F.col(key).isNull() | F.col(time).isNull())
    return known.join(chosen.withColumnRenamed("row", row), row, "left_semi").unionByName(unknown)


SEEN = "k1 bigint, k2 bigint, at bigint, day bigint"


class SeenKeys:
    """The keys and times that a stream has written, as sorted runs by day. A batch reads the days around its own only."""

    def __init__(self, spark: SparkSession, folders: list[str]):
        self._spark, self._folders = spark, folders

    def around(self, low: int | None, high: int | None) -> DataFrame:
        if low is None or not self._folders:
            return self._spark.createDataFrame([], SEEN)
        return self.all().filter(F.col("day").between(low // DAY_MICROS, high // DAY_MICROS))

    def all(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._spark.read.schema(SEEN).parquet(f) for f in self._folders])


def note_seen(rows: DataFrame, key: str, time: str, folder: str) -> None:
    """Write the keys and times of `rows` as one run: by day, sorted."""
    noted = rows.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    at = F.unix_micros(F.col(time).cast("timestamp"))
    sort_seen(noted.select(*url_key(F.col(key)), at.alias("at"), F.floor(at / DAY_MICROS).alias("day"))).write.partitionBy("day").parquet(folder)


def sort_seen(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange("day", "k1").sortWithinPartitions("day", "k1", "k2", "at")


def merge_seen(spark: SparkSession) -> Merge:
    def merge(paths: list[str], target: str) -> None:
        sort_seen(SeenKeys(spark, paths).all()).write.partitionBy("day").parquet(target)

    return merge


def _span_micros(delay: str) -> Column:
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.lit(delay).cast("interval"))


ROW = "_row"


def write_distinct_stream(
    rows: DataFrame, path: str, checkpoint: str, delay: str = "1 hour", time_column: str = "fetched_at", key: str = "url", roll_every: int = 64
) -> StreamingQuery:
    """Write the rows of a stream that repeat no row of their key within `delay` of event time, as Parquet; processes what is there and stops.

    Nothing is lost however late it comes: there is no watermark. What was written is remembered in tables by day, of which a batch reads those
    around its own rows. `read_committed(spark, checkpoint, "rows")` gives what was written.
    """
    spark = rows.sparkSession
    ledger = Ledger(spark, f"{checkpoint}/log", roll_every)
    seen, span = f"{checkpoint}/seen", "_span"

    def write(batch: DataFrame, number: int) -> None:
        state = ledger.committed()
        if state.holds(number):
            return
        batch = batch.withColumns({ROW: F.monotonically_increasing_id(), span: _span_micros(delay)}).persist()
        at = F.unix_micros(F.col(time_column).cast("timestamp"))
        low, high = batch.agg(F.min(at - F.col(span)), F.max(at + F.col(span))).first()
        first = unrepeated(batch, SeenKeys(spark, state.folders.get("seen", [])).around(low, high), key, time_column, span, ROW).persist()
        folders = {"rows": attempt_folder(path, number), "seen": attempt_folder(seen, number)}
        first.drop(ROW, span).write.parquet(folders["rows"])
        note_seen(first, key, time_column, folders["seen"])
        ledger.commit(number, folders)
        ledger.roll_up({"rows": (path, merge_rows(spark)), "seen": (seen, merge_seen(spark))})
        first.unpersist()
        batch.unpersist()

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_committed(spark: SparkSession, checkpoint: str, kind: str, schema: T.StructType | str) -> DataFrame:
    """Rows of whole batches of a stream's Parquet output."""
    folders = Ledger(spark, f"{checkpoint}/log").committed().folders.get(kind)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_articles(spark: SparkSession, checkpoint: str, mode: str = "strict") -> DataFrame:
    """The articles of whole batches of a record stream."""
    folders = Ledger(spark, f"{checkpoint}/log").committed().folders.get("articles")
    return read_jsonl(spark, folders, mode) if folders else spark.createDataFrame([], ARTICLE_SCHEMA)


def read_rejects(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """The other records of whole batches; None before the first one."""
    folders = Ledger(spark, f"{checkpoint}/log").committed().folders.get("rejects")
    return spark.read.parquet(*folders) if folders else None


def write_record_stream(
    records: DataFrame, articles: str, rejects: str, checkpoint: str, stages: Sequence[Callable[[DataFrame], DataFrame]] = (), roll_every: int = 64
) -> StreamingQuery:
    """Accepted articles as JSON Lines, all other records with outcome and errors as Parquet; processes what is there and stops.

    `stages` change the accepted articles. Repeated articles of a URL are left out (see `record_stream` and `unrepeated`); every other record
    is written. A batch counts once all its folders are committed (see `ledger`): `read_articles` and `read_rejects` show whole batches
    only, and a batch that is repeated after a failure counts once.
    """
    spark = records.sparkSession
    ledger = Ledger(spark, f"{checkpoint}/log", roll_every)
    seen = f"{checkpoint}/seen"
    once = REPEAT_MICROS in records.columns

    def first_of(accepted: DataFrame, folders: list[str]) -> DataFrame:
        at = F.unix_micros("fetched_at")
        low, high = accepted.agg(F.min(at - F.col(REPEAT_MICROS)), F.max(at + F.col(REPEAT_MICROS))).first()
        return unrepeated(accepted, SeenKeys(spark, folders).around(low, high), "url", "fetched_at", REPEAT_MICROS, ROW)

    def write(batch: DataFrame, number: int) -> None:
        state = ledger.committed()
        if state.holds(number):
            return
        batch = batch.withColumn(ROW, F.monotonically_increasing_id()).persist()
        accepted = batch.filter(F.col("outcome") == ACCEPTED)
        folders = {"articles": attempt_folder(articles, number), "rejects": attempt_folder(rejects, number)}
        if once:
            accepted = first_of(accepted, state.folders.get("seen", [])).persist()
            folders["seen"] = attempt_folder(seen, number)
            note_seen(accepted, "url", "fetched_at", folders["seen"])
        staged = reduce(lambda df, stage: stage(df), stages, accepted.drop(REPEAT_MICROS, ROW))
        write_jsonl(staged, folders["articles"])
        batch.filter(F.col("outcome") != ACCEPTED).drop(REPEAT_MICROS, ROW).write.parquet(folders["rejects"])
        ledger.commit(number, folders)
        merges = {"articles": (articles, merge_lines(spark)), "rejects": (rejects, merge_rows(spark)), "seen": (seen, merge_seen(spark))}
        ledger.roll_up({kind: merges[kind] for kind in folders})
        accepted.unpersist()
        batch.unpersist()

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_articles(
    spark: SparkSession, source: str, sink: str, rejects: str, checkpoint: str, profile: SiteProfile, format: str = "parquet"
) -> StreamingQuery:
    return write_record_stream(record_stream(stream_pages(spark, source, format), profile), sink, rejects, checkpoint)


def outcome_counts_by_window(classified: DataFrame, window: str = "1 hour") -> DataFrame:
    """Fetch outcomes per host and time window, of a table or of one batch of a stream."""
    return outcome_counts(classified, F.window("ts", window).alias("window"))


def _sum_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("window", "outcome", "host").agg(F.sum("n").alias("n"))


def write_window_counts(classified: DataFrame, path: str, checkpoint: str, window: str = "1 hour", roll_every: int = 64) -> StreamingQuery:
    """Write each batch's own counts and commit them. There is no watermark and no state: an event counts in its window however late it
    comes, and once, also when its batch is repeated. `read_window_counts` adds the batches up; after `roll_every` of them they are added
    up in place, so that reading does not grow with the batches ever run.
    """
    spark = classified.sparkSession
    ledger = Ledger(spark, f"{path}/log", roll_every)

    def write(batch: DataFrame, number: int) -> None:
        if ledger.committed().holds(number):
            return
        folder = attempt_folder(f"{path}/counts", number)
        outcome_counts_by_window(batch, window).write.parquet(folder)
        ledger.commit(number, {"counts": folder})
        ledger.roll_up({"counts": (f"{path}/counts", merge_rows(spark, _sum_counts))})

    return classified.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_window_counts(spark: SparkSession, path: str) -> DataFrame:
    """The count so far of every window, host and outcome, open windows included."""
    folders = Ledger(spark, f"{path}/log").committed().folders.get("counts")
    schema = "window struct<start:timestamp,end:timestamp>, outcome string, host string, n bigint"
    return _sum_counts(spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema))
