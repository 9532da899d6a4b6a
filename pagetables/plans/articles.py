"""Batch job: stored pages to article files and a table of rejects, with one pass over the pages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.operators.articles import ACCEPTED, distinct_pages, extract_records
from pagetables.plans.workspace import delete_folder, new_folder, store
from pagetables.profile import SiteProfile
from pagetables.sources.jsonl import run_path, write_jsonl

ROW = "_row"


def run_article_job(
    pages: DataFrame,
    profile: SiteProfile,
    as_of: Column | dt.date | str,
    base: str,
    run_ts: dt.datetime,
    item_cap: int | None = None,
    one_per_url: bool = False,
    stages: Sequence[Callable[[DataFrame], DataFrame]] = (),
) -> dict[str, str]:
    """Writes <base>/records (parquet, partitioned by outcome) and <base>/data_<run>.jsonl; returns both paths.

    `rejected_articles` of the stored records gives the rejects with their errors. The HTML scan runs once per page: the records are written, and all else reads what was written.

    `stages` are applied to the accepted articles, in order, before they are written. `item_cap` keeps that many articles, any of them.
    `one_per_url` keeps one record per URL, see `distinct_pages`; `fetched_at` of the pages, if there, decides between equals.
    """
    records_path = f"{base.rstrip('/')}/records/run_ts={run_ts.strftime('%Y-%m-%d_%H-%M-%S')}"
    spark = pages.sparkSession
    timed = [c for c in ("fetched_at",) if one_per_url and c in pages.columns]
    records = extract_records(pages, profile, as_of, keep=timed)
    if one_per_url:
        every = new_folder(spark, "records")
        numbered = store(records.withColumn(ROW, F.monotonically_increasing_id()), every)
        distinct_pages(numbered, ROW).drop(ROW, *timed).write.mode("overwrite").partitionBy("outcome").parquet(records_path)
        delete_folder(spark, every)
    else:
        records.write.mode("overwrite").partitionBy("outcome").parquet(records_path)
    stored = spark.read.parquet(records_path)
    articles_path = run_path(base, run_ts)
    accepted = stored.filter(F.col("outcome") == ACCEPTED)
    for stage in stages:
        accepted = stage(accepted)
    write_jsonl(accepted, articles_path, limit=item_cap)
    return {"records": records_path, "articles": articles_path}
