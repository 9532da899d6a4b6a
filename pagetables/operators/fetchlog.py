"""Fetch logs: what became of each request, counts of outcomes, latest state per URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.urls import drop_trailing_slashes, url_host
from pagetables.profile import SiteProfile

FETCH_LOG_SCHEMA = T.StructType([
    T.StructField("requested_url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("final_url", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("error", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

# Statuses that mean a block, status reported for failures, header spellings removed.
BLOCK_STATUSES = (403, 503)
FAILED_STATUS = 504
DROPPED_HEADERS = ("Content-Encoding", "content-encoding")

PASSTHROUGH, OK, BLOCK, SOFT_BAN, ERROR = "passthrough", "ok", "block", "soft_ban", "error"


def fetch_outcome(profile: SiteProfile) -> Column:
    url = F.col("requested_url")
    home = drop_trailing_slashes(F.col("final_url")).isin(*profile.homepages) if profile.homepages else F.lit(False)
    return (
        F.when(~F.contains(url, F.lit(profile.scope)), F.lit(PASSTHROUGH))
        .when(F.col("error").isNotNull(), F.lit(ERROR))
        .when(F.contains(url, F.lit(profile.section_mark)) & home, F.lit(SOFT_BAN))
        .when(F.col("status").isin(*BLOCK_STATUSES), F.lit(BLOCK))
        .otherwise(F.lit(OK))
    )


def clean_headers(headers: Column) -> Column:
    """Drop the encoding header in its two exact spellings; other spellings stay."""
    return F.map_filter(headers, lambda name, _: ~name.isin(*DROPPED_HEADERS))


def classify_fetches(log: DataFrame, profile: SiteProfile) -> DataFrame:
    """Adds outcome, effective_status (504 for every failure) and page_url (the final URL only on success)."""
    failed = F.col("outcome").isin(BLOCK, SOFT_BAN, ERROR)
    return log.withColumn("outcome", fetch_outcome(profile)).withColumns({
        "effective_status": F.when(failed, F.lit(FAILED_STATUS)).otherwise(F.col("status")),
        "page_url": F.when(F.col("outcome") == OK, F.col("final_url")).otherwise(F.col("requested_url")),
    })


def outcome_counts(classified: DataFrame, *extra_keys: Column) -> DataFrame:
    """Requests per outcome and requested host; extra keys, such as a time window, come first."""
    return classified.groupBy(*extra_keys, "outcome", url_host(F.col("requested_url")).alias("host")).agg(
        F.count(F.lit(1)).alias("n")
    )


def latest_outcome(classified: DataFrame) -> DataFrame:
    """The last attempt per requested URL. Ties in time go to the greater (effective_status, page_url, outcome), nulls lowest.

    Time and status make one number, so that attempts are counted and the last one is found by a hash aggregation in fixed-width buffers.
    Only attempts that are last by both are looked at again; several of one URL are rare, and the join spreads them by URL and number.
    """
    micros = F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(-(1 << 62)))
    status = F.coalesce(F.col("effective_status") + 1, F.lit(0))
    number = (micros.cast("decimal(19,0)") * F.lit(10**10).cast("decimal(11,0)") + status.cast("decimal(10,0)")).cast("decimal(38,0)")
    numbered = classified.select("requested_url", "ts", "effective_status", "page_url", "outcome", number.alias("number"))
    best = numbered.groupBy("requested_url").agg(F.max("number").alias("number"), F.count(F.lit(1)).alias("attempts"))
    last = numbered.alias("n").join(best.alias("b"), F.col("n.requested_url").eqNullSafe(F.col("b.requested_url")) & (F.col("n.number") == F.col("b.number")))
    tied = F.collect_set(F.struct("n.page_url", "n.outcome")).alias("tied")
    found = last.groupBy("b.requested_url", "b.number", "b.attempts", "n.ts", "n.effective_status").agg(tied).withColumn("last", F.array_max("tied"))
    return found.select("requested_url", "ts", "last.outcome", "effective_status", "last.page_url", "attempts")
