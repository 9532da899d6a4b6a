"""Pages to article records: candidate chains, recency gate, validation. Narrow work only, no shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.dates import as_day, date_part_text, is_recent, parse_day
from pagetables.functions.jsonld import json_ld_metadata, json_ld_scripts, page_keywords
from pagetables.functions.text import clean_content, first_nonempty, nonempty, read_time, split_tags, strip
from pagetables.functions.urls import url_id
from pagetables.operators.html import Selector, first_text, html_nodes, select_texts, spec_for
from pagetables.profile import SiteProfile, Step

# The article record, in order.
ARTICLE_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "title", "url", "date", "content", "author", "keywords", "section", "date_modified", "image_url", "id",
    )]
    + [T.StructField("read_time", T.IntegerType())]
)
ARTICLE_COLUMNS = ARTICLE_SCHEMA.fieldNames()

STALE = "stale"
REJECTED = "rejected"
ACCEPTED = "accepted"


def _candidates(values: Sequence[Column], steps: Sequence[Step]) -> Column:
    """One ordered list of candidates, passed through the steps; empty ones are dropped."""
    joined = F.concat(F.array().cast("array<string>"), *values)
    stepped = reduce(lambda candidates, step: F.transform(candidates, step), steps, joined)
    return F.filter(stepped, lambda v: v != "")


def _first_of(values: Sequence[Column]) -> Column:
    """First non-empty of several expressions, evaluated in order and only as far as needed."""
    return F.coalesce(*[nonempty(v) for v in values], F.lit(None).cast("string"))


def choose_blocks(texts: Sequence[Column]) -> Column:
    """The first list with any non-blank text, else the last list."""
    *preferred, choice = texts or [F.array().cast("array<string>")]
    for candidate in reversed(preferred):
        choice = F.when(F.exists(candidate, lambda t: strip(t) != ""), candidate).otherwise(choice)
    return choice


# Validation rules: (name, test that marks a faulty row). Order is the order of the reported errors.
Check = tuple[str, Callable[[Callable[[str], Column]], Column]]
ARTICLE_CHECKS: tuple[Check, ...] = (
    ("title_missing", lambda c: c("title").isNull()),
    ("title_blank", lambda c: strip(c("title")) == ""),
    ("url_missing", lambda c: c("url").isNull()),
    ("url_scheme", lambda c: ~F.startswith(c("url"), F.lit("http"))),
    ("date_missing", lambda c: c("date").isNull()),
)


def validation_errors(column: Callable[[str], Column] = F.col, checks: Sequence[Check] = ARTICLE_CHECKS) -> Column:
    return F.array_compact(F.array(*[F.when(faulty(column), F.lit(name)) for name, faulty in checks]))


def with_errors(articles: DataFrame, checks: Sequence[Check] = ARTICLE_CHECKS) -> DataFrame:
    """Strip the title and add `errors ARRAY<STRING>`; a row without errors is a valid article."""
    return articles.withColumn("errors", validation_errors(F.col, checks)).withColumn("title", strip(F.col("title")))


def validate(articles: DataFrame, checks: Sequence[Check] = ARTICLE_CHECKS) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their errors)."""
    checked = with_errors(articles, checks)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def extract_records(
    pages: DataFrame,
    profile: SiteProfile,
    as_of: Column | dt.date | str,
    keep_stale: bool = False,
    checks: Sequence[Check] = ARTICLE_CHECKS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every page that is not too old as an article row plus `outcome` and `errors`.

    `pages` needs `url` and `html`; `as_of` is a day or a column of `pages`. Pages whose JSON-LD already shows them
    to be old are dropped before the HTML scan; the rest of the recency test needs the scanned dates. With
    `keep_stale` those pages stay in the result with outcome `stale`. Columns of `pages` named in `keep` come last.
    """
    sel, steps, rules = profile.selectors, profile.steps, profile.rules
    as_of = as_day(as_of)
    metadata = json_ld_metadata(json_ld_scripts(F.col("html")))

    def may_be_fresh(ld: Column) -> Column:
        published = ld["datePublished"]
        return published.isNull() | is_recent(published, as_of, profile.days_limit)

    # The gate sits inside the generator: a filter on `ld` would be pushed down and parse the JSON-LD once more.
    gated = F.array(metadata) if keep_stale else F.filter(F.array(metadata), may_be_fresh)
    scanned = pages.select("url", "html", *keep, as_of.alias("as_of"), F.explode(gated).alias("ld")).withColumn(
        "nodes", html_nodes(F.col("html"), spec_for(sel.all()))
    )

    nodes, ld = F.col("nodes"), F.col("ld")
    check_date = _first_of([ld["datePublished"], *[first_text(nodes, s) for s in sel.check_date]])
    fresh = F.array_contains(ld["bad_types"], "datePublished") | is_recent(check_date, F.col("as_of"), profile.days_limit)
    scanned = scanned.withColumn("fresh", fresh) if keep_stale else scanned.filter(fresh).withColumn("fresh", F.lit(True))

    def texts(selectors: Sequence[Selector]) -> list[Column]:
        return [select_texts(nodes, s) for s in selectors]

    def pick(field: str, *values: Column) -> Column:
        return first_nonempty(_candidates(values, steps.get(field, ())))

    text_lists = {f"texts_{i}": t for i, t in enumerate(texts(sel.content))}
    fields = scanned.select(
        pick("title", *texts(sel.title)).alias("title"),
        nonempty(F.col("url")).alias("url"),
        pick("date", F.array(ld["datePublished"]), *texts(sel.date)).alias("date"),
        *[column.alias(name) for name, column in text_lists.items()],
        pick("author", F.array(ld["author"]), *texts(sel.author)).alias("author"),
        page_keywords(_first_of([first_text(nodes, s) for s in sel.keywords]), F.col("html")).alias("keywords"),
        nonempty(ld["articleSection"]).alias("section"),
        nonempty(ld["dateModified"]).alias("date_modified"),
        pick("image_url", F.array(ld["image_url"]), *texts(sel.image)).alias("image_url"),
        pick("id", *texts(sel.id), F.array(url_id(F.col("url")))).alias("id"),
        pick("lead", *texts(sel.lead)).alias("lead"),
        ld["bad_types"].alias("bad_types"),
        "fresh",
        *keep,
    )
    blocks = fields.withColumn(
        "blocks", _candidates([choose_blocks([F.col(name) for name in text_lists])], steps.get("content", ()))
    )
    rows = blocks.withColumn(
        "content",
        F.when(F.size("blocks") > 0, clean_content(F.col("blocks"), rules.scam_phrases, rules.cutoff_markers)),
    )
    type_errors = F.transform("bad_types", lambda name: F.concat(F.lit("json_ld_type:"), name))
    checked = rows.withColumn("read_time", read_time(F.col("content"))).withColumn(
        "errors", F.concat(validation_errors(F.col, checks), type_errors)
    )
    outcome = (
        F.when(~F.col("fresh"), F.lit(STALE)).when(F.size("errors") > 0, F.lit(REJECTED)).otherwise(F.lit(ACCEPTED))
    )
    lead = ["lead"] if profile.keep_lead else []
    return checked.withColumn("title", strip(F.col("title"))).select(
        *ARTICLE_COLUMNS, *lead, outcome.alias("outcome"), "errors", *keep
    )


# Microseconds from year 1 to 1970: times of the calendar count from here, in 18 digits.
_FIRST_MICROS = 62_135_596_800_000_000


def _preference(records: DataFrame, row: str) -> Column:
    """A record's place in the order of choice, as one number: outcome, whether it has a time, time, row number."""
    outcome = F.col("outcome")
    rank = F.when(outcome == ACCEPTED, 0).when(outcome == REJECTED, 1).otherwise(2)
    time = F.lit(0).cast("long")
    if "fetched_at" in records.columns:
        timed = records.schema["fetched_at"].dataType
        time = F.unix_micros("fetched_at") if isinstance(timed, T.TimestampType) else F.col("fetched_at").cast("long")
    digits = F.coalesce(time + _FIRST_MICROS, F.lit(10**18 - 1)).cast("decimal(18,0)")
    return (rank.cast("decimal(2,0)") * F.lit(10**18).cast("decimal(19,0)") + digits).cast("decimal(20,0)") * F.lit(10**18).cast("decimal(19,0)") + F.col(row)


def distinct_pages(stored: DataFrame, row: str) -> DataFrame:
    """One record per URL: an accepted one if there is any, else a rejected one; of these the first by `fetched_at`, if that is a column
    (null last), then by `row`, a column of numbers below 10 ** 18 that tells stored records apart. Records without URL all stay.

    URLs are compared as 128-bit hashes, and the choice is one number, so that it is a hash aggregation of narrow rows. What is joined
    with the records are the numbers of those that go; they come by broadcast when they are few, and the records then stay where they are.
    """
    keyed = stored.filter(F.col("url").isNotNull()).select(
        F.xxhash64("url").alias("k1"), F.xxhash64("url", F.lit(1)).alias("k2"), F.col(row).alias("gone"), _preference(stored, row).cast("decimal(38,0)").alias("choice"))
    best = keyed.groupBy("k1", "k2").agg(F.min("choice").alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    gone = keyed.join(best, ["k1", "k2"]).filter("choice > best").select("gone")
    return stored.join(gone, F.col(row) == F.col("gone"), "left_anti")


def accepted_articles(records: DataFrame) -> DataFrame:
    return records.filter(F.col("outcome") == ACCEPTED).drop("outcome", "errors")


def rejected_articles(records: DataFrame) -> DataFrame:
    return records.filter(F.col("outcome") == REJECTED).drop("outcome")


def extract_articles(
    pages: DataFrame, profile: SiteProfile, as_of: Column | dt.date | str
) -> tuple[DataFrame, DataFrame]:
    """(articles, rejects). To write both, write `extract_records` once instead and split what was stored."""
    records = extract_records(pages, profile, as_of)
    return accepted_articles(records), rejected_articles(records)


def typed_view(articles: DataFrame) -> DataFrame:
    """Dates as DATE and keywords as an array, next to the text columns that stay the contract."""
    return articles.withColumns({
        "published_on": parse_day(F.col("date")),
        "modified_on": parse_day(date_part_text(F.col("date_modified"))),
        "tags": split_tags(F.col("keywords")),
    })
