"""Registered queries: every operator on the given tables, or on pages, lines and logs that Spark derives from them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions import dates, jsonld, text, urls
from pagetables.operators import articles, fetchlog, html, links, quality
from pagetables.plans.articles import run_article_job
from pagetables.plans.crawl import crawl_pages, crawl_reach
from pagetables.plans.workspace import new_folder
from pagetables.profile import NEWS_SITE, CleaningRules, LinkRule, SiteProfile
from pagetables.sources import jsonl
from pagetables.sources.pages import read_fetch_log, read_pages
from pagetables.sources.rules import load_rules
from pagetables.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

PHRASES = ("token =", "pathetic", "License")
MARKERS = ("theren", "ciónza", "auxque")
ARTICLE_DAY = "2026-01-05"
EVENT_DAY = "2024-01-10"

SAMPLE_PROFILE = SiteProfile(
    selectors=NEWS_SITE.selectors,
    link_rules=(
        LinkRule("skip", "drop", allow=(r"/th", r"\.$"), deny_domains=("example.org",)),
        LinkRule("article", "parse", allow=(r"example\.(?:com|net)/[a-z]{2,6}$",), deny=(r"on", r"#")),
        LinkRule("category", "follow", allow=(r"example\.org/[a-z]+$",)),
        LinkRule("pagination", "follow", allow=(r"example.com",), anchor_class_part="next"),
        LinkRule("other", "follow", allow=(r"blog",)),
    ),
    deny_extensions=NEWS_SITE.deny_extensions,
    allowed_domains=("example.com", "thther.example.org"),
    scope="example.com",
    section_mark="wiadomosci",
    homepages=("https://www.example.com", "https://example.com"),
    rules=CleaningRules(PHRASES, MARKERS),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- inputs derived from the given tables -------------------------------------------------------------------------


def _escaped(value: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        value = F.replace(value, F.lit(char), F.lit(entity))
    return value


def _document_day() -> Column:
    return F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("n_chars") % 8).cast("int")), "yyyy-MM-dd")


def _document_scripts() -> Column:
    """JSON-LD script bodies per language: one object, a @graph plus a second script, none, a broken one."""
    day = _document_day()
    whole = F.to_json(F.struct(
        F.concat(day, F.lit("T12:00:00+01:00")).alias("datePublished"),
        F.concat(day, F.lit("T13:00:00+01:00")).alias("dateModified"),
        F.struct(F.concat(F.lit("Author "), F.col("source")).alias("name")).alias("author"),
        F.col("source").alias("articleSection"),
        F.struct(F.concat(F.lit("http://img.example.com/"), F.col("doc_id")).alias("url")).alias("image"),
    ))
    node = F.struct(
        F.concat(day, F.lit("T08:30:00")).alias("datePublished"),
        F.array(F.struct(F.concat(F.lit("First "), F.col("source")).alias("name")), F.struct(F.lit("Second").alias("name"))).alias("author"),
        F.lit("").alias("articleSection"),
    )
    graph = F.concat(F.lit('{"@graph":['), F.to_json(node), F.lit(',{"@type":"WebPage"}]}'))
    second = F.to_json(F.struct(
        F.lit("2000-01-01").alias("datePublished"),
        F.col("source").alias("articleSection"),
        F.concat(F.lit("http://img.example.com/g"), F.col("doc_id")).alias("image"),
    ))
    return (
        F.when(F.col("lang") == "en", F.array(whole))
        .when(F.col("lang") == "fr", F.array(graph, second))
        .when(F.col("lang") == "es", F.array(F.lit('{ broken json "datePublished": "2026-01-05" ')))
        .otherwise(F.array().cast("array<string>"))
    )


def document_pages(documents: DataFrame) -> DataFrame:
    """Each document as an HTML page whose hooks depend on its language."""
    lang = F.col("lang")
    day = _document_day()
    scripts = F.array_join(
        F.transform(_document_scripts(), lambda s: F.concat(F.lit('<script type="application/ld+json">'), s, F.lit("</script>"))), "\n"
    )
    head = (
        F.when(lang == "en", F.concat(
            F.lit('<meta name="keywords" content="en, '), F.col("source"), F.lit('"><meta name="data-story-id" content="doc'), F.col("doc_id"), F.lit('">')))
        .when(lang == "de", F.concat(
            F.lit('<meta property="og:image" content="http://img.example.com/og'), F.col("doc_id"), F.lit('"><script>var c={"keywords": ["de","'), F.col("source"), F.lit('","",null]};</script>')))
        .otherwise(F.concat(F.lit('<script>var c={"keywords":["'), lang, F.lit('","'), F.col("source"), F.lit('"]};</script>')))
    )
    title = F.when(F.col("source") == "src7", F.lit("<h1> </h1>")).otherwise(
        F.concat(F.lit("<h1> Doc "), F.col("doc_id"), F.lit(" &amp; "), lang, F.lit("<small>x</small></h1>")))
    hooks = (
        F.when(lang == "de", F.concat(
            F.lit('<span class="x ods-m-date-authorship__publication">'), day, F.lit(' 10:00</span><a class="ods-m-author-xl__name-link" href="/a">Autor '), F.col("source"), F.lit("</a>")))
        .when(lang == "es", F.concat(
            F.lit('<span class="up-date">'), day, F.lit(' 15:00</span><div class="authorName"> Deep '), F.col("source"), F.lit(" </div>")))
        .otherwise(F.lit('<span class="ods-m-author-xl__name">not used</span>'))
    )
    marked = lang.isin("en", "fr")
    opening = F.when(marked, F.lit('<p class="hyphenate">')).otherwise(F.lit("<p>"))
    body = F.array_join(F.transform(F.split("text", "\n"), lambda line: F.concat(opening, _escaped(line), F.lit("</p>"))), "\n")
    advert = F.when(marked, F.lit("<p>Reklama</p>")).otherwise(F.lit("<div>Reklama</div>"))
    url = F.concat(
        F.when(F.col("source") == "src13", F.lit("ftp://files.example.com/")).otherwise(F.lit("https://wiadomosci.example.com/")),
        F.col("source"), F.lit("/tekst/d"), F.col("doc_id"),
    )
    page = F.concat(F.lit("<html><head>"), scripts, head, F.lit("</head><body>"), title, hooks, advert, body, F.lit("</body></html>"))
    return documents.select("doc_id", url.alias("url"), page.alias("html"))


LINKED_PROFILE = replace(
    SAMPLE_PROFILE,
    link_rules=(
        LinkRule("card", "follow", allow=(r"/p\d+$",), regions=("card",)),
        LinkRule("pagination", "follow", allow=(r"example.com",), anchor_class_part="next"),
        LinkRule("plain", "parse", allow=(r"/p\d+$",)),
    ),
    allowed_domains=("example.com",),
)


def linked_pages(documents: DataFrame) -> DataFrame:
    """A page per document, /p<doc_id>, that links to the pages 2n + 1 and 2n + 2 inside a card, to itself and to its next list page.

    The hrefs take the forms a page may write them in, by doc_id.
    """
    def href(target: Column) -> Column:
        form = F.col("doc_id") % 5
        return (
            F.when(form == 0, F.concat(F.lit("/p"), target)).when(form == 1, F.concat(F.lit("p"), target))
            .when(form == 2, F.concat(F.lit("//example.com/p"), target)).when(form == 3, F.concat(F.lit("https://example.com/p"), target))
            .otherwise(F.concat(F.lit("./x/../p"), target))
        )

    def anchor(target: Column, text: str) -> Column:
        return F.concat(F.lit('<a href="'), href(target), F.lit(f'">{text}</a>'))

    twice = F.col("doc_id") * 2
    page = F.concat(
        F.lit('<html><body><div class="list card"><b>'), anchor(twice + 1, "left"), F.lit("</b>"), anchor(twice + 2, "right"),
        F.lit("</div>"), anchor(F.col("doc_id"), "self"), F.lit('<a class="nav next-page" href="?page=2">more</a></body></html>'),
    )
    return documents.select(F.concat(F.lit("https://example.com/p"), "doc_id").alias("url"), page.alias("html"))


def document_records(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Article-shaped records with gaps: labels give read_time (0 or 1) and are missing for most documents."""
    joined = documents.join(labels, "doc_id", "left")
    source = F.col("source")
    return joined.select(
        "doc_id",
        F.when(source == "src7", F.lit("")).otherwise(F.concat(F.lit("Doc "), "doc_id", F.lit(" "), F.substring_index("text", "\n", 1))).alias("title"),
        F.concat(F.lit("https://wiadomosci.example.com/"), source, F.lit("/tekst/d"), "doc_id").alias("url"),
        _document_day().alias("date"),
        F.col("text").alias("content"),
        F.when(F.col("toxic") == 0, F.concat(F.lit("Author "), source)).when(F.col("toxic") == 1, F.lit("")).alias("author"),
        F.when(F.col("lang") != "es", F.concat(F.col("lang"), F.lit(", "), source, F.lit(",,"), source)).alias("keywords"),
        source.alias("section"),
        F.lit(None).cast("string").alias("date_modified"),
        F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.concat(F.lit("http://img.example.com/"), "doc_id")).alias("image_url"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("quality").cast("int").alias("read_time"),
    )


def record_lines(records: DataFrame) -> DataFrame:
    """The records as JSON lines, some of them spoiled: broken, blank or not an object, depending on the section."""
    line = jsonl.json_line()
    section = F.col("section")
    value = (
        F.when(section == "src5", F.concat(F.lit("{bad "), line))
        .when(section == "src6", F.lit(" \t"))
        .when(section == "src8", F.concat(F.lit("["), line, F.lit("]")))
        .otherwise(F.concat(F.lit("  "), line))
    )
    return records.select("doc_id", value.alias("value"))


def event_fetches(events: DataFrame) -> DataFrame:
    """Events as a fetch log: several attempts per URL, outcome causes by event type."""
    kind = F.col("event_type")
    requested = F.concat(
        F.when(F.col("user_id") % 10 == 0, F.lit("https://other.test/u/")).otherwise(F.lit("https://wiadomosci.example.com/u/")),
        "user_id",
    )
    return events.select(
        "event_id",
        requested.alias("requested_url"),
        F.when(kind == "click", F.lit(403)).when(kind == "purchase", F.lit(503)).otherwise(F.lit(200)).alias("status"),
        F.when(kind == "signup", F.lit("https://www.example.com//")).otherwise(F.concat(requested, F.lit("/final"))).alias("final_url"),
        F.create_map(
            F.lit("Content-Encoding"), kind, F.lit("content-encoding"), F.lit("gzip"), F.lit("CONTENT-ENCODING"), F.lit("br"),
            F.lit("X-Kind"), kind,
        ).alias("headers"),
        F.when(kind == "error", F.col("props")).alias("error"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def shop_edges(lineitem: DataFrame) -> DataFrame:
    """Links between order, part and supplier pages; supplier pages are recorded but not followed."""
    order = F.concat(F.lit("/order/"), "l_orderkey")
    part = F.concat(F.lit("/part/"), "l_partkey")
    supplier = F.concat(F.lit("/supplier/"), "l_suppkey")
    edges = F.array(
        F.struct(order.alias("src"), part.alias("dst"), F.lit(True).alias("follow")),
        F.struct(part.alias("src"), order.alias("dst"), F.lit(True).alias("follow")),
        F.struct(part.alias("src"), supplier.alias("dst"), F.lit(False).alias("follow")),
        F.struct(supplier.alias("src"), part.alias("dst"), F.lit(True).alias("follow")),
    )
    return lineitem.select(F.inline(edges))


# --- queries ------------------------------------------------------------------------------------------------------

_H1, _P, _A = html.by_tag("h1"), html.by_tag("p"), html.by_tag("a")


def _scanned(spark: SparkSession, sf_dir: str, *selectors: html.Selector) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", html.html_nodes(F.col("html"), html.spec_for(selectors)).alias("nodes"))


def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = text.strip_all(html.select_texts(F.col("nodes"), _H1))
    return _scanned(spark, sf_dir, _H1).select("page_id", text.first_nonempty(F.transform(titles, text.remove_tags)).alias("title"))


def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = text.strip_all(html.select_texts(F.col("nodes"), _P))
    return _scanned(spark, sf_dir, _P).select("page_id", F.posexplode(blocks).alias("pos", "text"))


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = F.col("nodes")
    fields = _scanned(spark, sf_dir, _H1, _P).select(
        "page_id",
        "url",
        text.first_nonempty(text.strip_all(html.select_texts(nodes, _H1))).alias("title"),
        urls.url_id(F.col("url")).alias("id"),
        text.clean_content(text.strip_all(html.select_texts(nodes, _P)), PHRASES, MARKERS).alias("content"),
    )
    return fields.withColumn("read_time", text.read_time(F.col("content")))


def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.field_completeness(page_records(spark, sf_dir), ("title", "id", "content", "read_time", "lead"))


def page_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", urls.url_id(F.col("url")).alias("id"))


def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select(
        "page_id",
        urls.url_host(url).alias("host"),
        urls.in_domains(url, SAMPLE_PROFILE.allowed_domains).alias("in_domain"),
        F.contains(url, F.lit(SAMPLE_PROFILE.scope)).alias("in_scope"),
    )


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.extract_links(_table(spark, sf_dir, "pages")).select("src_url", "pos", "href", "dst_url")


def link_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.extract_links(_table(spark, sf_dir, "pages"), SAMPLE_PROFILE.regions())
    return links.route_links(found, SAMPLE_PROFILE).select("src_url", "pos", "dst_url", "rule", "action", "in_domain")


def links_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.routed_page_links(_table(spark, sf_dir, "pages"), SAMPLE_PROFILE)


def crawl_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.crawl_edges(_table(spark, sf_dir, "pages"), SAMPLE_PROFILE)


def crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = _table(spark, sf_dir, "part").agg(F.concat(F.lit("/part/"), F.min("p_partkey")).alias("url"))
    return crawl_reach(shop_edges(_table(spark, sf_dir, "lineitem")), seeds, NEWS_SITE.max_depth)


def page_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return crawl_pages(pages, SAMPLE_PROFILE, pages.select("url"))


def linked_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every href form resolved, and every anchor routed by region, by the class of the anchor or by its place in the rules."""
    found = links.extract_links(linked_pages(_table(spark, sf_dir, "documents")), LINKED_PROFILE.regions())
    return links.route_links(found, LINKED_PROFILE).select("src_url", "pos", "href", "dst_url", "rule", "action")


def linked_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From one page down five levels of pages that link to each other."""
    seeds = spark.createDataFrame([("https://example.com/p0",)], "url string")
    return crawl_pages(linked_pages(_table(spark, sf_dir, "documents")), LINKED_PROFILE, seeds)


LIST_PROFILE = replace(LINKED_PROFILE, link_rules=(LinkRule("list", "follow", allow=(r"/list\?",)),))


def list_pages(documents: DataFrame) -> DataFrame:
    """A page per document, found by its query, that links to the pages 2n + 1 and 2n + 2 and to itself in ever other spellings."""
    def href(target: Column, form: Column) -> Column:
        return (
            F.when(form == 0, F.concat(F.lit("//Example.COM/list?v=a%20b&id="), target))
            .when(form == 1, F.concat(F.lit("/list?id="), target, F.lit("&v=a+b#top")))
            .when(form == 2, F.concat(F.lit("/list?&v=%61%20b&&id="), target))
            .otherwise(F.concat(F.lit("list?v=a b&amp;id="), target, F.lit("#"), "doc_id"))
        )

    twice = F.col("doc_id") * 2
    anchors = [F.concat(F.lit('<a href="'), href(t, (F.col("doc_id") + i) % 4), F.lit('">x</a>')) for i, t in enumerate((twice + 1, twice + 2, F.col("doc_id")))]
    url = F.concat(F.lit("https://example.com/list?v=a+b&id="), "doc_id", F.lit("#page"))
    return documents.select(url.alias("url"), F.concat(F.lit("<html><body>"), *anchors, F.lit("</body></html>")).alias("html"))


def canonical_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reach over pages whose links name them with arguments in another order, other escapes, other case or a fragment."""
    seeds = spark.createDataFrame([("https://EXAMPLE.com/list?id=0&v=a%20b",)], "url string")
    return crawl_pages(list_pages(_table(spark, sf_dir, "documents")), LIST_PROFILE, seeds)


def clean_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = text.strip_all(F.split("text", "\n"))
    return _table(spark, sf_dir, "documents").select("doc_id", text.clean_content(blocks, PHRASES, MARKERS).alias("content"))


def clean_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with no-break spaces, cleaned by the rules of a file: the phrases are the first words of all benchmark lines."""
    lines = _table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", "\n")).alias("line"))
    phrases = lines.select(F.regexp_extract("line", r"^\S+ \S+ \S+", 0).alias("phrase")).filter("phrase <> ''")
    markers = text.literal_array(MARKERS).alias("cutoff_markers")
    folder = new_folder(spark, "rules")
    phrases.agg(F.to_json(F.struct(F.collect_set("phrase").alias("scam_phrases"), markers))).write.text(folder)
    rules = load_rules(spark, folder)
    blocks = F.split(F.replace(F.col("text"), F.lit(" the "), F.lit("\xa0the\xa0")), "\n")
    return _table(spark, sf_dir, "documents").select("doc_id", text.clean_content(blocks, rules.scam_phrases, rules.cutoff_markers).alias("content"))


def read_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    return _table(spark, sf_dir, "documents").select(
        "doc_id", text.word_count(body).cast("long").alias("words"), text.read_time(body).alias("read_time")
    )


def text_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    padded = F.concat(F.lit("　\t\x1c "), body, F.lit("\xa0 \n\x85"))
    return _table(spark, sf_dir, "documents").select(
        "doc_id",
        text.strip(padded).alias("stripped"),
        text.blank_to_null(F.when(F.col("lang") == "de", F.lit(" \xa0")).otherwise(F.col("source"))).alias("nonblank"),
        text.remove_tags(F.concat(F.lit("<div\nclass='a'>"), body, F.lit("</div ><BR/>"))).alias("untagged"),
        text.title_prefix(F.when(F.col("lang") != "es", body), 55).alias("prefix"),
        text.first_nonempty(F.array(F.lit(None).cast("string"), F.lit(""), F.col("lang"), body)).alias("first_value"),
        text.percent_text(F.col("n_chars") % 8 * 12.5).alias("pct_text"),
        urls.drop_trailing_slashes(F.concat(F.lit("https://"), "source", F.lit("//"))).alias("no_slash"),
    )


def json_ld(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    found = documents.select("doc_id", jsonld.json_ld_metadata(_document_scripts()).alias("ld"))
    return found.select("doc_id", *[F.col(f"ld.{name}").alias(name) for name in jsonld.JSON_LD_FIELDS])


def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meta tags, embedded keywords and script count of the pages made from documents."""
    selectors = (*NEWS_SITE.selectors.keywords, *NEWS_SITE.selectors.image, *NEWS_SITE.selectors.id)
    pages = document_pages(_table(spark, sf_dir, "documents"))
    nodes = F.col("nodes")
    scanned = pages.select("doc_id", "html", html.html_nodes(F.col("html"), html.spec_for(selectors)).alias("nodes"))
    return scanned.select(
        "doc_id",
        jsonld.page_keywords(F.get(html.meta_content(nodes, "name", "keywords"), 0), F.col("html")).alias("keywords"),
        F.get(html.meta_content(nodes, "property", "og:image"), 0).alias("og_image"),
        F.get(html.meta_content(nodes, "name", "data-story-id"), 0).alias("story_id"),
        F.size(jsonld.json_ld_scripts(F.col("html"))).cast("long").alias("n_scripts"),
    )


def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, ts = F.col("event_type"), F.col("ts")
    written = (
        F.when(kind == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == "click", F.date_format(ts, "yyyy-MM-dd HH:mm"))
        .when(kind == "signup", F.date_format(ts, "yyyy-M-d"))
        .when(kind == "error", F.lit("not-a-date"))
        .otherwise(F.concat(F.lit(" "), F.date_format(ts, "yyyy-MM-dd")))
    )
    dated = _table(spark, sf_dir, "events").select("event_id", written.alias("written"))
    return dated.select(
        "event_id",
        dates.date_part_text(F.col("written")).alias("date_part"),
        dates.parse_day(dates.date_part_text(F.col("written"))).cast("string").alias("day"),
        dates.is_recent(F.col("written"), EVENT_DAY, 3).alias("recent"),
    )


def _document_articles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return articles.extract_articles(document_pages(_table(spark, sf_dir, "documents")), SAMPLE_PROFILE, ARTICLE_DAY)


def extract_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_articles(spark, sf_dir)[0]


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_articles(spark, sf_dir)[1].select("url", "title", "date", F.array_join("errors", ",").alias("errors"))


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome per page, stale ones included; the given pages carry no dates, so all of those are stale."""
    derived = document_pages(_table(spark, sf_dir, "documents")).select("url", "html")
    given = _table(spark, sf_dir, "pages").select("url", "html")
    records = articles.extract_records(derived.unionByName(given), SAMPLE_PROFILE, ARTICLE_DAY, keep_stale=True)
    return records.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.count("content").alias("with_content"))


def valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = document_records(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return articles.validate(records)[0].select("doc_id", "title", "url", "date")


def typed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = document_records(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    typed = articles.typed_view(records)
    return typed.select(
        "doc_id", F.col("published_on").cast("string").alias("published_on"), F.col("modified_on").cast("string").alias("modified_on"),
        F.size("tags").cast("long").alias("n_tags"),
    )


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_records(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_lines(_records(spark, sf_dir))


def completeness_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.field_completeness(_records(spark, sf_dir), quality.OPTIONAL_FIELDS, "filled")


def completeness_truthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.field_completeness(_records(spark, sf_dir), quality.FINAL_REPORT_FIELDS, "truthy")


def line_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.field_completeness(jsonl.parsed_records(_lines(spark, sf_dir)), quality.OPTIONAL_FIELDS, "filled")


def summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary_lines(jsonl.parse_lines(_lines(spark, sf_dir)))


def summary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary_records(_records(spark, sf_dir))


def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad lines of text files written from the records. Each carries its place in its file, which the found number must equal."""
    folder = new_folder(spark, "lines")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) + 1
    lines = _lines(spark, sf_dir).select("value", place.alias("place"))
    bad = F.col("value").startswith("{bad ")
    lines.select(F.when(bad, F.concat("value", F.lit(" #"), "place")).otherwise(F.col("value")).alias("value")).write.text(folder)
    found = jsonl.bad_lines(spark, folder)
    written = F.regexp_extract("raw", r" #(\d+)$", 1).cast("long")
    return found.select(F.regexp_replace("raw", r" #\d+$", "").alias("raw"), (F.col("line_no") == written).alias("numbered"))


def missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_counts(_records(spark, sf_dir))


def missing_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_samples(_records(spark, sf_dir), ("lead", "author", "image_url"), ["doc_id"], title_chars=55)


def missing_partly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields missing in part; titles are shown where at most three rows lack the field, as some rows do their id."""
    rare = F.when(F.col("doc_id") % 397 == 5, F.lit("")).otherwise(F.col("id"))
    return quality.missing_samples(
        _records(spark, sf_dir).withColumn("id", rare), (*quality.OPTIONAL_FIELDS, "title"), ["doc_id"], only_if_at_most=quality.SAMPLE_ROWS
    )


def _page_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = html.select_texts(F.col("nodes"), _A)
    return _scanned(spark, sf_dir, _A).select("page_id", F.array_join(names, ", ").alias("keywords"))


def keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.keyword_counts(_page_keywords(spark, sf_dir))


def keyword_top_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.keyword_topk(_records(spark, sf_dir), quality.TOP_TAGS_LINES, ["doc_id"], keep_empty=True)


def keyword_top_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.keyword_topk(_page_keywords(spark, sf_dir), quality.TOP_TAGS_RECORDS, ["page_id"], share=True)


def keyword_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_keywords(_page_keywords(spark, sf_dir))


def keyword_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct tags over three runs: exact, and whether the united sketches of the runs come within 3 % of it."""
    folder, keywords = new_folder(spark, "sketches"), _page_keywords(spark, sf_dir)
    for run in range(3):
        quality.store_tag_sketch(keywords.filter(F.col("page_id") % 3 == run), f"{folder}/run={run}")
    united = quality.distinct_over_runs(spark.read.parquet(folder)).select(F.col("n_tags").alias("estimate"))
    exact = quality.distinct_keywords(keywords)
    return exact.select("n_tags", (F.abs(united.scalar() - F.col("n_tags")) <= F.col("n_tags") * 0.03).alias("near"))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "articles")
    jsonl.write_jsonl(_records(spark, sf_dir), path)
    return jsonl.read_jsonl(spark, path, mode="strict")


def jsonl_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("doc_id", jsonl.json_line().alias("line"))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetchlog.classify_fetches(event_fetches(_table(spark, sf_dir, "events")), SAMPLE_PROFILE)


def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select(
        "event_id", "outcome", F.col("effective_status").cast("int").alias("effective_status"), "page_url",
        F.array_join(F.array_sort(F.map_keys(fetchlog.clean_headers(F.col("headers")))), ",").alias("header_names"),
    )


def fetch_outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetchlog.outcome_counts(_classified(spark, sf_dir))


def fetch_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = fetchlog.latest_outcome(_classified(spark, sf_dir))
    return latest.select("requested_url", "outcome", F.col("effective_status").cast("int").alias("effective_status"), "page_url", "attempts")


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Pages of the documents run through the page stream twice: half of them, then the others, fetched earlier, and all of them
    again an hour later. Returns the checkpoint, which knows what was written.
    """
    folder = new_folder(spark, "stream")
    pages = document_pages(_table(spark, sf_dir, "documents"))
    late = F.crc32("url") % 2 == 0

    def fetched(some: Column, hour: str) -> DataFrame:
        return pages.filter(some).select("url", "html", F.lit(f"{ARTICLE_DAY} {hour}:00").cast("timestamp").alias("fetched_at"))

    for part in (fetched(~late, "09:00"), fetched(late, "08:00").unionByName(fetched(F.lit(True), "10:00"))):
        part.write.mode("append").parquet(f"{folder}/pages")
        records = ingest.record_stream(ingest.stream_pages(spark, f"{folder}/pages", schema=part.schema), SAMPLE_PROFILE, delay="1 day")
        ingest.write_record_stream(records, f"{folder}/out", f"{folder}/rejects", f"{folder}/checkpoint", roll_every=2).awaitTermination()
    return f"{folder}/checkpoint"


def stream_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.read_articles(spark, _ingested(spark, sf_dir))


def article_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job over every page given twice, with one article a URL; the article file read back."""
    pages = document_pages(_table(spark, sf_dir, "documents")).select("url", "html")
    paths = run_article_job(
        pages.unionByName(pages), SAMPLE_PROFILE, ARTICLE_DAY, new_folder(spark, "job"), dt.datetime(2026, 1, 5, 12, 30), one_per_url=True)
    return jsonl.read_jsonl(spark, paths["articles"], mode="strict")


def article_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job with leads and two stages before the sink: one that writes the lead into the title, one that drops short articles."""
    pages = document_pages(_table(spark, sf_dir, "documents"))
    lead = F.concat(F.lit('</h1><div id="lead"> Lead of '), F.element_at(F.split("url", "/"), 4), F.lit(" </div>"))
    led = pages.select("url", F.replace(F.col("html"), F.lit("</h1>"), lead).alias("html"))
    stages = [lambda df: df.withColumn("title", F.concat_ws(" | ", "title", "lead")), lambda df: df.filter("read_time > 1")]
    paths = run_article_job(
        led, replace(SAMPLE_PROFILE, keep_lead=True), ARTICLE_DAY, new_folder(spark, "job"), dt.datetime(2026, 1, 5, 12, 30), stages=stages)
    return jsonl.read_jsonl(spark, paths["articles"], mode="strict")


def pages_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages written as JSON lines and read as stored pages."""
    folder = new_folder(spark, "pages")
    _table(spark, sf_dir, "pages").select("url", "html").write.json(folder)
    return read_pages(spark, folder, "json").select("url", F.md5(F.col("html").cast("binary")).alias("html_md5"))


def pages_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, f"{sf_dir}/pages.parquet").select("url", F.md5(F.col("html").cast("binary")).alias("html_md5"))


def fetch_log_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetch log written as JSON lines and read by its schema."""
    folder = new_folder(spark, "fetches")
    event_fetches(_table(spark, sf_dir, "events")).write.json(folder)
    return fetchlog.outcome_counts(fetchlog.classify_fetches(read_fetch_log(spark, folder), SAMPLE_PROFILE))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects of the page stream, which writes one for every fetch; every page was fetched twice."""
    records = ingest.read_rejects(spark, _ingested(spark, sf_dir))
    return articles.rejected_articles(records).select("url", "title", "date", F.array_join("errors", ",").alias("errors"))


def _event_runs(spark: SparkSession, sf_dir: str, folder: str) -> Iterator[DataFrame]:
    """The events as a stream that gets its files in two parts, the older events last."""
    events = _table(spark, sf_dir, "events")
    middle = events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)).first()[0]
    is_new = F.unix_micros(F.col("ts").cast("timestamp")) >= middle
    for part in (is_new, ~is_new):
        events.filter(part).write.mode("append").parquet(f"{folder}/events")
        yield event_fetches(spark.readStream.schema(events.schema).parquet(f"{folder}/events"))


def stream_distinct_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request a URL, of a stream whose second run brings the older half."""
    folder = new_folder(spark, "stream")
    for stream in _event_runs(spark, sf_dir, folder):
        requests = stream.select("requested_url", "ts")
        ingest.write_distinct_stream(requests, f"{folder}/out", f"{folder}/checkpoint", "60 days", "ts", "requested_url").awaitTermination()
    return ingest.read_committed(spark, f"{folder}/checkpoint", "rows", requests.schema).select("requested_url")


def stream_outcome_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window with an event in it, those still open at the end of the stream included."""
    folder = new_folder(spark, "stream")
    for stream in _event_runs(spark, sf_dir, folder):
        classified = fetchlog.classify_fetches(stream, SAMPLE_PROFILE)
        ingest.write_window_counts(classified, f"{folder}/out", f"{folder}/checkpoint", "6 hours", roll_every=2).awaitTermination()
    counts = ingest.read_window_counts(spark, f"{folder}/out")
    return counts.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "outcome", "host", "n")


QUERIES: dict[str, Query] = {
    "page_title": page_title,
    "page_paragraphs": page_paragraphs,
    "page_records": page_records,
    "page_completeness": page_completeness,
    "page_id": page_id,
    "page_hosts": page_hosts,
    "page_links": page_links,
    "page_metadata": page_metadata,
    "link_routes": link_routes,
    "links_distinct": links_distinct,
    "crawl_edges": crawl_edges,
    "crawl_reach": crawl,
    "page_reach": page_reach,
    "clean_content": clean_content,
    "read_time": read_time,
    "text_steps": text_steps,
    "json_ld": json_ld,
    "recent_events": recent_events,
    "extract_articles": extract_articles,
    "rejects": rejects,
    "page_outcomes": page_outcomes,
    "valid_records": valid_records,
    "typed_records": typed_records,
    "completeness_filled": completeness_filled,
    "completeness_truthy": completeness_truthy,
    "line_completeness": line_completeness,
    "summary_lines": summary_lines,
    "summary_records": summary_records,
    "bad_lines": bad_lines,
    "missing_counts": missing_counts,
    "missing_samples": missing_samples,
    "missing_partly": missing_partly,
    "keyword_counts": keyword_counts,
    "keyword_top_lines": keyword_top_lines,
    "keyword_top_records": keyword_top_records,
    "keyword_distinct": keyword_distinct,
    "jsonl_roundtrip": jsonl_roundtrip,
    "jsonl_text": jsonl_text,
    "fetch_outcomes": fetch_outcomes,
    "fetch_outcome_counts": fetch_outcome_counts,
    "fetch_latest": fetch_latest,
    "stream_articles": stream_articles,
    "stream_rejects": stream_rejects,
    "article_job": article_job,
    "pages_json": pages_json,
    "pages_parquet": pages_parquet,
    "fetch_log_counts": fetch_log_counts,
    "linked_links": linked_links,
    "linked_reach": linked_reach,
    "canonical_reach": canonical_reach,
    "clean_by_rules": clean_by_rules,
    "article_stages": article_stages,
    "keyword_runs": keyword_runs,
    "stream_distinct_urls": stream_distinct_urls,
    "stream_outcome_windows": stream_outcome_windows,
}
