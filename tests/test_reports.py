"""JSON Lines in and out, quality reports, rules, jobs and streams."""

import collections
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pagetables.operators import quality
from pagetables.operators.articles import ARTICLE_COLUMNS, ARTICLE_SCHEMA, distinct_pages, rejected_articles
from pagetables.operators.fetchlog import classify_fetches
from pagetables.plans.articles import run_article_job
from pagetables.plans.workspace import shared_folder
from pagetables.profile import NEWS_SITE
from pagetables.sources import jsonl, pages, rules
from pagetables.streaming import ingest

TODAY = "2026-03-02"


def article(i, **changes):
    row = {
        "title": f"Title {i}", "url": f"http://e/{i}", "date": "2026-01-01", "content": "x" * 101, "author": None, "keywords": "a, b",
        "section": "S", "date_modified": "", "image_url": "u", "id": f"{i}", "read_time": 1,
    }
    return {**row, **changes}


ARTICLES = [
    article(0, keywords="b, a,,a"), article(1, title=None, keywords=""), article(2, content="x" * 100, read_time=0, keywords=None),
    article(3, keywords=["list"], author="A"), article(4, keywords="c,a ,b", title=""), article(5, lead="L", keywords=" b"),
]
LINES = (
    [json.dumps(ARTICLES[0], ensure_ascii=False), "", "  " + json.dumps(ARTICLES[1]) + "\xa0", "{bad", "   "]
    + [json.dumps(a) for a in ARTICLES[2:]]
    + ["[1, 2]", '{"title": ', "5"]
)


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    file = tmp_path_factory.mktemp("in") / "lines.jsonl"
    file.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(file)


@pytest.fixture(scope="module")
def lines(spark, path):
    return jsonl.parse_lines(jsonl.read_lines(spark, path)).cache()


@pytest.fixture(scope="module")
def records(lines):
    return lines.filter("valid and not non_object")


def test_summary_of_lines(lines):
    row = quality.summary_lines(lines).first()
    assert (row.total_lines, row.valid_json, row.non_object) == (len(LINES), 8, 2)
    assert (row.with_title, row.with_content, row.with_keywords) == (4, 5, 4)
    assert row.title_pct == pytest.approx(4 / len(LINES) * 100)


def test_summary_of_records(records):
    row = quality.summary_records(records).first()
    assert (row.total, row.with_title, row.with_content, row.with_keywords, row.empty_keywords) == (6, 4, 5, 4, 2)
    assert row.keywords_pct == pytest.approx(4 / 6 * 100)


def test_empty_input(records):
    none = records.limit(0)
    assert quality.summary_records(none).first().title_pct == 0.0
    assert quality.summary_lines(none).first().title_pct is None
    assert [r.pct for r in quality.field_completeness(none).collect()] == [0.0] * 7


def test_completeness(records):
    filled = {r.field: (r.filled, r.total, r.empty, r.status) for r in quality.field_completeness(records).collect()}
    for field in quality.OPTIONAL_FIELDS:
        n = sum(1 for a in ARTICLES if a.get(field) is not None and a.get(field) != "")
        pct = n / 6 * 100
        assert filled[field] == (n, 6, 6 - n, "ok" if pct == 100 else "partial" if pct > 50 else "bad")
    truthy = {r.field: r.filled for r in quality.field_completeness(records, quality.FINAL_REPORT_FIELDS, "truthy").collect()}
    assert truthy == {f: sum(1 for a in ARTICLES if a.get(f)) for f in quality.FINAL_REPORT_FIELDS}
    assert (filled["read_time"][0], truthy["read_time"]) == (6, 5)
    with pytest.raises(ValueError):
        quality.field_completeness(records, presence="other")


def test_status_bucket(spark):
    df = spark.createDataFrame([(100.0,), (99.9,), (50.1,), (50.0,), (0.0,)], "p double")
    assert [r.s for r in df.select(quality.status_bucket(F.col("p")).alias("s")).collect()] == ["ok", "partial", "partial", "bad", "bad"]


def counter(keep_empty):
    tags = collections.Counter()
    for a in ARTICLES:
        if a.get("keywords") and isinstance(a["keywords"], str):
            tags.update(k.strip() for k in a["keywords"].split(",") if keep_empty or k.strip())
    return tags


@pytest.mark.parametrize("keep_empty", [True, False])
def test_keywords(records, keep_empty):
    expected = counter(keep_empty)
    got = {r.tag: r.n for r in quality.keyword_counts(records, keep_empty=keep_empty).collect()}
    assert got == dict(expected)
    top = quality.keyword_topk(records, 3, ["seq"], keep_empty, share=True).collect()
    assert [(r.tag, r.n) for r in top] == expected.most_common(3)
    assert [r.pct for r in top] == [pytest.approx(n / 6 * 100) for _, n in expected.most_common(3)]
    assert [r.tag for r in quality.keyword_topk(records, 3, ["file", "seq"], keep_empty).collect()] == [t for t, _ in expected.most_common(3)]
    assert quality.distinct_keywords(records, keep_empty).first().n_tags == len(expected)
    assert quality.distinct_keywords(records, keep_empty, approximate=True).first().n_tags == len(expected)


def test_missing(records):
    counts = {r.field: (r.missing, r.present) for r in quality.missing_counts(records).collect()}
    assert counts == {"lead": (5, 1), "author": (5, 1), "date_modified": (6, 0)}
    samples = quality.missing_samples(records, ["author", "date_modified", "read_time", "id"], ["seq"], title_chars=5)
    assert sorted((r.field, r.n_missing, r.sample_no, r.title) for r in samples.collect()) == [
        ("author", 5, 1, "Title..."), ("author", 5, 2, "N/A..."), ("author", 5, 3, "Title..."),
        ("date_modified", 6, 1, "Title..."), ("date_modified", 6, 2, "N/A..."), ("date_modified", 6, 3, "Title..."),
        ("read_time", 1, 1, "Title..."),
    ]
    partly = quality.missing_samples(records, ["author", "date_modified", "read_time", "id", "title"], ["seq"], only_if_at_most=3)
    assert sorted((r.field, r.n_missing, r.sample_no or 0, r.title) for r in partly.collect()) == [
        ("author", 5, 0, None), ("read_time", 1, 1, "Title 2..."), ("title", 2, 1, "N/A..."), ("title", 2, 2, "...")]


def test_reports_shuffle_little(records, spark, tmp_path):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    records.select("seq", F.col("keywords").cast("string").alias("keywords"), "title").write.parquet(str(tmp_path / "r"))
    typed = spark.read.parquet(str(tmp_path / "r"))
    assert "SortAggregate" not in plan(quality.keyword_topk(typed, 3, ["seq"]))
    assert "TakeOrderedAndProject" in plan(quality.keyword_topk(typed, 3, ["seq"]))
    samples = plan(quality.missing_samples(typed, ["keywords", "title"], ["seq"], only_if_at_most=3))
    assert samples.count("FileScan") == 1 and samples.count("Exchange") == 1


@pytest.mark.parametrize("rows", [1, 3, 2000])
def test_missing_samples_of_many_tasks(spark, rows):
    """Fields missing in one, some and most records, over many tasks and with equal order values, against a sort of all of them."""
    records = [(i % 400, f"T{i}", None if i == 777 else "x", "" if i % 3 else "x", None) for i in range(1200)]
    df = spark.createDataFrame(records, "seq int, title string, one string, most string, never string").repartition(9)
    got = quality.missing_samples(df, ["one", "most", "never", "title"], ["seq", "title"], rows, title_chars=9)
    want = []
    for at, field in ((2, "one"), (3, "most"), (4, "never")):
        lacking = sorted(((r[0], r[1]) for r in records if not r[at]))
        want += [(field, len(lacking), i + 1, t + "...") for i, (_, t) in enumerate(lacking[:rows])]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    partly = quality.missing_samples(df, ["one", "most", "never"], ["seq"], rows, only_if_at_most=3).collect()
    assert sorted((r.field, r.n_missing, r.sample_no, r.title) for r in partly) == [("most", 800, None, None), ("one", 1, 1, "T777...")]


def test_bad_lines(spark, path):
    rows = sorted((r.line_no, r.raw) for r in jsonl.bad_lines(spark, path).collect())
    assert rows == [(4, "{bad"), (11, '{"title": ')]


def test_bad_line_numbers_over_splits(spark, tmp_path):
    rows = [f"{{bad {i}" if i % 7 == 0 else json.dumps({"i": i, "pad": "x" * (i % 50)}) for i in range(1, 4001)]
    for name in ("a", "b"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(rows))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = jsonl.bad_lines(spark, str(tmp_path)).collect()
        assert jsonl.read_lines(spark, str(tmp_path)).select("file", "block_start").distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 2 * (4000 // 7)
    assert all(r.raw == f"{{bad {r.line_no}" for r in got)


def test_typed_reading(spark, path, tmp_path):
    lenient = jsonl.read_jsonl(spark, path).cache()
    assert lenient.filter("_corrupt is not null and title is null").count() >= 2
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        jsonl.read_jsonl(spark, path, mode="strict").collect()
    with pytest.raises(ValueError):
        jsonl.read_jsonl(spark, path, mode="x")
    assert jsonl.read_lines_if_exists(spark, str(tmp_path / "none.jsonl")) is None


def test_write_jsonl(spark, tmp_path):
    row = article(1, title="Zażółć – 日本", keywords=None, lead="dropped")
    df = spark.createDataFrame([tuple(row[c] for c in ARTICLE_COLUMNS)], ARTICLE_SCHEMA).withColumn("lead", F.lit("x"))
    target = jsonl.run_path(str(tmp_path), dt.datetime(2026, 5, 20, 12, 0, 0))
    assert target.endswith("/data_2026-05-20_12-00-00.jsonl")
    jsonl.write_jsonl(df, target)
    text = spark.read.text(target).first().value
    assert list(json.loads(text).items()) == [(c, row[c]) for c in ARTICLE_COLUMNS]
    assert "日本" in text and text == df.select(jsonl.json_line()).first()[0]
    jsonl.write_jsonl(df.union(df), target, limit=1)
    assert jsonl.read_jsonl(spark, target, mode="strict").count() == 1


def test_rules(spark, tmp_path):
    file = tmp_path / "rules.json"
    file.write_text(json.dumps({"scam_phrases": ["Ściema"], "cutoff_markers": ["CZYTAJ"], "more": 1}, indent=1), encoding="utf-8")
    loaded = rules.load_rules(spark, str(file))
    assert (loaded.scam_phrases, loaded.cutoff_markers) == (("Ściema",), ("CZYTAJ",))
    file.write_text("{")
    assert rules.load_rules(spark, str(file)).scam_phrases == ()
    assert rules.load_rules(spark, str(tmp_path / "none.json")).cutoff_markers == ()
    file.write_text('{"scam_phrases": [""]}')
    with pytest.raises(ValueError):
        rules.load_rules(spark, str(file))


def html(i, day=TODAY):
    return f'<html><body><h1>T{i}</h1><span class="date">{day} 10:00</span><p>Body of page {i}</p></body></html>'


def test_page_formats(spark, tmp_path):
    (tmp_path / "a.html").write_text(html(1), encoding="utf-8")
    (tmp_path / "b.html").write_bytes(b"\xff\xfe broken")
    for format in ("text", "binary"):
        rows = {r.url.rsplit("/", 1)[-1]: r.html for r in pages.read_pages(spark, str(tmp_path / "*.html"), format).collect()}
        assert rows["a.html"] == html(1) and len(rows) == 2
    assert rows["b.html"] == "\ufffd\ufffd broken"
    stored = spark.createDataFrame([("u", html(2))], "url string, html string")
    stored.write.json(str(tmp_path / "j"))
    stored.write.parquet(str(tmp_path / "p"))
    assert pages.read_pages(spark, str(tmp_path / "j"), "json").first().html == html(2)
    assert pages.read_pages(spark, str(tmp_path / "p")).first().html == html(2)
    with pytest.raises(ValueError):
        pages.read_pages(spark, str(tmp_path), "csv")


def test_fetch_log_reading(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"requested_url":"https://onet.pl/a","status":403,"headers":{"a":"b"},"ts":"2026-01-01T00:00:00Z"}\n')
    assert classify_fetches(pages.read_fetch_log(spark, str(tmp_path)), NEWS_SITE).first().outcome == "block"


def test_article_job(spark, tmp_path):
    rows = [(f"https://e/{i}", html(i)) for i in range(5)] + [("ftp://e/x", html(9)), ("https://e/old", html(8, "2020-01-01"))]
    paths = run_article_job(spark.createDataFrame(rows, "url string, html string"), NEWS_SITE, TODAY, str(tmp_path), dt.datetime(2026, 3, 2))
    assert jsonl.read_jsonl(spark, paths["articles"], mode="strict").count() == 5
    assert [r.errors for r in rejected_articles(spark.read.parquet(paths["records"])).collect()] == [["url_scheme"]]


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def page_rows(spark, numbers, fetched="2026-03-02 08:00:00", day=TODAY):
    rows = [(f"https://e/{i}", html(i, day), 200, None, dt.datetime.fromisoformat(fetched)) for i in numbers]
    return spark.createDataFrame(rows, pages.PAGE_SCHEMA)


def test_article_stream_is_incremental(spark, tmp_path):
    source, sink, rejects, checkpoint = (str(tmp_path / n) for n in ("in", "out", "rejects", "cp"))

    def run():
        ingest.stream_articles(spark, source, sink, rejects, checkpoint, NEWS_SITE).awaitTermination()

    page_rows(spark, range(3)).write.parquet(source)
    run()
    assert jsonl.read_jsonl(spark, f"{sink}/*", mode="strict").count() == 3
    run()
    page_rows(spark, [*range(3, 5), 1]).write.mode("append").parquet(source)
    run()
    page_rows(spark, [7], fetched="2026-03-09 00:00:00").write.mode("append").parquet(source)
    run()
    written = jsonl.read_jsonl(spark, f"{sink}/*", mode="strict").collect()
    assert sorted(r.id for r in written) == ["0", "1", "2", "3", "4"]
    assert all(set(json.loads(line.value)) == set(ARTICLE_COLUMNS) for line in spark.read.text(f"{sink}/*").collect())
    left = spark.read.parquet(f"{rejects}/*").collect()
    assert [(r.url, r.outcome) for r in left] == [("https://e/7", "stale")]


def test_stages_run_before_the_sink(spark, tmp_path):
    source = str(tmp_path / "in")
    page_rows(spark, range(4)).write.parquet(source)
    records = ingest.record_stream(ingest.stream_pages(spark, source), NEWS_SITE, delay=None)
    paths = [str(tmp_path / n) for n in ("out", "rejects", "cp")]
    stages = [lambda df: df.filter("id > 1"), lambda df: df.withColumn("section", F.lit("changed"))]
    ingest.write_record_stream(records, *paths, stages=stages).awaitTermination()
    assert sorted((r.id, r.section) for r in jsonl.read_jsonl(spark, f"{paths[0]}/*").collect()) == [("2", "changed"), ("3", "changed")]


def test_late_pages_are_written(spark, tmp_path):
    source, sink, rejects, checkpoint = (str(tmp_path / n) for n in ("in", "out", "rejects", "cp"))

    def run(pages_read):
        pages_read.write.mode("append").parquet(source)
        ingest.stream_articles(spark, source, sink, rejects, checkpoint, NEWS_SITE).awaitTermination()
        return sorted(r.id for r in jsonl.read_jsonl(spark, f"{sink}/*", mode="strict").collect())

    assert run(page_rows(spark, [1, 2], fetched="2026-03-02 20:00:00")) == ["1", "2"]
    late = page_rows(spark, [3], fetched="2026-03-02 08:00:00").unionByName(page_rows(spark, [4], "2026-03-01 08:00:00", dt.date(2025, 1, 1)))
    assert run(late) == ["1", "2", "3"]
    assert [(r.url, r.outcome) for r in spark.read.parquet(f"{rejects}/*").collect()] == [("https://e/4", "stale")]
    # Repeats within the hour, also of a late page; later fetches are articles of their own.
    again = page_rows(spark, [1, 3], fetched="2026-03-02 08:59:00").unionByName(page_rows(spark, [2], fetched="2026-03-02 20:30:00"))
    assert run(again.unionByName(page_rows(spark, [2], fetched="2026-03-02 21:00:00"))) == ["1", "1", "2", "2", "3"]


def good_and_broken(spark):
    """Four URLs with a good and a broken or stale fetch, the bad one earlier or later; and two broken pages without URL."""
    broken = f'<html><body><span class="date">{TODAY} 10:00</span></body></html>'
    bad = {0: broken, 1: broken, 2: html(2, dt.date(2025, 1, 1)), 3: html(3, dt.date(2025, 1, 1))}
    rows = []
    for i, page in bad.items():
        hours = (8, 9) if i % 2 else (9, 8)
        rows += [(f"https://e/{i}", p, 200, None, dt.datetime(2026, 3, 2, h)) for p, h in zip((html(i, TODAY), page), hours)]
    rows += [(None, broken, 200, None, dt.datetime(2026, 3, 2, 8))] * 2
    return spark.createDataFrame(rows, pages.PAGE_SCHEMA).repartition(5)


def test_one_per_url_keeps_the_good_fetch(spark, tmp_path):
    paths = run_article_job(
        good_and_broken(spark), NEWS_SITE, TODAY, str(tmp_path), dt.datetime(2026, 3, 2, 12), one_per_url=True)
    assert sorted(r.id for r in jsonl.read_jsonl(spark, paths["articles"]).collect()) == ["0", "1", "2", "3"]
    assert [r.url for r in rejected_articles(spark.read.parquet(paths["records"])).collect()] == [None, None]


def test_order_of_records_of_a_url(spark):
    rows = [("u", "rejected", 1, "a"), ("u", "accepted", 3, "b"), ("u", "accepted", 2, "c"), ("u", "accepted", None, "d"), ("v", "stale", 1, "e"), ("v", "rejected", 2, "f")]
    rows += [(None, "stale", 1, "g"), (None, "stale", 1, "g"), ("w", "accepted", 5, "h"), ("w", "accepted", 5, "i")]
    numbered = [(*r, i) for i, r in enumerate(rows)]
    got = distinct_pages(spark.createDataFrame(numbered, "url string, outcome string, fetched_at int, title string, n long"), "n").collect()
    assert sorted(r.title for r in got) == ["c", "f", "g", "g", "h"]


def test_choice_moves_narrow_rows_only(spark, tmp_path):
    """No sort and no content below an exchange, whatever the share of one URL."""
    rows = [("hot" if i % 3 == 0 else f"u{i}", "accepted", i, "text " * 50, i) for i in range(3000)]
    spark.createDataFrame(rows, "url string, outcome string, fetched_at int, content string, n long").write.parquet(str(tmp_path / "r"))
    chosen = distinct_pages(spark.read.parquet(str(tmp_path / "r")), "n")
    assert chosen.count() == 2001
    chosen.collect()
    text = chosen._jdf.queryExecution().executedPlan().toString()
    final = text[: text.index("Initial Plan")] if "Initial Plan" in text else text
    assert "SortAggregate" not in text and "Sort " not in final
    assert not any("Exchange" in part and "content" in part for part in final.split("\n"))


def test_stream_keeps_the_good_fetch_and_every_reject(spark, tmp_path):
    source, *paths = (str(tmp_path / n) for n in ("in", "out", "rejects", "cp"))
    good_and_broken(spark).write.parquet(source)
    records = ingest.record_stream(ingest.stream_pages(spark, source), NEWS_SITE, delay="1 day")
    ingest.write_record_stream(records, *paths).awaitTermination()
    assert sorted(r.id for r in jsonl.read_jsonl(spark, f"{paths[0]}/*").collect()) == ["0", "1", "2", "3"]
    left = spark.read.parquet(f"{paths[1]}/*").groupBy("outcome").count().collect()
    assert {r.outcome: r["count"] for r in left} == {"stale": 2, "rejected": 4}


def test_late_events_are_counted(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "requested_url string, outcome string, ts timestamp"

    def run(*times):
        rows = [("https://e/1", "ok", dt.datetime.fromisoformat(f"2026-03-02 {t}")) for t in times]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        ingest.write_window_counts(spark.readStream.schema(schema).parquet(source), path, checkpoint).awaitTermination()
        counts = ingest.read_window_counts(spark, path).select(F.date_format("window.start", "HH").alias("hour"), "host", "outcome", "n")
        return sorted(tuple(r) for r in counts.collect())

    assert run("08:10:00", "12:30:00") == [("08", "e", "ok", 1), ("12", "e", "ok", 1)]
    assert run("08:20:00", "07:00:00", "12:40:00") == [("07", "e", "ok", 1), ("08", "e", "ok", 2), ("12", "e", "ok", 2)]
