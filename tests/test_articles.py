"""JSON-LD, HTML nodes and whole pages."""

import json
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagetables.functions import jsonld
from pagetables.operators import articles, html
from pagetables.operators.html import by_class, by_class_part, by_id, by_tag, html_nodes, meta, select_texts, spec_for
from pagetables.profile import NEWS_SITE, CleaningRules, Selectors
from dataclasses import replace

TODAY = "2026-03-02"


def script(body):
    text = body if isinstance(body, str) else json.dumps(body)
    return f'<script type="application/ld+json">\n{text}\n</script>'


def metadata(spark, *bodies):
    html = "<html>" + "".join(script(b) for b in bodies) + "</html>"
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(jsonld.json_ld_metadata(jsonld.json_ld_scripts(F.col("html"))).alias("m")).first().m


FIELDS = {"datePublished": "2031-07-0{}", "dateModified": "2031-08-0{}", "articleSection": "harbour {}"}


@pytest.mark.parametrize("present", [(), ("dateModified",), ("articleSection", "datePublished"), tuple(FIELDS)])
def test_json_ld_plain_fields(spark, present):
    m = metadata(spark, {"mast": 3, **{f: FIELDS[f].format(1) for f in present}})
    assert {f: m[f] for f in FIELDS} == {f: FIELDS[f].format(1) if f in present else None for f in FIELDS}
    assert (m.author, m.image_url) == (None, None)


def test_json_ld_graph_members_are_merged_in_order(spark):
    nodes = [{"@type": "Thing"}, {"articleSection": "tides", "author": {"name": ""}}, {"author": {"name": "R. Keel"}, "articleSection": "late"},
             {"image": {"url": "//img.test/7"}, "datePublished": "2031-07-09"}]
    m = metadata(spark, {"articleSection": "outside", "@graph": nodes})
    assert (m.articleSection, m.author, m.image_url, m.datePublished) == ("tides", "R. Keel", "//img.test/7", "2031-07-09")


@pytest.mark.parametrize("author, expected", [
    ([{"name": "R. Keel"}, {"name": "S. Mast"}], "R. Keel"), ("R. Keel", None), ([], None), ({"name": ["", "S. Mast"]}, "S. Mast"), ({}, None),
])
def test_json_ld_author_forms(spark, author, expected):
    assert metadata(spark, {"author": author}).author == expected


@pytest.mark.parametrize("image, expected", [("/boat.png", "/boat.png"), ({"url": "/boat.png", "w": 2}, "/boat.png"), (["/boat.png"], None), ({"w": 2}, None)])
def test_json_ld_image_forms(spark, image, expected):
    assert metadata(spark, {"image": image}).image_url == expected


def test_json_ld_over_scripts(spark):
    """The first script with a value decides for its field; a broken script between them is passed over."""
    scripts = [{"articleSection": ""}, "]broken[", {"articleSection": "tides"}, {"articleSection": "late", "dateModified": "2031-08-03"}]
    m = metadata(spark, *scripts)
    assert (m.articleSection, m.dateModified) == ("tides", "2031-08-03")


def test_open_comment_hides_what_follows(spark):
    html = script({"articleSection": "seen"}) + "<!-- open " + script({"datePublished": "2031-07-01"})
    df = spark.createDataFrame([(html,), ("<!-- a" * 20_000 + script({"a": 1}),)], "html string")
    bodies = [r.b for r in df.select(jsonld.json_ld_scripts(F.col("html")).alias("b")).collect()]
    assert len(bodies[0]) == 1 and bodies[1] == []


def test_json_ld_none(spark):
    assert list(metadata(spark)) == [None] * 5 + [[]]
    assert list(metadata(spark, [{"datePublished": "2026-01-01"}])) == [None] * 5 + [[]]
    assert list(metadata(spark, {"@graph": None, "datePublished": "x"})) == [None] * 5 + [[]]
    assert metadata(spark, '{"datePublished": "a", "datePublished": "b"}').datePublished == "b"


def test_json_ld_odd_types(spark):
    m = metadata(spark, {"dateModified": 5, "author": {"name": 7}, "articleSection": ["", "A", "B"], "datePublished": ["2026-01-01"]})
    assert sorted(m.bad_types) == ["author", "dateModified", "datePublished"]
    assert m.articleSection == "A"


@pytest.mark.parametrize("source, expected", [
    ('<!-- <script type="application/ld+json">{}</script> -->', []),
    ("<script>var s = '<script type=\"application/ld+json\">x';</script>", []),
    ("<SCRIPT id='a' TYPE='application/ld+json' async>b</SCRIPT>", ["b"]),
    ("<script type=application/ld+json>b", ["b"]),
    ("<script type='application/ld+json+x'>b</script><script type='Application/LD+json'>c</script>", []),
    ("<script>1</script><script type='application/ld+json'>b</script><script type='application/ld+json'>c</script>", ["b", "c"]),
])
def test_script_search(spark, source, expected):
    df = spark.createDataFrame([(source,)], "html string")
    assert df.select(jsonld.json_ld_scripts(F.col("html")).alias("s")).first().s == expected


@pytest.mark.parametrize("meta_text, source, expected", [
    (" a, b ", '"keywords":["x"]', " a, b "),
    (None, 'x "keywords": \n["x", "", null, false, 0, "y", 5, true] "keywords":["z"]', "x, y, 5, True"),
    ("", '"keywords":["x"]', "x"),
    (None, '"keywords":["a]", "b"]', None),
    (None, '"keywords":[""]', None),
    (None, '"keywords":[]', None),
    (None, "nothing", None),
])
def test_keywords(spark, meta_text, source, expected):
    df = spark.createDataFrame([(meta_text, source)], "meta string, html string")
    assert df.select(jsonld.page_keywords(F.col("meta"), F.col("html")).alias("k")).first().k == expected


def texts(spark, html, selector):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(select_texts(html_nodes(F.col("html"), spec_for([selector])), selector).alias("t")).first().t


@pytest.mark.parametrize("html, selector, expected", [
    # Only direct text counts, in document order, and markup splits it.
    ("<body><p>a <b>b</b> c<br>d</p></body>", by_tag("p"), ["a ", " c", "d"]),
    ("<body><div class='x y'>1<div class=y>2</div>3</div></body>", by_class("y"), ["1", "2", "3"]),
    ("<body><p>a<!-- no -->b</p></body>", by_tag("p"), ["a", "b"]),
    ("<body><h1><span>inside</span></h1></body>", by_tag("h1"), []),
    ("<body><P ID=lead>T</P></body>", by_id("lead"), ["T"]),
    ("<body><span class='ods-m-date-x'>1</span><span class=update>2</span><div class=date>3</div></body>", by_class_part("span", "date"), ["1", "2"]),
    ("<head><meta name=keywords content='a &amp; b'><meta content='2' name=keywords><meta name=other content=3></head>", meta("name", "keywords"), ["a & b", "2"]),
    ("<head><meta name=keywords></head>", meta("name", "keywords"), []),
    ("<head><meta name=keywords content='?a=1&copy=2&amp;b=3&copyx &lt &#65;&notit; &eacute;'></head>", meta("name", "keywords"),
     ["?a=1&copy=2&b=3&copyx < A&notit; é"]),
    # Entities, scripts and stray marks.
    ("<body><h1>cut &amp</h1>", by_tag("h1"), ["cut &"]),
    ("<body><p>&lt;b&gt; &eacute;&#233;&nbsp;x &amp;</p></body>", by_tag("p"), ["<b> éé\xa0x &"]),
    ("<body><script>var t='<p>no</p>';</script><p>1 < 2</p></body>", by_tag("p"), ["1 < 2"]),
    ("<body><style>p{}</style><p title='a>b'>x</p></body>", by_tag("p"), ["x"]),
    # Repair of open elements.
    ("<body><p>a<p>b<div>c</div>d</body>", by_tag("p"), ["a", "b"]),
    ("<body><p>a <b>bold<p>next</body>", by_tag("p"), ["a ", "next"]),
    ("<body><p>a</b>b</p></body>", by_tag("p"), ["ab"]),
    ("<body><div><p>a</div>b</p></body>", by_tag("p"), ["a"]),
    ("<body><ul><li>1<li>2</ul><p>3", by_tag("li"), ["1", "2"]),
    ("<body><h1>Title<p>text", by_tag("h1"), ["Title"]),
    ("<body><p>cut off <a href='x", by_tag("p"), ["cut off "]),
    ("<body><p>open comment <!-- x", by_tag("p"), ["open comment "]),
    ("plain words", by_tag("p"), ["plain words"]),
    ("", by_tag("p"), []),
    ("<html>\n<head>\n<title>t</title></head>\n<body class='hyphenate'>\n<h1>x</h1>y</body></html>", by_class("hyphenate"), ["\n", "y"]),
])
def test_nodes(spark, html, selector, expected):
    assert texts(spark, html, selector) == expected


def test_null_html(spark):
    assert texts(spark, None, by_tag("p")) is None


def page(head="", body="", cls=' class="hyphenate"'):
    return f"<html>\n<head>{head}</head>\n<body{cls}>{body}</body>\n</html>"


def extract(spark, html, url="https://pages.test/north/42/k7m9", profile=NEWS_SITE, keep_stale=False):
    pages = spark.createDataFrame([(url, html)], "url string, html string")
    return articles.extract_records(pages, profile, TODAY, keep_stale).collect()


def one(rows):
    assert len(rows) == 1
    return rows[0]


def test_all_fields_from_metadata(spark):
    """Every field has a source of higher rank in the head than what the body offers."""
    body = ("<div id=lead>two <i>masts</i></div><h1>Ebb &lt; Flood</h1><section><span class='ods-m-author-xl__name'>from the body</span>"
            "<span class='date'>2001-02-03</span></section><p>a rope</p><div><p>a sail loft ad</p></div><p>an oar</p>")
    head = '<meta content="k7" name="data-story-id">' + script({"dateModified": f"{TODAY} late"}) + script(
        {"@graph": [{"image": "/i/9.webp"}, {"author": [{"name": "R. Keel"}]}, {"articleSection": "tides", "datePublished": TODAY + "T01"}]}
    ) + '<meta name="keywords" content="ebb,flood">'
    profile = replace(NEWS_SITE, rules=CleaningRules(("sail loft",), ()), keep_lead=True)
    row = one(extract(spark, page(head, body), "https://tides.test/a/b", profile)).asDict()
    expected = dict(title="Ebb < Flood", url="https://tides.test/a/b", date=TODAY, content="a rope\nan oar", author="R. Keel", keywords="ebb,flood",
                    section="tides", date_modified=f"{TODAY} late", image_url="/i/9.webp", id="k7", read_time=1, outcome="accepted", errors=[])
    assert {k: row[k] for k in expected} == expected
    assert row["lead"].startswith("two")


AUTHOR_HOOKS = [("ods-m-author-xl__name-link", "span"), ("ods-m-author-xl__name", "em"), ("authorName", "div")]
DATE_HOOKS = [("ods-m-date-authorship__publication", "b"), ("date", "span")]


@pytest.mark.parametrize("first", range(len(AUTHOR_HOOKS)))
@pytest.mark.parametrize("head", ["", script("]broken["), script({"mast": 1})])
def test_author_hooks_by_rank(spark, first, head):
    hooks = "".join(f"<{tag} class='{cls}'>by {cls}</{tag}>" for cls, tag in reversed(AUTHOR_HOOKS[first:]))
    row = one(extract(spark, page(head, f"<p>oar</p>{hooks}<h1>q</h1><b class='{DATE_HOOKS[0][0]}'>{TODAY}</b>"), "https://tides.test/x/lastpart99"))
    assert (row.author, row.id) == (f"by {AUTHOR_HOOKS[first][0]}", "lastpart99")


@pytest.mark.parametrize("first", range(len(DATE_HOOKS)))
def test_date_hooks_by_rank(spark, first):
    days = [TODAY, "1999-01-01"][: len(DATE_HOOKS) - first]
    hooks = "".join(f"<{tag} class='{cls}'>{day} 08:15</{tag}>" for (cls, tag), day in reversed(list(zip(DATE_HOOKS[first:], days))))
    assert one(extract(spark, page("", f"{hooks}<h1>q</h1>"))).date == TODAY


def test_image_from_open_graph(spark):
    head = '<meta content="  /og.gif\t" property="og:image">' + script({"datePublished": TODAY, "image": 4})
    assert one(extract(spark, page(head, "<h1>q</h1>"))).image_url == "/og.gif"


def test_content_comes_from_hyphenate_only_if_it_has_text(spark):
    dated = script({"datePublished": TODAY})
    assert one(extract(spark, page(dated, "<h1>T</h1><p>plain text</p>"))).content == "plain text"
    assert one(extract(spark, page(dated, "<h1>T</h1>loose words<p>plain text</p>"))).content == "loose words"
    assert one(extract(spark, page(dated, "<h1>T</h1>", cls=""))).content is None
    short = one(extract(spark, page(dated, "<h1>T</h1><p>ok</p>")))
    assert (short.content, short.read_time) == ("", None)


@pytest.mark.parametrize("day", ["2020-01-01", "2026-03-03", "2026-02-26", "yesterday"])
def test_stale_pages_are_left_out(spark, day):
    body = f"<h1>T</h1><span class=date>{day}</span><p>x</p>"
    for html in (page(script({"datePublished": day}), body), page("", body)):
        assert extract(spark, html) == []
        assert one(extract(spark, html, keep_stale=True)).outcome == "stale"


def test_recency_reads_the_unstripped_first_text(spark):
    assert extract(spark, page("", f"<h1>T</h1><span class=date> {TODAY}</span><p>x</p>")) == []
    two = f"<h1>T</h1><span class=date>old</span><span class=date>{TODAY}</span><p>x</p>"
    assert extract(spark, page("", two)) == []
    first_class = f"<h1>T</h1><span class='date'>old</span><b class='ods-m-date-authorship__publication'>{TODAY}</b><p>x</p>"
    assert one(extract(spark, page("", first_class))).date == TODAY


@pytest.mark.parametrize("body, url, errors", [
    ("<p>x</p>", "https://e.test/a", ["title_missing"]),
    ("<h1> \xa0</h1><p>x</p>", "https://e.test/a", ["title_missing"]),
    ("<h1><b>inner</b></h1>", "https://e.test/a", ["title_missing"]),
    ("<h1>T</h1>", "ftp://e.test/a", ["url_scheme"]),
    ("<h1></h1>", "", ["title_missing", "url_missing"]),
    ("<h1>&lt;b&gt; &lt;/b&gt;</h1>", "httpx:a", ["title_blank"]),
])
def test_rejects(spark, body, url, errors):
    row = one(extract(spark, page(script({"datePublished": TODAY}), body), url=url))
    assert (row.outcome, row.errors) == ("rejected", errors)


def test_odd_json_ld_types_are_rejected(spark):
    row = one(extract(spark, page(script({"datePublished": TODAY, "author": {"name": 5}}), "<h1>T</h1>")))
    assert (row.outcome, row.errors) == ("rejected", ["json_ld_type:author"])
    row = one(extract(spark, page(script({"datePublished": [TODAY]}), "<h1>T</h1>")))
    assert row.outcome == "rejected" and "json_ld_type:datePublished" in row.errors


def test_validation_of_records(spark):
    rows = [("  padded ", "http://e/v", "2026-01-01"), ("", "http://e/v", "d"), ("   ", "https://e", "d"), (None, "http://e", "d"),
            ("T", "ftp://e", "d"), ("T", "https://e", "d"), ("T", None, None)]
    valid, rejected = articles.validate(spark.createDataFrame(rows, "title string, url string, date string"))
    assert sorted(r.title for r in valid.collect()) == ["T", "padded"]
    assert sorted(",".join(r.errors) for r in rejected.collect()) == [
        "title_blank", "title_blank", "title_missing", "url_missing,date_missing", "url_scheme"]


def test_own_checks_and_steps(spark):
    checks = (*articles.ARTICLE_CHECKS, ("no_author", lambda c: c("author").isNull()))
    pages = spark.createDataFrame([("https://e/a", page(script({"datePublished": TODAY}), "<h1> t <i>x</i></h1>"))], "url string, html string")
    shouting = replace(NEWS_SITE, steps={**NEWS_SITE.steps, "title": (*NEWS_SITE.steps["title"], F.upper)})
    row = articles.extract_records(pages, shouting, TODAY, checks=checks).first()
    assert (row.title, row.outcome, row.errors) == ("T", "rejected", ["no_author"])


def test_fields_without_selectors_stay_empty(spark):
    bare = replace(NEWS_SITE, selectors=Selectors(*[()] * 9))
    known = script({"datePublished": TODAY, "author": {"name": "B. Writer"}})
    row = one(extract(spark, page(known, "<h1>T</h1><p>x</p>"), profile=bare))
    assert (row.outcome, row.errors) == ("rejected", ["title_missing"])
    assert (row.author, row.date, row.content, row.keywords, row.id) == ("B. Writer", TODAY, None, None, "k7m9")


def test_html_is_scanned_once_and_only_needed_columns_are_read(spark, tmp_path):
    pages = spark.createDataFrame([("https://e/a", page(script({"datePublished": TODAY})), 1, "x")], "url string, html string, status int, other string")
    pages.write.parquet(str(tmp_path / "p"))
    good, bad = articles.extract_articles(spark.read.parquet(str(tmp_path / "p")), NEWS_SITE, TODAY)
    for df in (good, bad):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
        assert "Exchange" not in plan
        assert "ReadSchema: struct<url:string,html:string>" in plan


@pytest.mark.parametrize("page", [
    "<span>" * 60_000 + "</i>" * 60_000, "<i><div>" + "<span>" * 60_000 + "</i>" * 60_000, "<" * 300_000, "<" + "a" * 500_000, "<!-- a" * 60_000, "</p>" * 100_000,
])
def test_broken_markup_takes_linear_time(page):
    start = time.process_time()
    html.scan_page(page, html.element_reader(spec_for([by_tag("p")])))
    assert time.process_time() - start < 5


def test_pages_of_a_batch_are_scanned_a_few_megabytes_at_a_time(spark):
    pages = pa.array(["x" * 40, None, "y" * 70, "", "z" * 300, "é" * 60])
    runs = html.page_runs(pages, limit=100)
    assert [len(r) for r in runs] == [3, 2, 1] and pa.concat_arrays(runs) == pages
    assert html.page_runs(pages.slice(0, 0)) == []
    # 20 MB of HTML in one batch: Python gets it in several runs, and every row its own nodes.
    source = F.when(F.col("id") % 7 != 0, F.concat(F.lit("<h1>"), F.col("id"), F.lit("</h1>"), F.repeat(F.lit("-"), 200_000)))
    rows = spark.range(0, 100, 1, 1).select("id", source.alias("html"))
    runs = html.page_runs(pa.array(r.html for r in rows.collect()))
    assert len(runs) > 5 and max(sum(len(x or "") for x in r.to_pylist()) for r in runs) < html.SCANNED_BYTES + 200_100
    title = select_texts(html_nodes(F.col("html"), spec_for([by_tag("h1")])), by_tag("h1"))
    assert [(r.id, r.t) for r in rows.select("id", title.alias("t")).collect()] == [(i, [str(i)] if i % 7 else None) for i in range(100)]


def test_classes_are_compared_one_by_one(spark):
    """A class is told by comparing names, without the array search that costs a microsecond an element; innermost elements end without ranks."""
    page = "<p class='a b'>1<b>2</b></p><p>3</p><p class='ab'>4</p><div class='b'>5<p>6</div>7<span class='b'>8</div></span>9"
    rows = spark.createDataFrame([(page,), (None,)], "html string")
    selector = html.by_class("b")
    found = rows.select(html.select_texts(html.html_nodes(F.col("html"), html.spec_for([selector])), selector).alias("t"))
    assert [r.t for r in found.collect()] == [["1", "5", "8"], None]
    assert "array_contains" not in found._jdf.queryExecution().optimizedPlan().toString()
