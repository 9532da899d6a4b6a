"""URL functions, link routing, reach, fetch logs."""

import datetime as dt
import itertools
import random
from urllib.parse import urljoin, urlsplit

from pyspark.sql import functions as F

from pagetables.functions import urls
from pagetables.operators import fetchlog, links
from pagetables.plans.crawl import crawl_pages, crawl_reach, crowded_keys, next_targets, store_edges
from pagetables.profile import NEWS_SITE

HOME = "https://wiadomosci.onet.pl/"


def test_href_resolution_like_urljoin(spark):
    bases = ["http://a/b/c/d;p?q", "https://h.example.com", "https://h.example.com/", "http://u:p@h:81/x/y/?k=v#frag", "http://h/a/b/../c/./d"]
    hrefs = ["g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "", ".", "./", "..", "../", "../g", "../..", "../../", "../../g",
             "../../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "http://x/y", "mailto:a@b", "javascript:void(0)",
             "https:", "//x.test/p?q#f", "g?", "g#", "?", "#", "a//b", "/a//b", "g?y/../x", "g#s/../x", "HTTP://UP/x"]
    pairs = list(itertools.product(bases, hrefs))
    df = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "i int, b string, h string")
    got = {r.i: r.u for r in df.select("i", urls.absolute_url(F.col("b"), F.col("h")).alias("u")).collect()}
    wrong = []
    for i, (base, href) in enumerate(pairs):
        # A same-scheme reference without authority and the case of a scheme are not normalised.
        if href in ("https:", "HTTP://UP/x"):
            continue
        expected = urljoin(base, href)
        # urljoin leaves out the slash of an empty path; both name the same page.
        if got[i] != expected and got[i].rstrip("/") != expected.rstrip("/"):
            wrong.append((base, href, got[i], expected))
    assert wrong == []


def test_escape_and_parts(spark):
    values = [" /für ", "/a b", '/q"<>', "/ok%20?x=1&y=[z]", "/日本"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.u for r in df.select("i", urls.absolute_url(F.lit("http://h/p"), F.col("v")).alias("u")).orderBy("i").collect()]
    assert got == ["http://h/f%C3%BCr", "http://h/a%20b", "http://h/q%22%3C%3E", "http://h/ok%20?x=1&y=[z]", "http://h/%E6%97%A5%E6%9C%AC"]


def test_hosts_and_domains(spark):
    values = ["https://onet.pl/a", "https://x.onet.pl:8080/", "https://user@ONET.pl?x", "https://notonet.pl/", "https://onet.pl.evil.com/", "mailto:x"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", urls.url_host(F.col("v")).alias("h"), urls.in_domains(F.col("v"), ["onet.pl"]).alias("d")).orderBy("i").collect()
    assert [r.h for r in rows] == ["onet.pl", "x.onet.pl", "onet.pl", "notonet.pl", "onet.pl.evil.com", ""]
    assert [r.d for r in rows] == [True, True, True, False, False, False]
    ids = df.select(urls.url_id(F.lit("https://e/kraj/abc123")), urls.url_id(F.lit("https://e/kraj/Abc")), urls.url_id(F.lit("x/a\n"))).first()
    assert list(ids) == ["abc123", None, "a"]


def routed(spark, body, url=HOME, distinct=True):
    pages = spark.createDataFrame([(url, f"<html><body>{body}</body></html>")], "url string, html string")
    if distinct:
        rows = links.routed_page_links(pages, NEWS_SITE)
    else:
        rows = links.route_links(links.extract_links(pages, NEWS_SITE.regions()), NEWS_SITE)
    return {r.dst_url: (r.rule, r.action) for r in rows.collect()}, rows


def test_rules(spark):
    card = ["kraj/tytul-artykulu/xyz123", "swiat/inny-artykul/abc999", "tylko-kategoria/cos", "kraj/tytul", "oferta/reklama/123",
            "kraj/artykul/123?utm=sponsored", "partner/artykul/123", "kraj/artykul/123#top", "sport/artykul/123", "kraj/2024-05/123",
            "kraj/a/photo.jpg", "kraj", "szukaj", "pogoda"]
    body = "".join(f'<a href="{HOME}{path}" class="ods-c-card-wrapper">x</a>' for path in card)
    body += f'<div class="ods-o-card big"><ul><li><a href="/kraj/w-karcie/a1">x</a></li></ul></div><a href="/kraj/poza-karta/a2">x</a>'
    body += '<a class="pager next" href="/kraj?page=2">next</a><a href="https://przegladsportowy.onet.pl/x">p</a><a>no href</a>'
    body += '<a href="mailto:x@onet.pl">m</a><area href="/swiat">'
    got, _ = routed(spark, body)
    parse, follow, drop, none = ("article", "parse"), ("category", "follow"), ("skip", "drop"), (None, None)
    assert got == {
        HOME + "kraj/tytul-artykulu/xyz123": parse, HOME + "swiat/inny-artykul/abc999": parse,
        HOME + "tylko-kategoria/cos": none, HOME + "kraj/tytul": none, HOME + "oferta/reklama/123": none,
        HOME + "kraj/artykul/123?utm=sponsored": none, HOME + "partner/artykul/123": none, HOME + "kraj/artykul/123#top": none,
        HOME + "sport/artykul/123": drop, HOME + "kraj/2024-05/123": drop, HOME + "kraj/a/photo.jpg": none,
        HOME + "kraj": follow, HOME + "szukaj": none, HOME + "pogoda": drop,
        HOME + "kraj/w-karcie/a1": parse, HOME + "kraj/poza-karta/a2": none,
        HOME + "kraj?page=2": ("pagination", "follow"), "https://przegladsportowy.onet.pl/x": none,
        "mailto:x@onet.pl": none, HOME + "swiat": follow,
    }
    assert routed(spark, body, distinct=False)[0] == got


def test_page_links_are_distinct_by_earliest_rule(spark):
    body = '<a href="/kraj/a/b1">outside</a><div class=ods-o-card><a href="/kraj/a/b1">1</a><a href="/kraj/a/b1">2</a></div><a href="/x">3</a><a href="/x">4</a>'
    _, rows = routed(spark, body)
    assert sorted((r.dst_url, r.pos, r.rule) for r in rows.collect()) == [(HOME + "kraj/a/b1", 1, "article"), (HOME + "x", 3, "category")]
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_base_element_moves_links(spark):
    pages = spark.createDataFrame([("https://e.test/a/b", "<head><base href='/other/'></head><body><a href='x'>1</a></body>")], "url string, html string")
    assert [r.dst_url for r in links.extract_links(pages).collect()] == ["https://e.test/other/x"]


def reach_model(edges, seeds, max_depth):
    depth = {s: (0, True) for s in seeds}
    for level in range(1, max_depth + 1):
        found = {}
        for src, dst, follow in edges:
            if depth.get(src, (None, False)) == (level - 1, True) and dst not in depth:
                found[dst] = found.get(dst, False) or follow
        depth.update({url: (level, follow) for url, follow in found.items()})
    return sorted((url, d) for url, (d, _) in depth.items())


def test_reach_against_model(spark):
    rng = random.Random(3)
    nodes = [f"/n{i}" for i in range(60)]
    # One hub holds a third of all edges, and edges repeat.
    edges = [("/n0", rng.choice(nodes), rng.random() < 0.7) for _ in range(60)]
    edges += [(rng.choice(nodes[:20]), rng.choice(nodes), rng.random() < 0.5) for _ in range(60)] + [("/n59", "/n59", True)]
    df = spark.createDataFrame(edges, "src string, dst string, follow boolean")
    seeds = spark.createDataFrame([("/n7",), ("/n7",), ("/gone",)], "url string")
    for depth in (1, 3):
        assert sorted(tuple(r) for r in crawl_reach(df, seeds, depth).collect()) == reach_model(edges, ["/n7", "/gone"], depth)


def test_levels_do_not_move_the_edges(spark, tmp_path):
    edges = spark.range(500).select(F.concat(F.lit("/n"), F.col("id") % 50).alias("src"), F.concat(F.lit("/n"), "id").alias("dst"))
    table, hubs = store_edges(edges, str(tmp_path / "edges"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = next_targets(spark.table(table), hubs, spark.createDataFrame([("/n3",)], "url string"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql(f"DROP TABLE {table}")
    scan = next(i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line)
    join = next(i for i, line in enumerate(plan.splitlines()) if "Join" in line)
    assert join < scan and not any("Exchange" in line for line in plan.splitlines()[join:scan])


def test_only_hubs_are_dealt_over_shares(spark, tmp_path):
    edges = spark.range(3000).select(F.when(F.col("id") < 2500, F.lit("/hub")).otherwise(F.concat(F.lit("/n"), F.col("id") % 50)).alias("src"), F.concat(F.lit("/d"), "id").alias("dst"))
    table, hubs = store_edges(edges, str(tmp_path / "edges"), links_a_share=100)
    assert [tuple(r) for r in hubs.collect()] == [("/hub", 25)]
    shares = spark.table(table).groupBy("src").agg(F.count_distinct("share").alias("n"), F.max("share").alias("top")).collect()
    assert {r.src: r.top for r in shares if r.top} == {"/hub": 24} and len(shares) == 51
    wanted = spark.createDataFrame([("/hub",), ("/n3",)], "url string")
    assert next_targets(spark.table(table), hubs, wanted).count() == 2510
    spark.sql(f"DROP TABLE {table}")


def test_links_are_counted_by_numbers(spark):
    """Degrees of all pages take no URLs through a shuffle; what a shared number may add is sorted out by URL."""
    edges = spark.range(40).select(F.when(F.col("id") < 12, F.lit("/hub")).otherwise(F.concat(F.lit("/n"), "id")).alias("src"), F.lit("/d").alias("dst"))
    keys = crowded_keys(edges, 10)
    exchange = [line for line in keys._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchange) == 1 and "src" not in exchange[0]
    assert [r.k for r in keys.collect()] == [spark.range(1).select(F.xxhash64(F.lit("/hub")).alias("k")).first().k]


def test_plain_urls_are_told_by_one_look_up_a_character(spark):
    """The pattern names its characters, and takes the URLs that the pattern of ranges took."""
    ranges = r"^(?:[a-z][a-z0-9+.\-]*://[^/?#A-Z]+)?/[A-Za-z0-9/._*!$&'()+,;=:@~-]*$"
    assert "a-z" not in urls.PLAIN_URL and "0-9" not in urls.PLAIN_URL
    forms = ["/{}", "/a{}b", "{}/a", "h{}://e/a", "http://e{}f/a", "http://e/{}", "{}", "/a{}", "http://e{}", "http://{}/"]
    rows = [(f.replace("{}", c),) for f in forms for c in [*map(chr, range(1, 256)), "", "\u017c", "//", "a\n", "\r\n"]]
    told = spark.createDataFrame(rows, "u string").select(F.col("u").rlike(ranges).alias("was"), F.col("u").rlike(urls.PLAIN_URL).alias("now"))
    assert told.filter("was <> now").count() == 0 and told.filter("was").count() > 500


CANONICAL = [
    ("HTTP://User@Example.COM:81?b=2&a=1#f", "http://user@example.com:81/?a=1&b=2"),
    ("https://e.com/a%41%2fb%7E/./x?", "https://e.com/aA%2Fb~/./x"),
    ("https://e.com/p?b&a=&&a=%20+c&a=%2B", "https://e.com/p?a=&a=%2B&a=++c&b="),
    ("https://e.com/?x=%zz&a=1", "https://e.com/?a=1&x=%zz"),
    ("https://e.com/ż%C5%BC?q=ż", "https://e.com/%C5%BC%C5%BC?q=%C5%BC"),
    ("https://e.com/a,b;%2c%3B/(x)", "https://e.com/a,b;,;/(x)"), ("https://e.com/a b", "https://e.com/a%20b"),
    ("/part/7", "/part/7"), ("", ""), (None, None),
]


def test_canonical_urls(spark):
    rows = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(CANONICAL)], "i int, url string")
    once = rows.withColumn("once", urls.canonical_url(F.col("url"))).withColumn("twice", urls.canonical_url(F.col("once")))
    for row in once.collect():
        assert row.once == CANONICAL[row.i][1] and row.twice == row.once


def test_spellings_of_a_page_are_one(spark):
    edges = spark.createDataFrame([("https://e/a?x=1&y=2", "https://E/b#1"), ("https://e/b", "https://e/a?y=2&x=1#z"), ("https://e/b#2", "https://e/c?q=a%20b"), ("https://e/c?q=a+b", "https://e/d")], "src string, dst string")
    got = crawl_reach(edges, spark.createDataFrame([("https://e/a?y=2&x=1",), ("https://e/a?x=1&y=2#t",)], "url string"))
    assert sorted(tuple(r) for r in got.collect()) == [("https://e/a?x=1&y=2", 0), ("https://e/b", 1), ("https://e/c?q=a+b", 2), ("https://e/d", 3)]


def test_crawl_over_stored_pages(spark):
    def page(path, *hrefs):
        return HOME + path, "<body><div class=ods-o-card>" + "".join(f'<a href="/{h}">x</a>' for h in hrefs) + "</div></body>"

    stored = [page("", "kraj", "kraj/a/1", "sport/b/2"), page("kraj", "kraj/a/1", "kraj/b/3", "swiat", ""), page("kraj/a/1", "kraj/c/9"), page("swiat", "kraj")]
    got = crawl_pages(spark.createDataFrame(stored, "url string, html string"), NEWS_SITE)
    # The article page is reached but not followed, and a dropped link is not taken.
    assert sorted((r.url.removeprefix(HOME), r.depth) for r in got.collect()) == [("", 0), ("kraj", 1), ("kraj/a/1", 1), ("kraj/b/3", 2), ("swiat", 2)]


def test_fetch_outcomes(spark):
    art = "https://wiadomosci.onet.pl/artykul"
    ts = dt.datetime(2026, 3, 1, 12)
    headers = {"Content-Encoding": "gzip", "content-encoding": "br", "CONTENT-ENCODING": "x", "Server": "s"}
    log = [
        (art, 200, art, headers, None, ts), (art, 403, art, {}, None, ts), (art, 503, art, {}, None, ts),
        (art, 200, "https://www.onet.pl", {}, None, ts), (art, 200, "https://onet.pl//", {}, None, ts), (art, 404, art, {}, None, ts),
        (art, None, None, None, "timeout", ts), ("https://example.com/wiadomosci", 403, "https://example.com/", {}, None, ts),
        ("https://www.onet.pl/", 200, "https://www.onet.pl/", {}, None, ts), (art, 200, "https://m.onet.pl/x", {}, None, ts),
    ]
    df = fetchlog.classify_fetches(spark.createDataFrame(log, fetchlog.FETCH_LOG_SCHEMA).coalesce(1), NEWS_SITE)
    rows = df.collect()
    assert [(r.outcome, r.effective_status) for r in rows] == [
        ("ok", 200), ("block", 504), ("block", 504), ("soft_ban", 504), ("soft_ban", 504), ("ok", 404),
        ("error", 504), ("passthrough", 403), ("ok", 200), ("ok", 200)]
    assert (rows[9].page_url, rows[3].page_url, rows[6].page_url) == ("https://m.onet.pl/x", art, art)
    kept = df.select(fetchlog.clean_headers(F.col("headers")).alias("h")).first().h
    assert kept == {"CONTENT-ENCODING": "x", "Server": "s"}
    counts = {(r.outcome, r.host): r.n for r in fetchlog.outcome_counts(df).collect()}
    assert counts[("block", "wiadomosci.onet.pl")] == 2 and sum(counts.values()) == 10


def test_latest_outcome(spark):
    rows = [("u", 503, "u", None, None, dt.datetime(2026, 1, 1)), ("u", 200, "u2", None, None, dt.datetime(2026, 1, 2)),
            ("v", 200, "v", None, None, dt.datetime(2026, 1, 2)), ("v", None, None, None, "boom", dt.datetime(2026, 1, 3))]
    log = [("https://onet.pl/" + r[0], *r[1:]) for r in rows]
    latest = fetchlog.latest_outcome(fetchlog.classify_fetches(spark.createDataFrame(log, fetchlog.FETCH_LOG_SCHEMA), NEWS_SITE))
    assert sorted((r.requested_url[-1], r.outcome, r.effective_status, r.attempts) for r in latest.collect()) == [("u", "ok", 200, 2), ("v", "error", 504, 2)]


def test_latest_outcome_ties_and_plan(spark, tmp_path):
    draw = random.Random(4)
    rows = [(f"u{draw.randrange(5)}" if i % 3 else "hot", None if i % 50 == 0 else dt.datetime(2026, 1, 1, 0, i % 7), draw.choice([None, 200, 504]),
             draw.choice(["a", "b", None]), draw.choice(["ok", "block"])) for i in range(600)]
    schema = "requested_url string, ts timestamp, effective_status int, page_url string, outcome string"
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(str(tmp_path / "f"))
    latest = fetchlog.latest_outcome(spark.read.parquet(str(tmp_path / "f")))
    low = lambda v: (v is not None, v or 0)
    text = lambda v: (v is not None, v or "")
    best = {}
    for r in rows:
        key = ((r[1] is not None, r[1] or dt.datetime.min), low(r[2]), text(r[3]), text(r[4]))
        best[r[0]] = max(best.get(r[0], (key, r)), (key, r), key=lambda x: x[0])
    got = {r.requested_url: (r.ts, r.effective_status, r.page_url, r.outcome, r.attempts) for r in latest.collect()}
    assert got == {u: (r[1], r[2], r[3], r[4], sum(x[0] == u for x in rows)) for u, (_, r) in best.items()}
    assert "SortAggregate" not in latest._jdf.queryExecution().executedPlan().toString()


def test_urls_of_model_are_split_like_the_library(spark):
    url = "https://h.example.com:81/a/b?x=1#f"
    part = spark.range(1).select(urls.url_parts(F.lit(url)).alias("p")).first().p
    assert (part.scheme, part.authority, part.path, part.query, part.fragment) == ("https", *urlsplit(url)[1:3], "?x=1", "#f")
