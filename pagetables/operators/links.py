"""Links of stored pages: extraction, per-page dedupe and rule-based routing. No shuffle: all work stays on the page row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.text import strip
from pagetables.functions.urls import WEB_SCHEMES, absolute_url, escape_url, in_domains, resolve_href, url_parts
from pagetables.operators.html import NodeSpec, Selector, first_text, html_nodes
from pagetables.profile import LinkRule, SiteProfile

_ANCHOR = Selector(tag="a", take="href")
_AREA = Selector(tag="area", take="href")
_BASE = Selector(tag="base", take="href")
_ANCHOR_CLASS = Selector(tag="a", take="class")


def link_spec(regions: Sequence[str] = ()) -> NodeSpec:
    return NodeSpec((_ANCHOR, _AREA, _BASE, _ANCHOR_CLASS), tuple(regions))


def _any_of(patterns: Sequence[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def _is_page_url(url: Column, deny_extensions: Sequence[str]) -> Column:
    valid = url.rlike(rf"^(?:{'|'.join(WEB_SCHEMES)})://")
    if not deny_extensions:
        return valid
    endings = "|".join(e.replace(".", r"\.") for e in deny_extensions)
    return valid & ~url.rlike(rf"^[^?#]*\.(?i:{endings})(?:[?#]|\z)")


def rule_matches(rule: LinkRule, link: Column) -> Column:
    """`link` has dst_url, region_classes and anchor_class."""
    url = link["dst_url"]
    tests = []
    if rule.allow:
        tests.append(url.rlike(_any_of(rule.allow)))
    if rule.deny:
        tests.append(~url.rlike(_any_of(rule.deny)))
    if rule.deny_domains:
        tests.append(~in_domains(url, rule.deny_domains))
    if rule.regions:
        tests.append(F.arrays_overlap(link["region_classes"], F.array(*[F.lit(r) for r in rule.regions])))
    if rule.anchor_class_part:
        tests.append(F.coalesce(F.contains(link["anchor_class"], F.lit(rule.anchor_class_part)), F.lit(False)))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def rule_number(rules: Sequence[LinkRule], link: Column, deny_extensions: Sequence[str] = ()) -> Column:
    """1-based number of the first matching rule, or null."""
    choice = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, start=1))):
        choice = F.when(rule_matches(rule, link), F.lit(number)).otherwise(choice)
    return F.when(_is_page_url(link["dst_url"], deny_extensions), choice)


def _label(rules: Sequence[LinkRule], number: Column, field: str) -> Column:
    choice = F.lit(None).cast("string")
    for position, rule in enumerate(rules, start=1):
        choice = F.when(number == position, F.lit(getattr(rule, field))).otherwise(choice)
    return choice


def _page_links(pages: DataFrame, regions: Sequence[str]) -> DataFrame:
    """url plus one array of resolved links per page."""
    scanned = pages.select("url", html_nodes(F.col("html"), link_spec(regions)).alias("nodes"))
    nodes = F.col("nodes")
    based = scanned.select("url", "nodes", first_text(nodes, _BASE).alias("base_href")).select(
        "url",
        "nodes",
        url_parts(
            F.when(F.col("base_href").isNull(), F.col("url")).otherwise(absolute_url(F.col("url"), F.col("base_href")))
        ).alias("base"),
    )
    found = F.filter(nodes, lambda n: n["tag"].isin("a", "area") & n["attrs"]["href"].isNotNull())
    return based.select(
        "url",
        F.transform(
            found,
            lambda n, i: F.struct(
                i.alias("pos"),
                n["attrs"]["href"].alias("href"),
                resolve_href(F.col("base"), escape_url(strip(n["attrs"]["href"]))).alias("dst_url"),
                n["regions"].alias("region_classes"),
                n["attrs"]["class"].alias("anchor_class"),
            ),
        ).alias("links"),
    )


def _link_rows(page_links: DataFrame, links: Column) -> DataFrame:
    # A plain inline makes Catalyst infer a size filter and evaluate the whole link expression for it once more.
    rows = page_links.select(F.col("url").alias("src_url"), F.inline_outer(links))
    return rows.filter(F.col("pos").isNotNull())


def extract_links(pages: DataFrame, regions: Sequence[str] = ()) -> DataFrame:
    """(src_url, pos, href, dst_url, region_classes, anchor_class): every anchor, in document order."""
    return _link_rows(_page_links(pages, regions), F.col("links"))


def route_links(links: DataFrame, profile: SiteProfile) -> DataFrame:
    """Adds rule_no, rule, action (of the first matching rule, null when none does) and in_domain."""
    link = F.struct("dst_url", "region_classes", "anchor_class")
    rules = profile.link_rules
    numbered = links.withColumn("rule_no", rule_number(rules, link, profile.deny_extensions))
    return numbered.withColumns({
        "rule": _label(rules, F.col("rule_no"), "name"),
        "action": _label(rules, F.col("rule_no"), "action"),
        "in_domain": in_domains(F.col("dst_url"), profile.allowed_domains),
    })


def routed_page_links(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    """One row per page and distinct target: the anchor that the earliest rule takes, first in document order.

    Links are routed and deduplicated inside the page's own array, so no rows are shuffled.
    """
    rules = profile.link_rules
    numbered = _page_links(pages, profile.regions()).select(
        "url",
        F.transform(
            "links",
            lambda k: F.struct(
                k["dst_url"].alias("dst_url"),
                F.coalesce(rule_number(rules, k, profile.deny_extensions), F.lit(len(rules) + 1)).alias("rule_no"),
                k["pos"].alias("pos"),
                k["href"].alias("href"),
            ),
        ).alias("links"),
    )
    ordered = numbered.select("url", F.sort_array("links").alias("links"))
    distinct = F.filter(
        "links", lambda k, i: (i == 0) | (k["dst_url"] != F.get(F.col("links"), i - 1)["dst_url"])
    )
    flat = _link_rows(ordered, distinct)
    rule_no = F.nullif(F.col("rule_no"), F.lit(len(rules) + 1))
    return flat.select(
        "src_url",
        "pos",
        "href",
        "dst_url",
        _label(rules, rule_no, "name").alias("rule"),
        _label(rules, rule_no, "action").alias("action"),
        in_domains(F.col("dst_url"), profile.allowed_domains).alias("in_domain"),
    )


def crawl_edges(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    """(src, dst) of the links a crawl would take: routed to parse or follow, inside the allowed domains."""
    taken = F.col("action").isin("parse", "follow") & F.col("in_domain")
    return routed_page_links(pages, profile).filter(taken).select(F.col("src_url").alias("src"), F.col("dst_url").alias("dst"), "action")
