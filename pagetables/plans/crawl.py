"""Which URLs a depth-bounded crawl over stored links would reach, and how deep."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.functions.urls import canonical_url
from pagetables.operators.links import crawl_edges
from pagetables.plans.workspace import delete_folder, new_folder, store
from pagetables.profile import SiteProfile

# Links of one page that a task may hold; pages with more are dealt over several shares.
LINKS_A_SHARE = 50_000


def crowded_keys(edges: DataFrame, links_a_share: int = LINKS_A_SHARE) -> DataFrame:
    """(k) hashes of pages with more links than one share holds: those of all hubs, and at worst of a few other pages."""
    return edges.groupBy(F.xxhash64("src").alias("k")).count().filter(F.col("count") > links_a_share).select("k")


def hub_shares(edges: DataFrame, links_a_share: int = LINKS_A_SHARE) -> DataFrame:
    """(src, shares) of the pages with more links than one share holds, from the degree of every page."""
    degrees = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree")).filter(F.col("degree") > links_a_share)
    return degrees.select("src", F.ceil(F.col("degree") / links_a_share).cast("int").alias("shares"))


def store_edges(edges: DataFrame, folder: str, links_a_share: int = LINKS_A_SHARE) -> tuple[str, DataFrame | None]:
    """Edges as a table bucketed by source, and by share if there are hubs; the table's name, and the shares of the hubs (None without any).

    Pages that are no hubs have share 0 alone. Few pages can be hubs, so they usually come to the edges by broadcast. All links are counted by
    a number that stands for their page; by the page itself only where that number is a hub's.
    """
    spark = edges.sparkSession
    follow = F.col("follow") if "follow" in edges.columns else F.lit(True)
    plain = store(edges.select("src", "dst", follow.alias("follow")), f"{folder}/plain")
    crowded, hubs = store(crowded_keys(plain, links_a_share), f"{folder}/crowded"), None
    if not crowded.isEmpty():
        hubs = store(hub_shares(plain.join(crowded, F.xxhash64("src") == F.col("k"), "left_semi"), links_a_share), f"{folder}/hubs")
        hubs = None if hubs.isEmpty() else hubs
    dealt, keys = plain, ["src"]
    if hubs is not None:
        share = F.pmod(F.xxhash64("dst"), F.coalesce("shares", F.lit(1))).cast("int").alias("share")
        dealt, keys = plain.join(hubs, "src", "left").select("src", "dst", "follow", share), ["src", "share"]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"crawl_edges_{uuid.uuid4().hex}"
    dealt.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", f"{folder}/edges").saveAsTable(name)
    return name, hubs


def next_targets(links: DataFrame, hubs: DataFrame | None, expand: DataFrame) -> DataFrame:
    """(dst, follow) of the links that leave the pages of `expand` (url). The stored links are joined where they lie; only hubs are
    looked for in more than one share."""
    sources = expand.select(F.col("url").alias("src"))
    if hubs is not None:
        every = F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)).alias("share")
        sources = sources.join(hubs, "src", "left").select("src", every)
    return links.join(sources, sources.columns).groupBy("dst").agg(F.bool_or("follow").alias("follow"))


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Edges between canonical URLs, so that spellings of a page are one page."""
    return edges.withColumns({"src": canonical_url(F.col("src")), "dst": canonical_url(F.col("dst"))})


def crawl_reach(edges: DataFrame, seeds: DataFrame, max_depth: int = 5, links_a_share: int = LINKS_A_SHARE) -> DataFrame:
    """(url, depth) with the smallest depth per canonical URL, seeds at depth 0.

    `edges` has src, dst and optionally follow: URLs reached only over edges with follow = false are recorded but not
    expanded. Frontier and visited pages are compared as canonical URLs (see `canonical_url`). Edges move once, into buckets by source;
    a level moves its frontier and the targets found, not the edges.
    Each level is written to the shared folder, so plans do not grow with depth. The bucketed table and its files are dropped at the end.
    """
    spark = edges.sparkSession
    folder = new_folder(spark, "crawl")
    table, hubs = store_edges(canonical_edges(edges), f"{folder}/links", links_a_share)
    try:
        links = spark.table(table)
        start = seeds.select(canonical_url(F.col("url")).alias("url")).distinct().select("url", F.lit(0).alias("depth"), F.lit(True).alias("follow"))
        frontier = reached = store(start, f"{folder}/depth=0")
        for depth in range(1, max_depth + 1):
            expand = frontier.filter("follow").select("url")
            targets = next_targets(links, hubs, expand).withColumnRenamed("dst", "url")
            fresh = targets.join(reached.select("url"), "url", "left_anti")
            frontier = store(fresh.select("url", F.lit(depth).alias("depth"), "follow"), f"{folder}/depth={depth}")
            if frontier.isEmpty():
                break
            reached = reached.unionByName(frontier)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete_folder(spark, f"{folder}/links")
    return reached.select("url", "depth")


def crawl_pages(pages: DataFrame, profile: SiteProfile, seeds: DataFrame | None = None) -> DataFrame:
    """What a crawl of the stored pages would reach from the profile's start pages (or from `seeds`).

    Links routed to `parse` are recorded but not expanded, links routed to `follow` are.
    """
    if seeds is None:
        seeds = pages.sparkSession.createDataFrame([(url,) for url in profile.start_urls], "url string")
    edges = crawl_edges(pages, profile).select("src", "dst", (F.col("action") == "follow").alias("follow"))
    return crawl_reach(edges, seeds, profile.max_depth)
