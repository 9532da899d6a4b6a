"""Merkle dataset manifest: a tree over the rows of every source, and one over the sources, with a proof for each row.

A leaf is the SHA-256 of a row's columns, each as `-` (null) or as byte count, colon and value. Sorted by id, the leaves of a source
are joined in runs of `FAN`, level by level, until one node remains; the nodes that remain of all sources are the leaves of the upper tree,
whose last node is the root. A node joins the digests below it as hexadecimal text, and a run of one is hashed, too.

Nodes are labelled by nested intervals: a node covers the ranks [lo, hi) of leaves. Labels alone say what belongs together. Levels are
bucketed, LEVELS levels to a bucket: an interval's bucket number within its band of levels is its rank divided by FAN ** LEVELS, so that a
containment join of nodes with the ancestors above their band is a join on equal numbers, and no interval is compared with others. Inside a bucket the
ancestors of a node are the intervals around its own, and its siblings are what its parent's interval holds beside it: those before `lo` and those from `hi` on.

The tree is built upwards, a shuffle a band: 729 leaves or fewer come together and leave one node. Then the ways up are attached downwards: every
band gets the ways of its top nodes by the containment join. A task holds single buckets, whatever the size of a source; ranks come from
sorted ranges (see `positions`), so a source with most of the rows is spread like all others. The number of bands grows with the
logarithm of the rows.

Defined results: null sources are a source of their own, first; null ids come first in a source and count as empty decimals where a
checksum picks rows to tamper with; equal ids are ordered by leaf, equal rows are leaves of their own; null texts stay null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import ship, slices
from pagetables.llm.positions import with_starts
from pagetables.plans.workspace import new_folder, store

FAN = 3
LEVELS = 6
# Rows of a batch that leaves a task; a way up takes a few kilobytes at most.
OUT_ROWS = 4096
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def joined(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def levels_of(total: int) -> int:
    """How often runs are joined until one of `total` nodes remains."""
    levels = 0
    while total > 1:
        total, levels = -(-total // FAN), levels + 1
    return levels


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(_field, values)).cast("binary"), 256)


def leaves(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, text: str = "text") -> DataFrame:
    """(doc_id, branch, leaf, tampered): `tampered` is the leaf of a row whose text has lost its line feeds, null where none is to be lost."""
    plain = [F.col(c) for c in columns]
    thinned = [F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == text else F.col(c) for c in columns]
    key, source = F.col(columns[0]), F.col(columns[1])
    picked = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 2 == 0
    return docs.select(
        key.alias("doc_id"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("branch"),
        leaf_digest(*plain).alias("leaf"), F.when(picked & F.contains(F.col(text), F.lit("\n")), leaf_digest(*thinned)).alias("tampered"),
    )


def band_levels(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of a bucket, its own level first, after each of `levels` joins."""
    found = [digests]
    for _ in range(levels):
        below = found[-1]
        found.append([joined(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return found


def siblings(level: list[str], low: int, width: int, lo: int, hi: int, parent_lo: int, parent_hi: int) -> tuple[list[str], list[str]]:
    """What a parent's interval holds beside the node [lo, hi): the nodes before and after it. Nodes of this level are `width` ranks wide and begin at `low`."""
    def at(rank: int) -> int:
        return -(-(rank - low) // width)

    return level[at(parent_lo) : at(lo)], level[at(hi) : at(parent_hi)]


def way_up(levels: list[list[str]], low: int, width: int, lo: int, end: int) -> list[str]:
    """The siblings on the way from the node at `lo` to the top of its bucket, a level an entry: left ones, a comma, right ones."""
    way = []
    for level in levels[:-1]:
        wide = width * FAN
        parent_lo = lo // wide * wide
        left, right = siblings(level, low, width, lo, min(lo + width, end), parent_lo, min(parent_lo + wide, end))
        way.append(f"{''.join(left)},{''.join(right)}")
        lo, width = parent_lo, wide
    return way


def folded(leaf: str, way: str) -> str:
    """The root that a leaf and the siblings on its way up give."""
    for level in way.split(";") if way else ():
        left, right = level.split(",")
        leaf = joined([left, leaf, right])
    return leaf


def proof(way: str) -> str:
    """The digest of all siblings on a way, level by level, left to right."""
    return sha256(way.replace(";", "").replace(",", "").encode()).hexdigest()


def _buckets(nodes: DataFrame, band: int, each: int) -> DataFrame:
    """(branch, bucket, total, members): the nodes of a band by bucket, members in order of rank."""
    bucket = F.expr(f"lo div {(FAN ** each) ** (band + 1)}")
    return nodes.groupBy("branch", bucket.alias("bucket")).agg(F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("lo", "digest", "row"))).alias("members"))


def build(items: DataFrame, each: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """The bands of the trees of all branches, lowest first, and what remains: (branch, total, top).

    `items`: branch, lo, total, digest and row (anything that goes with a leaf).
    """
    spark = items.sparkSession
    ship(spark)
    bands, nodes, done = [], items.select("branch", "lo", "total", "digest", "row"), None
    for band in range(64):
        width = (FAN**each) ** band
        grouped = store(_buckets(nodes, band, each), new_folder(spark, f"manifest-band{band}"))
        bands.append(grouped)

        def tops(batches: Iterator[pa.RecordBatch], width: int = width, band: int = band) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                branch, bucket, total, members = (batch.column(i) for i in range(4))
                out = []
                for n, digests in zip(total.to_pylist(), _digests(members)):
                    levels = min(each, levels_of(n) - band * each)
                    out.append(band_levels(digests, levels)[-1][0])
                lo = [b * width * FAN**each for b in bucket.to_pylist()]
                yield pa.RecordBatch.from_arrays([branch, pa.array(lo, pa.int64()), total, pa.array(out, pa.string())], names=["branch", "lo", "total", "digest"])

        top = store(grouped.mapInArrow(tops, "branch string, lo long, total long, digest string"), new_folder(spark, f"manifest-top{band}"))
        ready = F.col("total") <= FAN ** (each * (band + 1))
        finished = top.filter(ready).select("branch", "total", F.col("digest").alias("top"))
        done = finished if done is None else done.unionByName(finished)
        rest = top.filter(~ready)
        if rest.isEmpty():
            return bands, done
        nodes = rest.select("*", F.lit(None).cast(items.schema["row"].dataType).alias("row"))
    raise ValueError("more levels than ranks have digits")


def _digests(members: pa.ListArray) -> list[list[str]]:
    flat, offsets = members.flatten().field(1).to_pylist(), members.offsets.to_pylist()
    first = offsets[0]
    return [flat[a - first : b - first] for a, b in zip(offsets, offsets[1:])]


def ways(bands: list[DataFrame], each: int = LEVELS) -> DataFrame:
    """(branch, lo, total, digest, row, way) of all leaves; `way` holds their siblings up to the top of the branch."""
    spark = bands[0].sparkSession
    above = None
    for band in reversed(range(len(bands))):
        width = (FAN**each) ** band
        row_type = bands[band].schema["members"].dataType.elementType["row"].dataType.simpleString()
        held = bands[band]
        if above is None:
            held = held.withColumn("above", F.lit(""))
        else:
            wide = (FAN**each) ** (band + 1)
            ancestors = above.select("branch", F.expr(f"lo div {wide}").alias("bucket"), F.col("way").alias("above"))
            held = held.join(ancestors, ["branch", "bucket"], "left").withColumn("above", F.coalesce("above", F.lit("")))

        def attach(batches: Iterator[pa.RecordBatch], width: int = width, band: int = band) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                branch, bucket, total, members, over = (batch.column(i) for i in range(5))
                flat, begins = members.flatten(), members.offsets.to_numpy()
                ends, spans = begins - begins[0], list(zip(bucket.to_pylist(), total.to_pylist(), _digests(members), over.to_pylist()))
                for a, z in slices((len(s[2]) for s in spans), OUT_ROWS):
                    at, found = [], []
                    for i in range(a, z):
                        b, n, digests, upper = spans[i]
                        levels = band_levels(digests, min(each, levels_of(n) - band * each))
                        low = b * width * FAN**each
                        for j in range(len(digests)):
                            way = way_up(levels, low, width, low + j * width, n)
                            found.append(";".join([*way, upper] if upper else way))
                        at += [i] * len(digests)
                    spread, held = pa.array(at, pa.int64()), flat.slice(int(ends[a]), int(ends[z] - ends[a]))
                    columns = [branch.take(spread), held.field(0), total.take(spread), held.field(1), held.field(2), pa.array(found, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=["branch", "lo", "total", "digest", "row", "way"])

        schema = f"branch string, lo long, total long, digest string, row {row_type}, way string"
        above = held.select("branch", "bucket", "total", "members", "above").mapInArrow(attach, schema)
        if band:
            above = store(above, new_folder(spark, f"manifest-ways{band}"))
    return above


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, text: str = "text", each: int = LEVELS) -> DataFrame:
    """One row a document: doc_id, leaf, tampered, subroot, root, way (its siblings up to the root) of the original rows."""
    spark = docs.sparkSession
    ship(spark)
    hashed = store(leaves(docs, columns, text).withColumn("one", F.lit(1).cast("long")), new_folder(spark, "manifest-leaves"))
    ranked = with_starts(hashed, ["doc_id", "leaf"], "one", "branch", "lo")
    lower, tops = build(ranked.select("branch", "lo", "total", F.col("leaf").alias("digest"), F.struct("doc_id", "tampered").alias("row")), each)
    subroots = store(tops.select("branch", F.col("top").alias("subroot"), F.lit(1).cast("long").alias("one")), new_folder(spark, "manifest-subroots"))
    placed = with_starts(subroots, ["branch"], "one", None, "lo")
    upper, roots = build(placed.select(F.lit("").alias("branch"), "lo", "total", F.col("subroot").alias("digest"), F.struct(F.col("branch").alias("source")).alias("row")), each)
    over = ways(upper, each).join(roots.select("branch", F.col("top").alias("root")), "branch")
    sources = over.select(F.col("row.source").alias("branch"), F.col("digest").alias("subroot"), F.col("way").alias("upper_way"), "root")
    sources = store(sources, new_folder(spark, "manifest-sources"))
    rows = ways(lower, each).join(sources, "branch")
    return rows.select(
        F.col("row.doc_id").alias("doc_id"), F.col("digest").alias("leaf"), F.col("row.tampered").alias("tampered"), "subroot", "root",
        F.concat_ws(";", F.nullif("way", F.lit("")), F.nullif("upper_way", F.lit(""))).alias("way"),
    )


def verify(rows: DataFrame) -> DataFrame:
    """`rows` of a manifest with proof_sha256, folded_root (from the tampered leaf, if any, and the siblings) and verified."""
    ship(rows.sparkSession)

    @F.arrow_udf("proof string, folded string")
    def fold(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for leaf, way in batches:
            held = way.to_pylist()
            yield pa.StructArray.from_arrays([pa.array(list(map(proof, held)), pa.string()), pa.array(list(map(folded, leaf.to_pylist(), held)), pa.string())], ["proof", "folded"])

    marked = rows.withColumn("check", fold.asNondeterministic()(F.coalesce("tampered", "leaf"), "way"))
    return marked.select("doc_id", "leaf", "subroot", "root", F.col("check.proof").alias("proof_sha256"), F.col("check.folded").alias("folded_root"),
                         (F.col("check.folded") == F.col("root")).alias("verified"))
