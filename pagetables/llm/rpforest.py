"""Approximate nearest neighbours by a forest of random-projection trees with exact reranking.

The trees are fitted on a bounded sample (`sample_rows` vectors of smallest hash): every node projects on a random direction and
splits at the sample's median. All vectors are then dealt to one leaf a tree. A query searches all trees through one
priority queue: nodes come off by their smallest margin to the splits on their way, whichever tree they are of, until `effort`
leaves are found. The effort is set by the sample's own neighbours: the fewest leaves that give `target` recall there.
The vectors of the visited leaves are candidates, and their exact distances decide.

Equal vectors are one entry of the index that knows its k + 1 smallest ids, which is all that any result can show of it; equal
queries are searched once. Leaves with many vectors or many visiting queries are cut into tiles, so that a task never holds more than
TILE_VECTORS by TILE_QUERIES. The forest itself is a few megabytes at most.

Defined results: null ids, and vectors that are null, empty, zero, of another length than most, or that hold null or non-finite
components, take no part. Ties go to the smaller id. With fewer candidates than k all are returned. Rows of equal id and vector count once.
Only id and vector are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import ship
from pagetables.plans.workspace import store

TILE_VECTORS = 4096
TILE_QUERIES = 1024


@dataclass
class Forest:
    """Complete binary trees, stored level by level: node i has the children 2i + 1 and 2i + 2."""

    directions: np.ndarray  # trees x inner nodes x dimension
    splits: np.ndarray  # trees x inner nodes
    depth: int

    @staticmethod
    def fit(sample: np.ndarray, trees: int, leaf: int, seed: int = 11) -> Forest:
        rng = np.random.default_rng(seed)
        depth = max(0, int(np.log2(max(len(sample), 1) / leaf))) if len(sample) > leaf else 0
        inner = 2**depth - 1
        directions = rng.normal(size=(trees, inner, sample.shape[1]))
        splits = np.zeros((trees, inner))
        for t in range(trees):
            members = {0: np.arange(len(sample))}
            for node in range(inner):
                at = members.pop(node)
                projected = sample[at] @ directions[t, node]
                splits[t, node] = np.median(projected) if len(at) else 0.0
                right = projected >= splits[t, node]
                members[2 * node + 1], members[2 * node + 2] = at[~right], at[right]
        return Forest(directions, splits, depth)

    @property
    def trees(self) -> int:
        return len(self.splits)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """vectors x trees x inner nodes; negative to the left."""
        return np.einsum("nd,tid->nti", x, self.directions, optimize=True) - self.splits

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf (numbered from 0) of every vector in every tree."""
        at = np.zeros((len(x), self.trees), dtype=np.int64)
        if self.depth:
            margins = self.margins(x)
            for _ in range(self.depth):
                at = 2 * at + 1 + (np.take_along_axis(margins, at[:, :, None], axis=2)[:, :, 0] >= 0)
        return at - (2**self.depth - 1)

    def visit(self, margins: np.ndarray, effort: int, counts: np.ndarray, enough: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue: `effort` leaves, and more until one tree alone has given `enough` vectors."""
        first_leaf = 2**self.depth - 1
        queue = [(-np.inf, t, 0) for t in range(self.trees)]
        found, seen = [], [0] * self.trees
        while queue and (len(found) < effort or max(seen) < enough):
            rank, t, node = heapq.heappop(queue)
            if node >= first_leaf:
                found.append((t, node - first_leaf))
                seen[t] += int(counts[t, node - first_leaf])
                continue
            m = float(margins[t, node])
            heapq.heappush(queue, (max(rank, m), t, 2 * node + 1))
            heapq.heappush(queue, (max(rank, -m), t, 2 * node + 2))
        return found


def calibrate(forest: Forest, sample: np.ndarray, k: int, target: float, probes: int = 200) -> int:
    """The fewest leaves with which the sample's own k nearest neighbours are found to `target` on average."""
    leaf_of = forest.leaves(sample)
    n_leaves = 2**forest.depth
    counts = np.stack([np.bincount(leaf_of[:, t], minlength=n_leaves) for t in range(forest.trees)])
    probe = np.arange(0, len(sample), max(1, len(sample) // probes))[:probes]
    margins = forest.margins(sample[probe]) if forest.depth else np.zeros((len(probe), forest.trees, 0))
    needed = np.zeros(forest.trees * n_leaves + 1)
    total = 0
    for row, i in enumerate(probe):
        distance = ((sample - sample[i]) ** 2).sum(axis=1)
        distance[i] = np.inf
        near = np.argsort(distance)[: min(k, len(sample) - 1)]
        order = {v: n for n, v in enumerate(forest.visit(margins[row], forest.trees * n_leaves, counts, 0), 1)}
        for j in near:
            needed[min(order[(t, int(leaf_of[j, t]))] for t in range(forest.trees))] += 1
        total += len(near)
    return int(np.searchsorted(np.cumsum(needed), target * total)) if total else 1


def taking_part(embedding: Column) -> Column:
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & fine & F.exists(embedding, lambda x: x != 0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def nearest(vectors: DataFrame, is_query: Column, folder: str, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 10,
            trees: int = 4, leaf: int = 64, sample_rows: int = 16_384, target: float = 0.97) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every row where `is_query` holds."""
    spark = vectors.sparkSession
    ship(spark)
    given = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), is_query.alias("asked")).filter(
        F.col("vec_id").isNotNull() & taking_part(F.col("embedding")))
    schema = "query_id long, rank int, vec_id long, score double"
    widths = given.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return spark.createDataFrame([], schema)
    width = widths["width"]
    given = given.filter(F.size("embedding") == width).withColumn("asked", F.coalesce("asked", F.lit(False)))
    entries = store(given.groupBy("embedding").agg(F.min("vec_id").alias("entry"), F.max("asked").alias("asked")), f"{folder}/entries")
    own = given.join(entries.select("embedding", "entry"), "embedding").select("entry", "vec_id", "asked").distinct()
    own = store(own, f"{folder}/own")

    sample = entries.orderBy(F.xxhash64("entry"), "entry").limit(sample_rows).select("embedding").toArrow()["embedding"]
    sample = _matrix(sample, width)
    forest = Forest.fit(sample, trees, leaf)
    effort = calibrate(forest, sample, k, target)
    kind = entries.schema["embedding"].dataType.simpleString()
    placed = f"entry long, embedding {kind}, tree int, leaf int"

    def rows(batch: pa.RecordBatch, at: np.ndarray, tree: np.ndarray, leaves: np.ndarray) -> pa.RecordBatch:
        picked = pa.array(at)
        return pa.RecordBatch.from_arrays(
            [batch.column("entry").take(picked), batch.column("embedding").take(picked), pa.array(tree, pa.int32()), pa.array(leaves, pa.int32())],
            names=["entry", "embedding", "tree", "leaf"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                leaves = forest.leaves(_matrix(batch.column("embedding"), width))
                n = len(leaves)
                yield rows(batch, np.repeat(np.arange(n), trees), np.tile(np.arange(trees), n), leaves.ravel())

    indexed = store(entries.select("entry", "embedding").mapInArrow(deal, placed), f"{folder}/index")
    # One row a leaf of the forest: bounded by trees * sample_rows / leaf.
    filled = indexed.groupBy("tree", "leaf").count().collect()
    counts = np.zeros((trees, 2**forest.depth), dtype=np.int64)
    for r in filled:
        counts[r.tree, r.leaf] = r["count"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                x = _matrix(batch.column("embedding"), width)
                margins = forest.margins(x) if forest.depth else np.zeros((len(x), trees, 0))
                visits = [forest.visit(m, effort, counts, k + 1) for m in margins]
                flat = np.array([v for vs in visits for v in vs]).reshape(-1, 2)
                yield rows(batch, np.repeat(np.arange(len(x)), [len(v) for v in visits]), flat[:, 0], flat[:, 1])

    asked = store(entries.filter("asked").select("entry", "embedding").mapInArrow(search, placed), f"{folder}/visits")
    visited = asked.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("queries"))
    sizes = indexed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("vectors")).join(visited, ["tree", "leaf"]).select(
        "tree", "leaf", F.ceil(F.col("vectors") / TILE_VECTORS).cast("int").alias("down"), F.ceil(F.col("queries") / TILE_QUERIES).cast("int").alias("across"))
    sizes = F.broadcast(sizes)  # a row a leaf, as above

    def tiled(side: DataFrame, own_count: str, other_count: str, own_name: str, other_name: str) -> DataFrame:
        return side.join(sizes, ["tree", "leaf"]).select(
            "tree", "leaf", F.pmod(F.xxhash64("entry"), F.col(own_count)).cast("int").alias(own_name),
            F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)).alias(other_name), "entry", "embedding")

    tile = ["tree", "leaf", "i", "j"]
    left = tiled(indexed, "down", "across", "i", "j").groupBy(*tile)
    right = tiled(asked, "across", "down", "j", "i").groupBy(*tile)

    def rerank(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        ids, found = candidates["entry"].to_numpy(), []
        asked_ids = queries["entry"].to_numpy()
        if len(ids) and len(asked_ids):
            x, q = _matrix(candidates["embedding"], width), _matrix(queries["embedding"], width)
            for start in range(0, len(q), 256):
                part = q[start : start + 256]
                rough = (part**2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None] - 2 * part @ x.T
                kept = min(k + 1, len(ids))
                limit = np.partition(rough, kept - 1, axis=1)[:, kept - 1]
                slack = 1e-9 * ((part**2).sum(axis=1) + (x**2).sum(axis=1).max())
                for row in range(len(part)):
                    near = np.flatnonzero(rough[row] <= limit[row] + slack[row])
                    exact = np.sqrt(((x[near] - part[row]) ** 2).sum(axis=1))
                    order = np.lexsort((ids[near], exact))[:kept]
                    found.append((np.full(len(order), asked_ids[start + row]), ids[near][order], exact[order]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"query": pa.array(columns[0], pa.int64()), "entry": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    candidates = left.cogroup(right).applyInArrow(rerank, "query long, entry long, score double")
    best = candidates.groupBy("query", "entry").agg(F.min("score").alias("score"))
    by_query = Window.partitionBy("query").orderBy("score", "entry")
    best = best.withColumn("place", F.row_number().over(by_query)).filter(F.col("place") <= k + 1).select("query", "entry", "score")
    by_entry = Window.partitionBy("entry").orderBy("vec_id")
    members = own.select("entry", "vec_id").distinct().withColumn("place", F.row_number().over(by_entry)).filter(F.col("place") <= k + 1).select("entry", "vec_id")
    # At most (k + 1) ** 2 rows a distinct query; its k + 1 best hold the k best of each row that asks it.
    expanded = best.join(members, "entry").withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id")))
    top = store(expanded.filter(F.col("place") <= k + 1).select("query", "vec_id", "score", "place"), f"{folder}/top")
    queries = own.filter("asked").select(F.col("entry").alias("query"), F.col("vec_id").alias("query_id"))
    # A row that asks takes itself out: later places move up by one.
    self_place = top.select("query", F.col("vec_id").alias("query_id"), F.col("place").alias("self"))
    with_self = queries.join(self_place, ["query", "query_id"], "left")
    answered = with_self.join(top, "query").filter(F.col("vec_id") != F.col("query_id"))
    rank = F.col("place") - F.when(F.col("place") > F.coalesce("self", F.lit(2**31 - 1)), 1).otherwise(0)
    return answered.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
