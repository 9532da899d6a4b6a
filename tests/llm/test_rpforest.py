import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetables.llm import rpforest
from pagetables.llm.queries import QUERIES


def brute(rows, asked, k):
    """The k nearest of every query, ties to the smaller id."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=float)
    out = {}
    for i, v in rows:
        if asked(i):
            d = np.sqrt(((x - np.array(v, dtype=float)) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_query(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = brute(rows, lambda i: i % 100 == 0, 10)
    got = by_query(QUERIES["op4_nearest"](spark, "/root/testdata/sf0.1").collect())
    assert set(got) == set(want) and all(len(g) == 10 for g in got.values())
    assert recall(got, want) >= 0.93
    x = {i: np.array(v, dtype=float) for i, v in rows}
    for q, found in got.items():
        for i, score in found:
            assert score == pytest.approx(np.sqrt(((x[q] - x[i]) ** 2).sum()), abs=1e-12)


def nearest(spark, rows, folder, k=3, **options):
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, entry string, score double")
    return by_query(rpforest.nearest(df, F.col("vec_id") % 2 == 0, str(folder), k=k, **options).collect())


def test_copies_ties_and_tiles(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rpforest, "TILE_VECTORS", 5)
    monkeypatch.setattr(rpforest, "TILE_QUERIES", 3)
    rng = np.random.default_rng(2)
    points = [tuple(p) for p in rng.integers(-2, 3, (40, 3)).astype(float).tolist() if any(p)]
    rows = [(i, list(points[i % len(points)] if i % 3 else points[0])) for i in range(200)]
    want = brute(rows, lambda i: i % 2 == 0, 6)
    got = nearest(spark, rows, tmp_path, k=6, leaf=8, target=1.0)
    assert recall(got, want) >= 0.97
    exact = nearest(spark, rows, tmp_path / "x", k=6, leaf=1000)
    assert {q: [i for i, _ in g] for q, g in exact.items()} == {q: [i for i, _ in w] for q, w in want.items()}


def test_vectors_that_take_no_part(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (4, [0.0, 0.0]), (6, [nan, 1.0]), (8, [inf, 1.0]), (10, [None, 1.0]), (12, []), (14, [1.0]), (None, [1.0, 1.0]),
            (16, [-0.0, 1.0]), (16, [-0.0, 1.0])]
    got = nearest(spark, rows, tmp_path / "a")
    assert {q: [i for i, _ in g] for q, g in got.items()} == {0: [1, 16], 16: [1, 0]}
    assert nearest(spark, [], tmp_path / "b") == {}
    assert nearest(spark, [(2, [1.0, 2.0])], tmp_path / "c") == {}


def test_queue_visits_all_leaves_by_margin():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6))
    forest = rpforest.Forest.fit(x, trees=3, leaf=40)
    leaves = forest.leaves(x)
    counts = np.stack([np.bincount(leaves[:, t], minlength=2**forest.depth) for t in range(3)])
    order = forest.visit(forest.margins(x[:1])[0], 10**6, counts, 0)
    assert len(order) == len(set(order)) == 3 * 2**forest.depth
    assert {t for t, _ in order[:3]} == {0, 1, 2} and all(leaves[0, t] == leaf for t, leaf in order[:3])
    assert rpforest.calibrate(forest, x, 10, 1.0) <= len(order)
