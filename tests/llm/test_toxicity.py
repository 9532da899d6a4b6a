import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetables.llm import toxicity
from pagetables.llm.learn import area_under_roc
from pagetables.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.1"


def random_vectors(rng, n, features=40, most=6):
    out = []
    for _ in range(n):
        f = rng.choice(features, rng.integers(1, most), replace=False)
        w = rng.integers(1, 4, len(f)).astype(float)
        out.append(dict(zip(f.tolist(), (w / np.linalg.norm(w)).tolist())))
    return out


@pytest.mark.parametrize("k, skip", [(1, -1), (7, -1), (16, 3), (1000, -1)])
def test_search_equals_brute_force(k, skip):
    rng = np.random.default_rng(k)
    vectors = random_vectors(rng, 300)
    ids = rng.permutation(300).tolist()
    index = toxicity.BlockMaxIndex(vectors, ids, block=8)
    for query in random_vectors(rng, 40):
        cosines = [sum(w * v.get(f, 0.0) for f, w in query.items()) for v in vectors]
        want = sorted((i for i, c in enumerate(cosines) if c > 0 and i != skip), key=lambda i: (-round(cosines[i], 12), ids[i]))[:k]
        at, got = index.nearest(query, k, skip)
        assert got == pytest.approx([cosines[i] for i in want])
        assert [ids[i] for i in at] == [ids[i] for i in want]


def test_blocks_are_skipped():
    rng = np.random.default_rng(0)
    vectors = [{int(f): 1.0} for f in rng.integers(0, 50, 4000)]
    index = toxicity.BlockMaxIndex(vectors, list(range(4000)), block=16)
    index.nearest({7: 1.0}, 5)
    # Ties at the bound must be looked at for the smaller id, so all blocks that hold the feature may be visited, and no other.
    assert index.visited <= sum(7 in columns for _, columns, _ in index.blocks) < len(index.blocks) / 10


def test_held_out(spark):
    rows = spark.range(50).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_query_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = QUERIES["op8_toxicity"](spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    test = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    scores, truth = np.array([s for s, _ in test]), np.array([t for _, t in test])
    assert area_under_roc(scores, truth) > 0.93
    assert ((scores >= 0.5) & (truth == 0)).sum() < 0.02 * len(truth)
    assert ((scores >= 0.5) & (truth == 1)).sum() > 0.85 * truth.sum()


def test_edges(spark, tmp_path):
    words = ["calm", "kind", "green", "quiet"]
    rows = [(i, f"{words[i % 4]} text {'vile' if i % 3 == 0 else ''}", "x", 1.0) for i in range(90)]
    rows += [(900, None, "x", 0.0), (901, "", None, None), (902, "VILE " + "calm " * 100_000, "x", 0.0), (902, "vile", "x", 0.0), (None, "vile", "x", 0.0)]
    rows += [(12, "another calm text of a labelled id", "x", 0.0), (12, "vile third", "x", 0.0), (12, "vile third", "x", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, counts string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(80)] + [(5, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels, str(tmp_path / "a")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].score > 0.5 and by_id[902].score > 0.5 and by_id[87].score > 0.5
    assert by_id[88].score < 0.5 and by_id[900].score < 0.5 and by_id[901].score < 0.5
    assert by_id[88].evidence == [] and {e.label for e in by_id[87].evidence} == {1}
    assert toxicity.score_documents(docs.limit(0), labels, str(tmp_path / "b")).count() == 0
    none = toxicity.score_documents(docs, labels.limit(0), str(tmp_path / "c")).collect()
    assert {r.score for r in none} == {0.0}


def test_counting_and_scoring_of_texts_take_one_python_worker_a_task(spark):
    docs, labels = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(3_000), spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.fit(docs, labels, train_rows=300)
    counted = docs.select("doc_id", toxicity.counter(docs, model)("text").alias("counts"))
    two = toxicity.weigh(toxicity.choose(docs, labels, train_rows=300), counted)
    assert model.idf.tolist() == two.idf.tolist() and (model.slope, model.shift, model.blank) == (two.slope, two.shift, two.blank)
    scored = docs.select("doc_id", toxicity.text_scorer(docs, model)("text").alias("found"))
    assert scored._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    want = {r.doc_id: r.found for r in counted.select("doc_id", toxicity.scorer(docs, two)("counts").alias("found")).collect()}
    assert {r.doc_id: r.found for r in scored.collect()} == want


def test_counts_are_packed_without_a_python_object_a_count():
    rows = [{3: 1, 1: 2}, {}, {7: 5}]
    assert toxicity._packed_counts(rows).to_pylist() == [[{"f": f, "n": n} for f, n in c.items()] for c in rows]
    assert toxicity._packed_counts([]).to_pylist() == []
