import zlib

import numpy as np
import pytest

from pagetables.llm import quality
from pagetables.llm.learn import area_under_roc, fit_logistic, predict_logistic
from pagetables.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.1"


def test_query_on_rows_kept_from_the_views(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = QUERIES["op1_quality"](spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    held = [(r.score, labels[r.doc_id]) for r in rows if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 4 == 0]
    scores, truth = np.array([s for s, _ in held]), np.array([t for _, t in held])
    assert area_under_roc(scores, truth) > 0.98
    assert ((scores < quality.KEPT_FROM) & (truth == 1)).sum() < 0.01 * len(truth)
    assert ((scores < quality.KEPT_FROM) & (truth == 0)).sum() > 0.9 * (truth == 0).sum()


@pytest.mark.parametrize("text", ["", " ", "\n\n", "a", "é漢😀", "x" * 100_000, "!!!" * 1000])
def test_features_are_finite(text):
    for values, n in ((quality.content_features(text), quality.N_CONTENT), (quality.metadata_features(None, "s", len(text)), quality.N_METADATA)):
        assert len(values) == n and np.isfinite(values).all()


def documents(spark, n=160):
    rows = [(i, ("plain words of prose here. " if i % 4 else "WIN!! $$$ ### ") * (1 + i % 5), "en", f"s{i % 3}", "clash") for i in range(n)]
    rows += [(1000, None, None, None, None), (1001, "", "en", "s1", "x"), (None, "plain words", "en", "s1", "x"), (3, "plain words of prose here.", "en", "s0", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, features string")


def test_edges(spark, tmp_path):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(120)] + [(5, None), (None, 0), (7, 1)], "doc_id long, quality int")
    scored, model = quality.score_documents(docs, labels, str(tmp_path / "a"))
    by_id = {r.doc_id: r.score for r in scored.collect()}
    assert scored.count() == docs.count()
    assert by_id[130] > 0.5 and by_id[132] < 0.5 and all(0 <= s <= 1 for s in by_id.values())
    again = docs.select("doc_id", quality.score_column(docs, model).alias("s")).filter("doc_id = 132").first()
    assert again.s == pytest.approx(by_id[132])
    assert quality.score_documents(docs.limit(0), labels, str(tmp_path / "b"))[0].count() == 0
    for kept, constant in ((labels.limit(0), 1.0), (labels.filter("quality = 0"), 0.0), (labels.filter("quality = 1"), 1.0)):
        scores = quality.score_documents(docs, kept, str(tmp_path / f"c{constant}{kept.count()}"))[0]
        assert {r.score for r in scores.collect()} == {constant}


def described(spark, n=600):
    """Texts and sources both tell the quality, each wrongly for a few; groups of copies of one bad text."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        good = i % 3 > 0
        looks, comes = (good ^ (rng.random() < 0.06) for _ in range(2))
        words = " ".join(rng.choice(["plain", "words", "of", "prose", "here."], 5 + i % 40))
        rows.append((i, words if looks else words.upper() + " $$$ !!!", "en", "paper" if comes else "spam", int(rng.integers(20, 400))))
    return spark.createDataFrame(rows + [(n + i, "WIN $$$", "en", "spam", 7) for i in range(300)], "doc_id long, text string, lang string, source string, n_chars int")


def plain_co_training(table, truth, rounds, steps, confident, weight):
    """The same rounds on whole matrices, with every pseudo-labelled example in hand."""
    views = ("content", "metadata")
    train = sorted((i, x) for i, x in table if i in truth and zlib.crc32(str(i).encode()) % 4)
    y = np.array([float(truth[i]) for i, _ in train])
    x = {v: np.array([f[k] for _, f in train]) for k, v in enumerate(views)}
    rest = sorted({f for i, f in table if i not in truth})
    u = {v: np.array([f[k] for f in rest]) for k, v in enumerate(views)}
    w = {v: fit_logistic(x[v], y, l2=0.1) for v in views}
    for _ in range(rounds):
        p = {v: predict_logistic(u[v], w[v]) for v in views}
        for view, teacher in zip(views, reversed(views)):
            xs, ys, ws = [x[view]], [y], [np.ones(len(y))]
            for label in (0, 1):
                sure = u[view][(p[teacher] if label else 1 - p[teacher]) >= confident]
                xs.append(sure)
                ys.append(np.full(len(sure), float(label)))
                ws.append(np.full(len(sure), weight * min(1, (y == label).sum() / max(len(sure), 1))))
            all_x = np.column_stack([np.vstack(xs), np.ones(sum(map(len, xs)))])
            all_y, all_w = np.concatenate(ys), np.concatenate(ws)
            penalty = np.array([0.1] * x[view].shape[1] + [1e-6])
            for _ in range(steps):
                q = 1 / (1 + np.exp(-(all_x @ w[view])))
                step = np.linalg.solve(all_x.T @ (all_x * (all_w * q * (1 - q))[:, None]) + np.diag(penalty + 1e-9), all_x.T @ (all_w * (q - all_y)) + penalty * w[view])
                w[view] = w[view] - step / max(1, np.abs(step).max() / 5)
    return w


def test_rounds_equal_brute_force(spark, tmp_path):
    """Every confident document counts once; both views follow; the combination is right where one view is not."""
    docs = described(spark)
    truth = {i: int(i % 3 > 0) for i in range(200)}
    labels = spark.createDataFrame(list(truth.items()), "doc_id long, quality int")
    docs.select("doc_id", quality.featured(docs).alias("features")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    options = {"rounds": 2, "steps": 3, "confident": 0.8, "weight": 0.3}
    alone = quality.co_train(table, labels, str(tmp_path / "u"), **{**options, "rounds": 0})
    taught = quality.co_train(table, labels, str(tmp_path / "v"), **options)
    local = [(r.doc_id, (tuple(r.features.content), tuple(r.features.metadata))) for r in table.collect()]
    want = plain_co_training(local, truth, **options)
    assert taught.content == pytest.approx(want["content"], rel=1e-4, abs=1e-4)
    assert taught.metadata == pytest.approx(want["metadata"], rel=1e-4, abs=1e-4)
    assert not np.allclose(alone.content, taught.content) and not np.allclose(alone.metadata, taught.metadata)
    scores = {r.doc_id: r.s for r in table.select("doc_id", quality.scorer(taught)("features").alias("s")).collect()}
    assert sum((scores[i] >= 0.5) != (i % 3 > 0) for i in range(200, 600)) < 50 and all(scores[i] < 0.5 for i in range(600, 900))
    assert np.array(list(taught.calibration.values())).shape == (2, 2)


def test_one_text_a_labelled_id(spark, tmp_path):
    """An id on very many rows gives one example; a size column that is missing or null is a value of its own."""
    docs = documents(spark).unionByName(spark.range(500).selectExpr("cast(5 as long) doc_id", "concat('text ', id) text", "'en' lang", "'s1' source", "'x' features"))
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(120)], "doc_id long, quality int")
    assert quality.score_documents(docs, labels, str(tmp_path / "a"))[0].count() == docs.count()
    assert quality.metadata_features("en", "s", None) != quality.metadata_features("en", "s", 0)


def test_logistic_recovers_weights():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < predict_logistic(x, np.array([1.5, -2.0, 0.5]))).astype(float)
    assert fit_logistic(x, y, l2=1e-3) == pytest.approx([1.5, -2.0, 0.5], abs=0.25)


def test_area_under_roc():
    assert area_under_roc(np.array([1.0, 2, 2, 3]), np.array([0, 0, 1, 1])) == pytest.approx(0.875)
