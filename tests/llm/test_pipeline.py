"""The pipeline against its stages' single decisions, worked out anew from plain parts."""

import random

import public_tokenizers
import pytest
from test_pii import plain_spans
from test_setjoin import plain_components
from tokenizers import Tokenizer

import corpus_pipeline
from pagetables.llm import quality

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What every stage leaves."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "t")
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_stay(kept):
    for name in list(kept)[:-1]:
        assert kept[name].dtypes == kept["documents"].dtypes


def test_rejects_follow_the_labels(spark, kept):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    good, calm = ids(kept["quality classifier"]), ids(kept["toxicity"])
    assert len([i for i, r in labels.items() if r.quality == 1 and i not in good]) <= 0.02 * len(labels)
    assert len([i for i, r in labels.items() if r.quality == 0 and i in good]) <= 0.02 * len(labels)
    known = [r for i, r in labels.items() if i in good]
    assert len([r for r in known if r.toxic == 0 and r.doc_id not in calm]) <= 0.02 * len(known)
    assert len([r for r in known if r.toxic == 1 and r.doc_id in calm]) <= 0.35 * len([r for r in known if r.toxic == 1])
    assert calm <= good and quality.KEPT_FROM == 0.5


def test_one_of_each_group_stays(kept):
    rows = [(r.doc_id, r.text) for r in kept["toxicity"].collect()]
    want = {i for i, (_, low) in plain_components(rows, percent=80, k=5).items() if i == low or low is None}
    assert ids(kept["n-gram Jaccard join"]) == want


def test_no_personal_data_is_left(kept):
    before = {r.doc_id: r for r in kept["n-gram Jaccard join"].collect()}
    for r in kept["PII"].collect():
        assert plain_spans(r.text or "") == []
        if not plain_spans(before[r.doc_id].text or ""):
            assert r.text == before[r.doc_id].text or "[" in r.text
        assert r.n_chars == len(r.text)


def test_every_token_is_packed_once(kept):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in kept["packing"].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    texts = {r.doc_id: r.text for r in kept["PII"].collect()}
    assert set(pieces) == set(texts)
    for doc in random.Random(0).sample(sorted(texts), 40):
        got = b"".join(b for _, b in sorted(pieces[doc]))
        want = library.encode(texts[doc] or "", add_special_tokens=False).ids + [2]
        assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == want


def test_edges(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, counts string"
    rows = [(1, None, None, None, None, 0.1, "x"), (2, "", "en", "s", 0, None, None), (3, "some words", "en", "s", 10, 0.0, ""), (3, "some words", "en", "s", 10, 0.0, "")]
    docs = spark.createDataFrame(rows, schema)
    for source in (docs, docs.limit(0)):
        left = source
        for name, stage in corpus_pipeline.STAGES:
            left = stage(spark, left, SF_DIR)
            if name != "packing":
                assert left.columns == docs.columns
        assert left.count() == (3 if source is docs else 0)
