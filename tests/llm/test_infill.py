import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from pagetables.llm import infill
from pagetables.llm.queries import QUERIES
from pagetables.llm.sql import ORACLE


def plain_model(doc_id, text, rate=90, spm_rate=20):
    """The same by code points."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return "plain", n, None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_rate:
        return "spm", n, a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", n, a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(QUERIES["op11_fill_in_middle"](spark, sf), duck(sf), ORACLE["op11_fill_in_middle"]) == []


def test_index_against_every_cut():
    text = "aé€😀zß" * 7 + "plain" + "\U0010ffff"
    data = np.frombuffer(text.encode(), np.uint8)
    index = infill.ExceptionIndex(data)
    cuts = np.arange(len(text) + 1)
    begins = np.array([len(text[:c].encode()) for c in cuts])
    assert index.bytes_at(cuts).tolist() == begins.tolist()
    assert index.chars_at(begins).tolist() == cuts.tolist()
    assert len(index.at) == sum(ord(c) > 127 for c in text)  # nothing is recorded for ASCII


def test_batches_with_an_offset():
    texts = pa.array(["xé", "", "€" * 5, "abc", "<S", "a<M>b"])
    numbers = [np.full(4, k, np.int64) for k in (2, 1, 0, 50)]
    whole = infill.transform_batch(texts.slice(2), numbers, 90, 20).to_pylist()
    assert [r["output"] for r in whole] == ["<P>€<S>€€€<M>€", "<P>a<S>c<M>b", "<P><<S><M>S", "a<M>b"]
    assert whole[0] == {"form": "psm", "n": 5, "prefix_chars": 1, "middle_chars": 1, "output": "<P>€<S>€€€<M>€"}
    assert whole[3]["form"] == "plain" and whole[3]["prefix_chars"] is None


CASES = [
    (1, None), (2, ""), (3, "ä"), (4, "a<P>b"), (5, "<P"), (6, "<" * 40), (7, "<M><S>"), (8, "日本語" * 200_000), (8, "日本語" * 200_000),
    (9, "x" * 3_000_000), (None, "no key, é"), (10, "line\n\r\n  end "), (11, "\x00tail"), (12, "<S"), (12, "other text of the same key"),
]


@pytest.mark.parametrize("rate, spm_rate", [(90, 20), (100, 0), (100, 100), (0, 20)])
def test_cases_and_round_trip(spark, rate, spm_rate):
    draw = random.Random(5)
    rows = CASES + [(k, "".join(draw.choices("ab<>PSM é€😀", k=draw.randrange(30)))) for k in range(100, 400)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, form string, output int")
    made = infill.fill_in_middle(docs, rate=rate, spm_rate=spm_rate)
    got = made.select("*", infill.restored(F.col("output"), F.col("form")).alias("again")).collect()
    want = sorted(((i, *plain_model(i, t, rate, spm_rate), t or "") for i, t in rows), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert infill.fill_in_middle(docs).collect() == []


def test_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert "Exchange" not in infill.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
