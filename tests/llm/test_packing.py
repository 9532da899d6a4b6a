import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagetables.llm import packing
from pagetables.llm.queries import QUERIES
from pagetables.llm.tokens import WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def want_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("text", ["", " a b c\x85d", "a\x1cb c\x1dd", "It's THE 12 !!\n\nÉtion é <|endoftext|> x<|startoftext|>y", "ﬁ İ ς Σ. 漢字 😀", "x" * 3000])
def test_words_encode_like_whole_texts(text):
    got = np.frombuffer(WordTokenizer(PATH, "<u2").encode([text])[0], dtype="<u2").tolist()
    assert got + [2] == want_ids(text)


def check(rows, texts):
    """Every id once, gapless sequences, no padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids, at = want_ids(texts[doc]), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : at], dtype="<u4").tobytes())
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    check(QUERIES["op6_packing"](spark, "/root/testdata/sf0.001").collect(), texts)


def test_edges(spark):
    schema = "doc_id long, text string, ids string, mix int"
    rows = [(1, None, "a", 1), (2, "", "b", 2), (3, "word " * 30_000, None, None), (None, "x y", "c", 3)]
    docs = spark.createDataFrame(rows, schema)
    pieces = packing.pack(docs, PATH, block_tokens=5000)
    check(pieces.withColumn("ids_crc32", F.crc32("ids")).collect(), {r[0]: r[1] for r in rows})
    assert packing.pack(docs.filter("doc_id = 99"), PATH).count() == 0
    repeated = packing.pack(spark.createDataFrame([(7, "same text")] * 5, "doc_id long, text string"), PATH).collect()
    assert sum(r.length for r in repeated) == 5 * len(want_ids("same text"))
    joined = packing.sequences(pieces).collect()
    assert sum(r.length for r in joined) == sum(len(r.ids) // 4 for r in joined) == sum(len(want_ids(r[1])) for r in rows)


def test_assignment_takes_the_cheapest_sequence_that_fits():
    pieces = packing.assign(np.array([6, 6, 2, 1, 1]), 8, 1.0, 1.0)
    assert [(d, s, n, q) for d, s, n, q, _ in pieces] == [(0, 0, 6, 0), (1, 0, 6, 1), (2, 0, 2, 0), (3, 0, 1, 1), (4, 0, 1, 1)]


def test_attention_cost_is_balanced():
    lengths = np.random.default_rng(1).integers(1, 900, 600)
    pieces = packing.assign(lengths, 4096, 1.0, 1 / 64)
    cost, full = {}, {}
    for _, _, n, q, _ in pieces:
        cost[q] = cost.get(q, 0) + n + n * n / 64
        full[q] = full.get(q, 0) + n
    costs = [cost[q] for q in cost if full[q] == 4096]
    assert max(costs) < 1.3 * min(costs)
    assert len(pieces) < len(lengths) + len(cost)
