import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetables.llm import repeats
from pagetables.llm.queries import QUERIES


def plain_repeats(rows, length=100):
    """Windows in order of id and place; each is covered if it was seen before."""
    seen, out = set(), []
    keyed = [(i, (t or "").encode()) for i, t in rows]
    for i, text in sorted(keyed, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1]).digest())):
        gone = np.zeros(len(text) + 1, bool)
        for s in range(len(text) - length + 1):
            window = text[s : s + length]
            if window in seen:
                gone[s : s + length] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((i, len(text), spans, bytes(b for b, g in zip(text, gone) if not g)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in plain_repeats(rows)]
    df = QUERIES["op13_repeats"](spark, sf)
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(want, key=str)
    assert any(0 < w[2] < w[1] for w in want)


@pytest.mark.parametrize("seed", range(4))
def test_windows_against_a_dictionary(seed):
    draw = random.Random(seed)
    letters = b"ab" if seed % 2 else bytes(range(256))
    texts = [bytes(draw.choices(letters, k=draw.randrange(60))) for _ in range(30)] + [b"a" * 50, b"ab" * 25, b"", b"\x00" * 20]
    texts += [t[3:20] + t for t in texts[:8]]
    draw.shuffle(texts)
    for length in (2, 5, 12):
        places = np.cumsum([0, *(len(t) for t in texts[:-1])])
        seen, want = {}, set()
        for i, t in enumerate(texts):
            for s in range(len(t) - length + 1):
                if t[s : s + length] in seen:
                    want.add((i, s))
                seen.setdefault(t[s : s + length], 1)
        text, start = repeats.later_windows(texts, places, length)
        assert set(zip(text.tolist(), start.tolist())) == want


def test_equal_windows_meet():
    """Segments take in every window once, and equal windows have equal buckets; places where a segment repeats itself are marked."""
    draw = np.random.default_rng(3)
    parts = [draw.integers(0, 256, 400), np.full(700, 97), np.tile([1, 2, 3], 150), draw.integers(0, 2, 300)]
    texts = [np.concatenate([parts[i] for i in draw.permutation(4)]).astype(np.uint8) for _ in range(6)] + [np.zeros(99, np.uint8), np.zeros(0, np.uint8)]
    offsets = np.cumsum([0, *map(len, texts)])
    for gram in (32, 99):
        found = repeats.cut(np.concatenate(texts), offsets, 100, gram)
        covered, buckets = [], {}
        for text, start, n, bucket, again in zip(found.text, found.start, found.starts, found.bucket, found.again):
            windows = [texts[text][s : s + 100].tobytes() for s in range(start, start + n)]
            covered += [(text, s) for s in range(start, start + n)]
            assert again or len(set(windows)) == n
            assert n <= repeats.SEGMENT_STARTS
            for w in windows:
                assert buckets.setdefault(w, bucket) == bucket
        assert sorted(covered) == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - 99)]


def _texts():
    draw = random.Random(11)
    word = lambda: "".join(draw.choices("abcdefghij é", k=draw.randrange(3, 9)))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, f"{' '.join(word() for _ in range(draw.randrange(40)))} {passage} {' '.join(word() for _ in range(draw.randrange(40)))}") for i in range(60)]
    rows += [(100 + i, passage[:i] + "#" + passage[i:]) for i in range(0, 200, 7)]
    return rows


EDGES = [
    [],
    [(1, None), (2, ""), (2, ""), (None, ""), (3, "x" * 99), (4, "x" * 99), (5, "x" * 100), (6, "x" * 101), (7, "y" * 5000), (8, "z" * 20 + "y" * 5000 + "z")],
    [(5, "same " * 40)] * 3 + [(4, "same " * 40), (None, "same " * 41), (6, "tail " + "same " * 40 + "tail")],
    [(i, "\x00\x01" * (60 + i)) for i in range(5)] + [(9, "日本語" * 300), (8, "日本語" * 301), (8, "本語日" * 20)],
]


@pytest.mark.parametrize("rows", [*EDGES, _texts()], ids=range(5))
def test_edges(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, base string, place int, bucket int")
    assert got(repeats.remove_repeats(docs)) == plain_repeats(rows)


def test_crowded_buckets_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SAMPLE", 1.0)
    monkeypatch.setattr(repeats, "LEAST_CROWD", 1)
    monkeypatch.setattr(repeats, "SHARES", 10**9)
    rows = _texts() + EDGES[1] + EDGES[3]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(repeats.remove_repeats(docs)) == plain_repeats(rows)


def test_long_texts_in_stretches(monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH", 256)
    draw = np.random.default_rng(5)
    texts = [draw.integers(0, 3, n).astype(np.uint8) for n in (3000, 120, 99, 700, 150)]
    offsets = np.cumsum([0, *map(len, texts)])
    found = repeats.cut(np.concatenate(texts), offsets, 100, 32)
    places = sorted((t, s) for t, a, n in zip(found.text, found.start, found.starts) for s in range(a, a + n))
    assert places == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - 99)]


def test_other_lengths(spark):
    rows = _texts()[:25]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = repeats.remove_repeats(docs, length=40, gram=12)
    assert got(made) == plain_repeats(rows, 40)
    assert made.filter(F.size("spans") > 0).count() > 20
