import random
import re

import numpy as np
import pytest
from compare import compare, duck

from pagetables.llm import setjoin
from pagetables.llm.queries import QUERIES
from pagetables.llm.sql import ORACLE


def plain_set(text, k=3):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def plain_components(rows, percent=90, k=3):
    """Sizes and components over all pairs of rows."""
    sets = [plain_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_size = sorted(range(len(rows)), key=lambda i: len(sets[i]))
    for n, i in enumerate(by_size):
        for j in by_size[n + 1 :]:
            if len(sets[i]) * 100 < percent * len(sets[j]):
                break
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), doc), doc)
    return {doc: (len(sets[i]), low[find(i)]) for i, (doc, _) in enumerate(rows)}


def joined(spark, docs, folder, **options):
    members, _ = setjoin.join_sets(docs, str(folder), **options)
    return setjoin.smallest_ids(members).collect()


def near_copies(rng, words, n, length, edits):
    base = [rng.choice(words) for _ in range(length)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_all_sizes_against_brute_force(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(setjoin, "BLOCK", 7)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for length in [3, 8, 11, 12, 13, 14, 17, 20, 21, 22, 24, 30, 33, 45, 70, 120, 200]:
        texts += near_copies(rng, words, 14, length, max(1, length // 25))
        texts += [texts[-1] + " tail", "head " + texts[-2], texts[-3]]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(n)) for n in (5, 5, 6, 60, 60, 200)]
    rows = list(enumerate(texts, 100))
    rng.shuffle(rows)
    got = joined(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), tmp_path)
    assert {r.doc_id: (r.size, r.component_id) for r in got} == plain_components(rows)


def test_light_and_heavy_find_the_same(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = list(enumerate(t for length in range(9, 26) for t in near_copies(rng, words, 8, length, 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_components(rows)
    for boundary in (0, 15, 30):
        monkeypatch.setattr(setjoin, "choose_boundary", lambda *_: boundary)
        got = joined(spark, docs, tmp_path / str(boundary))
        assert {r.doc_id: (r.size, r.component_id) for r in got} == want


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op7_set_join"](spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(rows)
    assert len(got) == len(rows)


def test_query_against_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert compare(QUERIES["op7_set_join"](spark, sf_dir), duck(sf_dir), ORACLE["op7_set_join"]) == []


def test_edges(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(40_000))
    rows = [(1, None, "x", 1), (2, "", "y", 2), (3, " \t\n", None, None), (4, "One two", "x", 0), (5, "one TWO", "x", 0), (6, "one", "x", 0),
            (7, long, "x", 0), (8, long + " more", "x", 0), (None, "one two", "x", 0), (9, "É x y", "x", 0), (10, "é x y", "x", 0), (4, "One two", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string, class int")
    got = joined(spark, docs, tmp_path / "a")
    assert len(got) == len(rows)
    component = {r.doc_id: r.component_id for r in got}
    assert component == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, None: 4, 9: 9, 10: 10}
    assert {r.doc_id: r.size for r in got}[7] == 39_998
    assert joined(spark, docs.filter("doc_id = 99"), tmp_path / "b") == []


def test_needed_overlap_and_partners():
    for percent in (80, 90):
        for s in range(1, 80):
            for t in range(1, 80):
                o = setjoin.needed(s, t, percent)
                assert 100 * o >= percent * (s + t - o) and (o == 0 or 100 * (o - 1) < percent * (s + t - o + 1))
                possible = 100 * min(s, t) >= percent * max(s, t)
                assert (t in setjoin.partner_sizes(s, percent)) == possible
                ranges = setjoin.Ranges(percent, 200)
                if possible and s <= t:
                    i = ranges.of(t)
                    assert i in ranges.listed(s) and s + t - 2 * o <= ranges.differences(i)


def test_parts_sum_like_python():
    rng = np.random.default_rng(1)
    values, cell = rng.integers(0, 2**64, 1000, dtype=np.uint64), rng.integers(0, 7, 1000)
    want = [sum(int(v) for v in values[cell == c]) % 2**64 for c in range(7)]
    assert setjoin.sums_by(cell, values, 7).tolist() == want


def test_components_of_a_path(spark, tmp_path):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in setjoin.components(edges, str(tmp_path)).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def plain_links(rows, percent=90, k=3):
    """For every row, with how many different sets its set links."""
    sets = {doc: frozenset(plain_set(t, k)) for doc, t in rows}
    different = {s for s in sets.values() if s}
    n = {s: sum(100 * len(s & t) >= percent * len(s | t) for t in different if t != s) for s in different}
    return {doc: n.get(s, 0) for doc, s in sets.items()}


@pytest.mark.parametrize("block", [5, 2048])
def test_number_of_links(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(setjoin, "LINK_BLOCK", block)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = [t for length in (4, 12, 40, 120) for t in near_copies(rng, words, 12, length, max(1, length // 40))]
    base = [rng.choice(words) for _ in range(150)]
    texts += [" ".join(base[:n]) for n in range(60, 150, 3)]  # one component over several size ranges
    rows = list(enumerate([*texts, *texts[:5], "", None]))
    members, _ = setjoin.join_sets(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), str(tmp_path))
    got = {r.doc_id: r.n_links for r in members.collect()}
    assert got == plain_links(rows)
    assert max(got.values()) > 2


@pytest.mark.parametrize("percent", range(50, 100, 5))
def test_partners_share_a_range(percent):
    ranges = setjoin.Ranges(percent, 800)
    for t in range(1, 401):
        for s in range(-(-t * percent // 100), t + 1):
            i = ranges.of(t)
            assert i in ranges.listed(s) and s + t - 2 * setjoin.needed(s, t, percent) <= ranges.differences(i)


@pytest.mark.parametrize("percent", [50, 80, 90])
@pytest.mark.parametrize("split", [0, 13])
def test_sketches_lose_no_link(percent, split):
    rng = np.random.default_rng(percent + split)
    base = [rng.integers(0, 2**63, 40 + 25 * i).astype(np.uint64) for i in range(4)]
    sets = [np.unique(np.concatenate([b[int(len(b) * rng.random() * 0.15) :], rng.integers(0, 2**63, rng.integers(0, 5)).astype(np.uint64)])) for b in base * 8]
    sets += [np.arange(n, dtype=np.uint64) for n in (1, 2, 3)]
    groups = rng.integers(0, 6, len(sets))
    sizes = np.array([len(x) for x in sets])
    parts = setjoin.near_parts([setjoin.sketch(x) for x in sets], sizes, groups, percent, split)
    top = split or len(sets)
    linked = 0
    for i in range(top):
        for j in range(split, len(sets)):
            common = len(np.intersect1d(sets[i], sets[j]))
            if groups[i] != groups[j] and 100 * common >= percent * (sizes[i] + sizes[j] - common):
                linked += 1
                assert parts[i] == parts[j] >= 0
    assert linked > 10


def test_folding_a_sketch_keeps_its_bound():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 500).astype(np.uint64)
    b = np.concatenate([a[20:], rng.integers(0, 2**63, 15).astype(np.uint64)])
    for size in (128, 64, 8):
        assert np.unpackbits(setjoin.folded(setjoin.sketch(a), size) ^ setjoin.folded(setjoin.sketch(b), size)).sum() <= 35


@pytest.mark.parametrize("percent", [80, 90])
def test_near_sketches_lose_no_pair(percent):
    rng = np.random.default_rng(percent)
    for size in (1, 5, 40, 300, 3000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for gone in range(0, max(1, size // 8), max(1, size // 40)):
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, gone // 2).astype(np.uint64)]))
            common = len(np.intersect1d(a, b))
            if 100 * common >= percent * (len(a) + len(b) - common):
                assert setjoin.sketches_near(setjoin.sketch(a), setjoin.sketch(b), len(a), len(b), percent)


def test_sets_of_far_candidates_do_not_move_and_work_tables_go(spark, tmp_path, monkeypatch):
    """Texts with a common passage meet in lists; only those that may link are checked by whole sets."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(words) for _ in range(120))
    texts = [passage + " " + " ".join(rng.choice(words) for _ in range(110)) for _ in range(30)]
    texts += [texts[0] + " more", texts[0]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.size, r.component_id) for r in joined(spark, docs, tmp_path / "gone")}
    assert got == plain_components(rows)
    assert sorted(p.name for p in (tmp_path / "gone").iterdir() if p.name != "n_links") == ["components2", "digests", "links1", "links2"]
    monkeypatch.setattr(setjoin, "delete_folder", lambda *_: None)
    joined(spark, docs, tmp_path / "kept")
    work = tmp_path / "kept" / "work"
    assert spark.read.parquet(str(work / "postings")).select("class").distinct().count() > 2
    assert spark.read.parquet(str(work / "first_pairs")).count() == 1
    assert spark.read.parquet(str(work / "first_sets")).count() == 2


def test_copies_are_listed_once_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(setjoin, "SEEN_CLASSES", 2)
    texts = [f"a{i % 3} b c d e f g h i j k l m n o p q r s t u v w x y z" for i in range(60)] + ["", None, " "]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert {r.doc_id: (r.size, r.component_id) for r in joined(spark, docs, tmp_path)} == plain_components(rows)
