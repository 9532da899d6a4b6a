import hashlib
import zlib

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from pagetables.llm import manifest
from pagetables.llm.positions import with_starts
from pagetables.llm.queries import QUERIES
from pagetables.llm.sql import ORACLE

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return h(*map(field, (*row[:4], text)))


def plain_tree(digests):
    """Every leaf's (left, right) siblings a level, and the top."""
    ways, place = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, at in enumerate(place):
            run = at // 3 * 3
            ways[i].append((digests[run:at], digests[at + 1 : run + 3]))
            place[i] = at // 3
        digests = [h(*digests[i : i + 3]) for i in range(0, len(digests), 3)]
    return ways, digests[0] if digests else None


def plain_manifest(rows):
    by_source, out = {}, []
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        held = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r, r[4])))
        trees[s] = held, *plain_tree([plain_leaf(r, r[4]) for r in held])
    upper, root = plain_tree([trees[s][2] for s in sources])
    for s, over in zip(sources, upper):
        held, ways, top = trees[s]
        for row, way in zip(held, ways):
            text = row[4]
            if text is not None and zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 2 == 0:
                text = text.replace("\n", "")
            digest = plain_leaf(row, text)
            for left, right in way + over:
                digest = h(*left, digest, *right)
            proof = h(*(d for left, right in way + over for d in left + right))
            out.append((row[0], plain_leaf(row, row[4]), top, root, proof, digest, digest == root))
    return sorted(out, key=str)


def got(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in manifest.verify(df).select(names).collect()), key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(QUERIES["op12_manifest"](spark, sf), duck(sf), ORACLE["op12_manifest"]) == []


@pytest.mark.parametrize("each", [1, 2, 6])
def test_bands(spark, each):
    """A hot source, sources of one row, a null one; with few levels a band, ways go through many bands."""
    rows = [(i, "hot" if i % 3 else f"s{i % 11}", "xx", i, f"text\n{i}") for i in range(900)]
    rows += [(5_000 + i, f"lone{i}", None, None, None) for i in range(7)] + [(9_000 + i, None, "é", 1, "\n") for i in range(4)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert got(manifest.manifest(docs, each=each)) == plain_manifest(rows)


@pytest.mark.parametrize("rows", [
    [],
    [(1, "a", "b", 2, "only one\n")],
    [(None, None, None, None, None), (None, None, None, None, None), (None, "", "", 0, "")],
    [(7, "s", "l", 1, "same\n")] * 10 + [(7, "s", "l", 1, "other\n")] * 2 + [(8, "ß", "l", 1, "日" * 500_000), (-3, "Z", "l", 1, "\n\r\n")],
    [(-5, "a", None, 1, "12:x"), (10, "a", "1", None, "-"), (9, "=a", "", 1, "")],
])
def test_edges(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", branch string, lo int")
    assert got(manifest.manifest(docs, each=1)) == plain_manifest(rows)


def test_a_changed_leaf_is_not_verified(spark):
    rows = [(i, "s", "l", 1, f"a\n{i}") for i in range(40)]
    made = manifest.manifest(spark.createDataFrame(rows, SCHEMA))
    changed = manifest.verify(made.withColumn("tampered", F.when(F.col("doc_id") == 3, F.sha2(F.lit("x").cast("binary"), 256))))
    assert [r.doc_id for r in changed.filter("not verified").collect()] == [3]


def test_starts(spark):
    """Places by ranges: groups that cross ranges, equal rows, nulls."""
    rows = [("g" if i % 4 else f"h{i % 5}", None if i % 17 == 0 else i % 23, i % 7, i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "g string, k int, w long, i int").repartition(5)
    seen = with_starts(df, ["k", "i"], "w", "g").collect()
    sums = {}
    for g, k, w, i in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[3])):
        sums[i] = sums.get(("at", g), 0)
        sums["at", g] = sums[i] + w
    assert len(seen) == len(rows)
    assert all((r.start, r.total) == (sums[r.i], sums["at", r.g]) for r in seen)
    whole = with_starts(df, ["i"], "w").collect()
    assert sorted((r.i, r.start) for r in whole) == [(i, sum(r[2] for r in rows[:i])) for i in range(3_000)]
