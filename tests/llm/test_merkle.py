import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from pagetables.llm import merkle
from pagetables.llm.queries import QUERIES

_S, _W = "[ \t\n\x0b\f\r]", "[^ \t\n\x0b\f\r]{1,64}+"


def h(text):
    return format(xxhash.xxh64(text.encode(), seed=42).intdigest(), "x")


def plain_leaves(line, opens):
    """Words with the space around them, gathered one by one."""
    pieces = re.findall(f"{_S}*+{_W}{_S}*+|{_S}++", line)
    head, blocks, block = (pieces[:16] if opens else []), [], []
    for word in pieces[len(head):]:
        block.append(word)
        if len(block) == 16 or (len(block) < 16 and re.search(f"[{re.escape(merkle.BLOCK_ENDS)}]{_S}$", word)):
            blocks.append("".join(block))
            block = []
    return [*head, *blocks, *(["".join(block)] if block else [])]


def plain_fingerprint(text):
    """The tree node by node."""
    sections, current = [], []
    for line in re.split(r"(?<=\n)", text):
        if line:
            leaves = ".".join(h(b) for b in plain_leaves(line, not (sections or current)))
            current.append(f"{h(leaves)}:{leaves}")
            if line == "\n" or h(leaves)[0] in "12":
                sections.append(current)
                current = []
    body = ";".join(f"{h(','.join(s))}={','.join(s)}" for s in [*sections, current] if s)
    return hashlib.sha256(body.encode()).hexdigest() + "/" + body


def plain_likeness(a, b):
    if a.split("/")[0] == b.split("/")[0]:
        return 1.0
    x, y = (set(re.findall("[:.]([0-9a-f]+)", f)) for f in (a, b))
    return 2 * len(x & y) / (len(x) + len(y))


def expected(rows):
    """Every row's edited text and both likenesses, by a sort on the whole table."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        k = len(text) // 3
        out[doc] = text[: len(text) - k] + after[:k], after
    return out


def test_query(spark):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    texts, want = dict(rows), expected(rows)
    got = QUERIES["op3_merkle"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        edited, after = want[r.doc_id]
        fp, efp = plain_fingerprint(texts[r.doc_id]), plain_fingerprint(edited)
        assert (r.n_chars, r.edited_sha256) == (len(texts[r.doc_id]), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fp, efp)
        assert r.near_edited == pytest.approx(plain_likeness(fp, efp))
        assert r.near_next == pytest.approx(plain_likeness(fp, plain_fingerprint(after)))
    long = [r for r in got if r.n_chars > 600]
    assert sum(r.near_edited > 0.4 for r in long) > 0.97 * len(long)
    short = [r for r in got if 3 <= len(texts[r.doc_id].split()) <= 50 and texts[r.doc_id] != want[r.doc_id][1]]
    assert len(short) > 20 and all(r.near_edited > r.near_next for r in short)


@pytest.mark.parametrize("rows", [
    [], [(5, "only")], [(5, "a b c"), (-9, "x\ny")], [(i * i * 1000, f"text {i}" * (i % 7)) for i in range(40)],
    [(None, "last"), (3, "three"), (None, None), (3, "three")], [(2**62, "big"), (-(2**62), "small")],
])
def test_next_document(spark, rows, monkeypatch):
    monkeypatch.setattr(merkle, "BUCKET_ROWS", 3)
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, fingerprint string, next_text string")
    got = merkle.edited_with_next(docs).collect()
    assert len(got) == len(rows)
    if rows and all(k is not None for k, _ in rows):
        want = expected([(k, t or "") for k, t in rows])
        assert {r.doc_id: r.edited for r in got} == {k: v[0] for k, v in want.items()}


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_every_character_counts(spark):
    texts = ["", " ", "\n", "\n\n", " \n", "a", "a ", "a\n", "a\n\n", "a b", "a  b", "x" * 500, "x" * 501, "é" * 70, "a\tb"]
    got = [one(spark, merkle.fingerprint(F.lit(t)).alias("f")).f for t in texts]
    assert got == [plain_fingerprint(t) for t in texts]
    assert len(set(got)) == len(texts)


def test_branches_locate_edits(spark):
    lines = [f"line {i} of a text\n" for i in range(200)]
    changed = [*lines]
    changed[17] = "another line\n"
    changed.insert(120, "one more\n")
    a, b = merkle.fingerprint(F.lit("".join(lines))), merkle.fingerprint(F.lit("".join(changed)))
    row = one(spark, merkle.changed_paragraphs(a, b).alias("ab"), merkle.changed_paragraphs(b, a).alias("ba"), merkle.likeness(a, b).alias("near"))
    assert row.ab == [17] and row.ba == [17, 120]
    assert 0.97 < row.near < 1


def test_an_inserted_word_moves_one_block(spark):
    words = [w for i in range(300) for w in (f"word{i}", "and", f"thing{i}", "stop.")]
    a, b = (merkle.fingerprint(F.lit(" ".join(ws))) for ws in (words, [*words[:40], "new", *words[40:]]))
    assert one(spark, merkle.likeness(a, b).alias("near")).near > 0.98


def test_outlying_keys_crowd_no_bucket(spark, monkeypatch):
    """Dense keys beside a far one: bounds follow the keys there are."""
    monkeypatch.setattr(merkle, "BUCKET_ROWS", 50)
    monkeypatch.setattr(merkle, "_CHUNK", 7)
    keys = [*range(2_000), 2**62, -(2**62), None]
    found = merkle.with_next(spark.createDataFrame([(k, f"t{k}") for k in keys], "doc_id long, text string"), "doc_id", ["text"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = found.select("doc_id", "next_text", F.spark_partition_id().alias("part")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    after = [*sorted((k for k in keys if k is not None), reverse=True), None]
    assert {r.doc_id: r.next_text for r in spread} == {k: f"t{n}" for k, n in zip(after, [*after[1:], after[0]])}
    parts = [sum(r.part == p for r in spread) for p in {r.part for r in spread}]
    assert len(parts) > 1 and max(parts) < 1_200


def test_long_text(spark):
    text = "word and word\n" * 100_000 + "z" * 300_000
    got = one(spark, merkle.fingerprint(F.repeat(F.lit("word and word\n"), F.lit(100_000))).alias("a"), merkle.fingerprint(F.lit(text)).alias("b"))
    assert got.b == plain_fingerprint(text) and got.a != got.b


def test_helper_columns_clash_with_none(spark):
    rows = spark.createDataFrame([(i, f"t{i}", 1, 2, 3, 4) for i in range(5)], "doc_id long, text string, bucket int, mix int, place int, guest int")
    got = merkle.with_next(rows, "doc_id", ["text"])
    assert got.columns == [*rows.columns, "next_text"]
    assert {r.doc_id: r.next_text for r in got.collect()} == {0: "t4", 1: "t0", 2: "t1", 3: "t2", 4: "t3"}
