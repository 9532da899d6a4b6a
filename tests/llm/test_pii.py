import hashlib
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagetables.llm import pii
from pagetables.llm.queries import QUERIES

# The contract's patterns as they stand, run by the plain engine.
PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        doubled = [int(d) if i % 2 == 0 else sum(map(int, str(int(d) * 2))) for i, d in enumerate(digits[::-1])]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in p.finditer(text) if passes(k, m.group())]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("0123456789.@+-_% ()abé\n"), max_size=50))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["4041894974608795", "4111-1111-1111-1111", "10.0.0.1", "300.1.2.3.4", "a.b@c-d.ef", "@", ".", " ", "+1 (988) 555-2485", "00", "x", "+", "6011 0009 9013 9424"]), max_size=8).map("".join))
def test_base_spans_of_joined_parts(text):
    assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("unit", ["a", "1", "1.", "@", "a@", "+1", "+1 ", "1 ", "1-", "(at)", ".", "+", "a.b@c"])
def test_time_grows_with_the_text(unit):
    def took(n):
        start = time.process_time()
        pii.base_spans(unit * n)
        pii.windows(unit * n)
        return time.process_time() - start

    assert took(100_000) < 3


@pytest.fixture(scope="module")
def field():
    rng = np.random.default_rng(3)

    def card():
        digits = "4" + "".join(map(str, rng.integers(0, 10, 14)))
        return next(digits + str(d) for d in range(10) if pii.luhn(digits + str(d)))

    texts = []
    for i in range(40):
        a, b, c, d = rng.integers(1, 250, 4)
        texts += [f"jo{i}.{a}@mail{b}.example.com", f"{a}.{b}.{c}.{d}", card(), f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}",
                  f"version {a}.{b}", f"key=a{a}b{b}c", f"{rng.integers(1900, 2100)}.", f"AKIA{a}XYZ{b}", f"n {a}", f"{rng.integers(10**8, 10**12)}"]
    return pii.train(texts)


@pytest.mark.parametrize("text, kind, span", [
    ("write to ann.lee (at) mail3.example.com today", "email", "ann.lee (at) mail3.example.com"),
    ("at 4111.1111.1111.1111 it", "card", "4111.1111.1111.1111"),
    ("call 001 (650) 555-7781 now", "phone", "001 (650) 555-7781"),
])
def test_other_notations_are_added(field, text, kind, span):
    assert (kind, span) in [(k, text[a:b]) for k, a, b, base in pii.all_spans(text, field.decode) if not base]


@pytest.mark.parametrize("text", ["License, Version 2.0.", "CC BY-NC 4.0.", "in 1987 and 2004", "plain words only", "a @ b", "12 345"])
def test_clean_texts_stay_clean(field, text):
    assert pii.all_spans(text, field.decode) == []


def test_gradient_is_that_of_the_likelihood(field):
    """Numerically, with brute-force enumeration of the segmentations as the partition sum."""
    text, gold = "a@b 1", [(0, 0, 4), (1, 0, 4), (2, 0, 4), (3, 0, 4), (4, 0, 1)]
    rng = np.random.default_rng(0)
    model = pii.Field(rng.normal(size=field.weights.shape) * 0.3, rng.normal(size=field.links.shape) * 0.3)
    spans, rows = pii.Field.spans_and_rows(text)
    ends = list(rows)

    def paths(j):
        if j == len(ends):
            yield []
            return
        for end in range(j, len(ends)):
            for label in range(5):
                if label < 4 or end == j:
                    for rest in paths(end + 1):
                        yield [(end, end - j, label), *rest]

    def score(path):
        total, last = 0.0, 4
        for j, k, y in path:
            total += model.weights[y] @ ends[j][k] + model.links[last, y]
            last = y
        return total

    every = list(paths(0))

    def likelihood():
        return score(gold) - np.log(np.sum(np.exp([score(p) for p in every])))

    d_weights, d_links = model.gradient(ends, gold)
    before = likelihood()
    for parameter, grad, at in ((model.weights, d_weights, (1, 0)), (model.weights, d_weights, (4, 22)), (model.links, d_links, (4, 1)), (model.links, d_links, (2, 2))):
        parameter[at] += 1e-5
        assert (likelihood() - before) / 1e-5 == pytest.approx(grad[at], abs=1e-3)
        parameter[at] -= 1e-5
    best = max(every, key=score)
    want = [(pii.KINDS[y], spans[j - k][0], spans[j][1]) for j, k, y in best if y < 4]
    assert model.decode(text) == want


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op10_pii"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = plain_spans(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in want) for kind in pii.KINDS)
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
    added = sum(len(r.spans.split(",")) - (r.n_email + r.n_ip + r.n_card + r.n_phone) for r in rows if r.spans)
    assert added < 30


def test_edges(spark):
    schema = "doc_id long, text string, spans string, kind int"
    docs = spark.createDataFrame([(1, None, "x", 1), (2, "", "y", 2), (3, "a@b.cd " * 30_000, None, None), (3, "a@b.cd", "", 0), (3, "a@b.cd", "", 0)], schema)
    model = pii.fit(docs)
    got = docs.select("text", pii.finder(docs, model)("text").alias("found"), pii.redactor(docs, model)("text").alias("clean")).collect()
    assert [len(r.found) for r in got] == [0, 0, 30_000, 1, 1]
    assert [r.clean and r.clean[:9] for r in got] == [None, "", "[EMAIL] [", "[EMAIL]", "[EMAIL]"]
    empty = docs.filter("doc_id = 99")
    assert pii.fit(empty) is None
    assert empty.select(pii.finder(empty, None)("text")).count() == 0
    assert docs.select(pii.finder(docs, None)("text").alias("s")).filter("size(s) > 0").count() == 3


def test_long_number_table(field):
    text = "12 345 6 " * 1000
    spans = sorted((a, b) for _, a, b, _ in pii.all_spans(text, field.decode))
    assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_free_stretches():
    assert list(pii._free([(0, 10), (12, 20), (30, 40)], [(2, 4), (8, 14), (35, 50)])) == [(0, 2), (4, 8), (14, 20), (30, 35)]


def test_redacting_goes_on_until_nothing_is_left(field):
    text = "call +1 (605) 555-9305 4078918989542222 today"
    assert pii.base_spans(text) == []
    clean = pii.redacted_fully(text, lambda t, *_: [("phone", t.index("+"), t.index(" 4078"))] if "+" in t else [])
    assert clean == "call [PHONE] [CARD] today"
    assert pii.all_spans(pii.redacted_fully(text, field.decode), field.decode) == []


def test_redacting_overlaps():
    assert pii.redacted("0123456789", [("card", 2, 5), ("phone", 1, 5), ("ip", 7, 8)]) == "0[PHONE]56[IP]89"
