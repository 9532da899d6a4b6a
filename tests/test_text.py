"""Text and date functions against plain Python."""

import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from pagetables.functions import dates, text
from pagetables.sources.rules import load_rules

SPACES = [chr(c) for c in range(0x10000) if chr(c).isspace()]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def run(spark, values, expression, kind="string"):
    return [r.y for r in column(spark, values, kind).select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def spaced_texts():
    rng = random.Random(5)
    letters = ["a", "bc", "é", "日本", "​", "\x00x", "!", "᠎", "﻿"]
    return ["".join(rng.choice(SPACES + letters * 3) for _ in range(rng.randint(0, 30))) for _ in range(400)]


def test_space_characters_are_pythons():
    assert sorted(text.SPACE_CHARS) == sorted(SPACES)


def test_strip_and_words(spark):
    values = spaced_texts() + SPACES + ["", "a" + "\xa0" * 3 + "b"]
    assert run(spark, values, text.strip) == [v.strip() for v in values]
    assert run(spark, values, text.word_count) == [len(v.split()) for v in values]
    assert run(spark, values, text.blank_to_null) == [v.strip() or None for v in values]


@pytest.mark.parametrize("words", [1, 99, 100, 101, 299, 300, 301, 499, 500, 501, 700, 900])
def test_read_time_rounds_half_to_even(spark, words):
    assert run(spark, ["w " * words], text.read_time) == [max(1, round(words / 200))]


def test_read_time_needs_content(spark):
    assert run(spark, ["", None, "x"], text.read_time) == [None, None, 1]


def test_remove_tags(spark):
    values = ["<b>x</b> y", "a < b", "1 <2> 3", "</p>z<br/>", "<a\nhref='>'>t", "no tags", None]
    assert run(spark, values, text.remove_tags) == ["x y", "a < b", "1  3", "z", "'>t", "no tags", None]


def clean(spark, blocks, phrases=("sail loft", "%%"), markers=("~end~",)):
    return run(spark, [blocks], lambda c: text.clean_content(c, phrases, markers), "array<string>")[0]


def test_lines_with_a_phrase_go_wherever_it_stands():
    for place in range(3):
        blocks = ["keel", "mast", "boom"]
        blocks[place] += " near the sail loft door"
        assert clean_model(blocks, ("sail loft",), ()) == "\n".join(b for b in ("keel", "mast", "boom") if b != blocks[place].split()[0])


@pytest.mark.parametrize("blocks", [
    [], ["a%%"], ["ab", "abc", "abcd"], ["tide 1\ntide 2 %%", "~end~", "tide 3"], ["\u2003\u2003", "\v\f", "rope"], ["~end~"],
    ["in\xa0two\xa0parts \xa0", "\xa0\xa0x"], ["sail", "loft"], ["left of~end~right", "sail loft"],
])
def test_clean_content_equals_the_model(spark, blocks):
    assert clean(spark, blocks) == clean_model(blocks, ("sail loft", "%%"), ("~end~",))


def test_no_blocks(spark):
    assert clean(spark, None) == ""


def test_thousands_of_phrases_and_markers(spark):
    phrases = [f"phrase-{i};" for i in range(5000)]
    markers = [f"[mark {i}]" for i in range(1200)]
    blocks = ["kept line", "with phrase-4999; inside", "phrase-12", "before [mark 700] after", "lost"]
    assert clean(spark, blocks, phrases, markers) == "kept line\nphrase-12\nbefore"


@pytest.mark.parametrize("unit, n", [("<", 200_000), ("<a", 100_000), ("</", 100_000), ("<b>", 100_000), ("< ", 100_000), (">", 200_000)])
def test_tag_removal_is_linear(spark, unit, n):
    start = time.perf_counter()
    value = run(spark, [unit * n + "x", "<" + "a" * 300_000 + ">y<z"], text.remove_tags)
    assert time.perf_counter() - start < 20
    assert value[1] == "y<z"


def test_markers_apply_in_order(spark):
    assert clean(spark, ["one AB two B three"], (), ("B", "A")) == "one"
    assert clean(spark, ["one AB two"], (), ("AB", "B")) == "one"


def clean_model(blocks, phrases, markers):
    body = "\n".join(blocks).replace("\xa0", " ")
    for marker in markers:
        body = body.partition(marker)[0]
    kept = [line for line in body.split("\n") if len(line.strip()) >= 3 and not any(p in line for p in phrases)]
    return "\n".join(kept).strip()


def test_clean_content_model(spark):
    rng = random.Random(11)
    pieces = ["ab", "xyz", "\xa0", " ", "\n", "SPAM", "STOP", "é", " ", "\x1c"]
    lists = [["".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 5))] for _ in range(300)]
    got = run(spark, lists, lambda c: text.clean_content(c, ("SPAM",), ("STOP", "xyzab")), "array<string>")
    assert got == [clean_model(b, ("SPAM",), ("STOP", "xyzab")) for b in lists]


def test_tags(spark):
    values = ["a, b,,a", "", " , x", None, "one"]
    assert run(spark, values, lambda c: text.split_tags(c)) == [["a", "b", "a"], [], ["x"], None, ["one"]]
    assert run(spark, values, lambda c: text.split_tags(c, True)) == [["a", "b", "", "a"], [""], ["", "x"], None, ["one"]]


def test_title_prefix(spark):
    assert run(spark, ["x" * 70, None, "é" * 60], lambda c: text.title_prefix(c, 60)) == ["x" * 60 + "...", "N/A...", "é" * 60 + "..."]


AS_OF = dt.date(2026, 3, 2)


def recent_model(value, limit=3):
    if not value:
        return False
    value = value.split("T")[0] if "T" in value else value[:10]
    try:
        day = dt.datetime.strptime(value, "%Y-%m-%d").date()
    except ValueError:
        return False
    return 0 <= (AS_OF - day).days <= limit


def test_recency(spark):
    days = [(AS_OF + dt.timedelta(days=d)).isoformat() for d in range(-6, 3)]
    values = days + [d + "T12:00:00+01:00" for d in days] + [d + " 10:00" for d in days] + [
        "not-a-date", None, "", " 2026-03-01", "2026-3-1", "2026-3-01T08", "2026-02-30", "2026-02-29", "2026-03-01x", "26-03-01",
        "T2026-03-01", "2026-03-01\n", "2026-03-011", "2026-13-01", "0000-01-01", "Thursday 2026-03-01", "2026-03- 1", "2026-03-1T",
    ]
    assert run(spark, values, lambda c: dates.is_recent(c, AS_OF, 3)) == [recent_model(v) for v in values]


def test_recency_against_a_column(spark):
    df = spark.createDataFrame([("2026-03-01", "2026-03-04"), ("2026-03-01", "2026-03-05")], "x string, day string")
    got = df.select(dates.is_recent(F.col("x"), F.col("day").cast("date"), 3).alias("r")).collect()
    assert [r.r for r in got] == [True, False]


def test_date_part(spark):
    values = ["2026-01-02T10", "2026-01-02 10:00", "Today", "", None, "xTyTz", "short"]
    assert run(spark, values, dates.date_part_text) == ["2026-01-02", "2026-01-02", "", "", None, "x", "short"]


def test_run_stamp(spark):
    df = spark.sql("SELECT TIMESTAMP '2026-05-20 12:00:00' AS ts")
    assert df.select(dates.run_stamp(F.col("ts"))).first()[0] == "2026-05-20_12-00-00"


PHRASES_ALIKE = ["a", "ab", "abc.d", "b*", "(x", "[y]", "zażółć", "z a", "\\E", "|", "$^", "żx", "日本", "😀b", "line\tend"]


@pytest.mark.parametrize("phrases", [PHRASES_ALIKE, PHRASES_ALIKE[3:], ["long common start one", "long common start two", "long common start"] + [f"p{i}" for i in range(20)]])
def test_phrase_tree_equals_containment(spark, phrases):
    draw = random.Random(2)
    pieces = [*phrases, *"bcdxyz .*()[]|$^\\", "zaż", "long common", "日", "😀", "p1"]
    lines = ["".join(draw.choices(pieces, k=draw.randrange(4))) for _ in range(300)] + ["", "bcd", "p", "long common star"]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    got = df.select("line", text.has_any_phrase(F.col("line"), phrases).alias("found")).collect()
    assert len(phrases) > text.FEW_PHRASES
    assert [r.found for r in got] == [any(p in r.line for p in phrases) for r in got]


def test_fifty_thousand_phrases_cost_no_more_than_the_text(spark, tmp_path):
    draw = random.Random(8)
    phrases = sorted({"".join(draw.choices("abcdefghijklmnop qrst", k=draw.randrange(8, 30))) for _ in range(50_000)})
    (tmp_path / "rules.json").write_text(json.dumps({"scam_phrases": phrases}), encoding="utf-8")
    rules = load_rules(spark, str(tmp_path / "rules.json"))
    assert len(rules.scam_phrases) == len(phrases)
    lines = [f"word {i} " * 30 + (phrases[i * 7] if i % 5 == 0 else "") for i in range(4_000)]
    df = spark.createDataFrame([(line,) for line in lines], "line string").repartition(4)
    begin = time.time()
    assert df.filter(text.has_any_phrase(F.col("line"), rules.scam_phrases)).count() == 800
    assert time.time() - begin < 60  # 200 million containment tests would take far longer


def test_words_between_single_blanks_are_not_searched(spark):
    """As str.split() counts them, whatever stands between them; a search for each word is left to texts with other spaces."""
    odd = ["", " ", "\n", "a", " a", "a ", "a b", "a  b", " a\nb ", "a\n\nb", "é ü\nß", "”x“ – y", "　", None]
    odd += [f"x{c}y{c}" for c in text.SPACE_CHARS] + [f"é{c}y {c}z" for c in text.SPACE_CHARS + "᠎​ᚁ﻿"]
    rows = spark.createDataFrame(list(enumerate(odd)), "i int, t string").select("i", text.word_count(F.col("t")).alias("n"))
    assert {r.i: r.n for r in rows.collect()} == {i: None if t is None else len(t.split()) for i, t in enumerate(odd)}
    assert "octet_length" in rows._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_is_long_enough_by_its_first_characters(spark):
    parts = ["", "a", "ab", "é", "😀", *text.SPACE_CHARS]
    lines = [a + b + c for a in parts for b in parts for c in ("", "x", " ", "\x1c", "\xa0")]
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, t string").select("i", F.col("t").rlike(text.LONG_LINE_PATTERN).alias("long"))
    assert {r.i: r.long for r in rows.collect()} == {i: len(t.strip()) >= text.MIN_LINE_CHARS for i, t in enumerate(lines)}
