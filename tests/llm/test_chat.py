from compare import compare, duck

from pagetables.llm import chat
from pagetables.llm.queries import QUERIES
from pagetables.llm.sql import ORACLE

SF_DIR = "/root/testdata/sf0.001"


def test_query(spark):
    assert compare(QUERIES["op9_chat_format"](spark, SF_DIR), duck(SF_DIR), ORACLE["op9_chat_format"]) == []


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


SCHEMA = f"conv_id long, turn long, role string, parts array<{chat.PART_TYPE}>, formatted string"


def formatted(spark, rows):
    return chat.format_conversations(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA))


def test_parts_become_ordered_placeholders(spark):
    rows = [
        (1, 1, "assistant", [part("text", "A <b> & \\s"), part("audio", ref="a.wav", seconds=2.5)]),
        (1, 0, "user", [part("image", ref="x.png", width=28, height=15), part("text", "what"), part("document", ref="d.pdf", pages=2), part("image", ref="y.png")]),
    ]
    got = formatted(spark, rows).first()
    assert got.formatted == "<turn:user><image:1>what<document:2><image:3></turn>\n<turn:assistant>A \\lb\\g & \\ss<audio:4></turn>\n"
    assert [(a.number, a.turn, a.kind, a.ref, a.tokens) for a in got.attachments] == [
        (1, 0, "image", "x.png", 4), (2, 0, "document", "d.pdf", 512), (3, 0, "image", "y.png", 1), (4, 1, "audio", "a.wav", 63)]
    for a in got.attachments:
        mark = f"<{a.kind}:{a.number}>"
        assert got.formatted[a.start : a.start + len(mark)] == mark
    assert got.expanded_tokens == 4 + 512 + 1 + 63
    (span,) = got.loss_spans
    assert got.formatted[span.start : span.stop] == "A \\lb\\g & \\ss<audio:4>"


def test_reading_back(spark):
    texts = ["é\\l<g>", "", None, "</turn>\n<turn:user>", "\\\\s\\g😀"]
    rows = [(5, i, "assistant" if i % 2 else "us<er>", [part("text", t)]) for i, t in enumerate(texts)]
    df = formatted(spark, rows)
    got = df.select(chat.read_turns(df.formatted).alias("turns"), chat.read_loss_texts(df.formatted, df.loss_spans).alias("loss")).first()
    assert [(t.role, t.text) for t in got.turns] == [(r[2], r[3][0][1] or "") for r in rows]
    assert got.loss == ["", "</turn>\n<turn:user>"]


def test_nulls_ties_repeats_and_empty(spark):
    rows = [
        (None, None, None, None), (2, 0, "user", [part("text", "b")]), (2, 0, "user", [part("text", "a")]),
        (2, 0, "user", [part("text", "a")]), (3, 0, "user", [part("video", ref="v"), part(None, "x"), None]),
    ]
    got = {r.conv_id: r for r in formatted(spark, rows).collect()}
    assert got[None].formatted == "<turn:></turn>\n" and got[None].loss_spans == [] and got[None].attachments == []
    assert got[2].formatted == "<turn:user>a</turn>\n" * 2 + "<turn:user>b</turn>\n"
    assert got[3].formatted == "<turn:user></turn>\n"
    assert formatted(spark, rows).filter("conv_id = 99").count() == 0


def test_long_text(spark):
    text = "x<é" * 200_000
    df = formatted(spark, [(1, 0, "assistant", [part("text", text)])])
    got = df.select(chat.read_loss_texts(df.formatted, df.loss_spans).alias("loss")).first()
    assert got.loss == [text]
