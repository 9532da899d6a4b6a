"""Conversations of typed content parts to training text, with a loss mask that can be read back.

Template: a turn is `<turn:ROLE>`, its parts in order, `</turn>` and a newline. "<" stands in markers only: in texts and
roles `\\` becomes `\\s`, `<` becomes `\\l`, and `>` becomes `\\g`, which is undone in the opposite order. A part that is no
text becomes a placeholder such as `<image:1>`, numbered through the conversation; `attachments` records what it refers
to, how many model tokens it expands to, and where in the text it stands.

Defined results: null texts are empty, a null role is the empty role, unknown or null part types and null parts are
skipped, a conversation without rows does not exist. Rows of equal turn are ordered by role and content; repeated rows
stay. A null conv_id is a conversation. Only the columns named below are read. One conversation makes one row; its
length is bounded by what a string can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLOSE = "</turn>\n"

PART_TYPE = (
    "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)


def escape(text: Column) -> Column:
    for char, code in (("\\", "\\s"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for char, code in ((">", "\\g"), ("<", "\\l"), ("\\", "\\s")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def text_part(text: Column) -> Column:
    """One text as an array of content parts."""
    return F.array(F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    ))


def _expanded_tokens(part: Column, patch: int, audio_rate: int, page_tokens: int) -> Column:
    """Tokens that a placeholder stands for: image patches, audio frames, pages. Unknown sizes count as one unit."""
    patches = F.ceil(F.coalesce(part["width"], F.lit(1)) / patch) * F.ceil(F.coalesce(part["height"], F.lit(1)) / patch)
    frames = F.greatest(F.lit(1), F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * audio_rate))
    pages = F.coalesce(part["pages"], F.lit(1)) * page_tokens
    return F.when(part["type"] == "image", patches).when(part["type"] == "audio", frames).when(part["type"] == "document", pages).cast("long")


def visit_parts(parts: Column, patch: int = 14, audio_rate: int = 25, page_tokens: int = 256) -> Column:
    """Flatten a turn's parts in order: array of (kind, text, ref, tokens), text escaped, other kinds without text."""
    known = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART_TYPE}>")), lambda p: p["type"].isin("text", "image", "audio", "document"))
    return F.transform(known, lambda p: F.struct(
        p["type"].alias("kind"),
        F.when(p["type"] == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.lit("")).alias("text"),
        p["ref"].alias("ref"),
        F.coalesce(_expanded_tokens(p, patch, audio_rate, page_tokens), F.lit(0).cast("long")).alias("tokens"),
    ))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
                         loss_role: str = "assistant", **sizes: int) -> DataFrame:
    """One row per conversation: formatted text, loss spans, attachments, expanded token count.

    `loss_spans` holds (start, stop) in code points and (byte_start, byte_stop) in UTF-8, stop exclusive, one span per turn
    of `loss_role`, in order; it covers the turn's body without its markers. All of it is native; the rows of a
    conversation meet in one exchange by its id, and offsets are running sums in the same partitioning.
    """
    visited = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        visit_parts(F.col(parts), **sizes).alias("parts"),
    )
    in_order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "parts")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)

    def attached(p: Column) -> Column:
        return p["kind"] != "text"

    def placeholder(p: Column, number: Column) -> Column:
        return F.concat(F.lit("<"), p["kind"], F.lit(":"), number.cast("string"), F.lit(">"))

    numbered = (
        visited.withColumn("n_attached", F.size(F.filter("parts", attached)).cast("long"))
        .withColumn("first_number", F.coalesce(F.sum("n_attached").over(before), F.lit(0)))
        .withColumn("place", F.row_number().over(in_order))
    )
    # Number the attachments inside the turn; texts take the number of the next attachment, which is not shown.
    pieces = F.transform("parts", lambda p, i: F.when(attached(p), placeholder(
        p, F.col("first_number") + F.size(F.filter(F.slice("parts", 1, i + 1), attached)))).otherwise(p["text"]))
    opening = F.concat(F.lit("<turn:"), escape(F.col("role")), F.lit(">"))
    rendered = (
        numbered.withColumn("pieces", F.when(F.col("n_attached") == 0, F.transform("parts", lambda p: p["text"])).otherwise(pieces))
        .withColumn("body", F.array_join("pieces", ""))
        .withColumn("opening", opening)
        .withColumn("chars", F.char_length("opening") + F.char_length("body") + len(CLOSE))
        .withColumn("bytes", F.octet_length("opening") + F.octet_length("body") + len(CLOSE))
        .withColumn("char_at", F.coalesce(F.sum(F.col("chars").cast("long")).over(before), F.lit(0)) + F.char_length("opening"))
        .withColumn("byte_at", F.coalesce(F.sum(F.col("bytes").cast("long")).over(before), F.lit(0)) + F.octet_length("opening"))
    )
    span = F.when(F.col("role") == loss_role, F.struct(
        F.col("char_at").alias("start"), (F.col("char_at") + F.char_length("body")).alias("stop"),
        F.col("byte_at").alias("byte_start"), (F.col("byte_at") + F.octet_length("body")).alias("byte_stop"),
    ))
    attachments = F.filter(F.transform("parts", lambda p, i: F.when(attached(p), F.struct(
        (F.col("first_number") + F.size(F.filter(F.slice("parts", 1, i + 1), attached))).alias("number"),
        F.col("turn").alias("turn"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"),
        (F.col("char_at") + F.char_length(F.array_join(F.slice("pieces", 1, i), ""))).alias("start"),
    ))), lambda a: a.isNotNull())
    rows = rendered.select(
        "conv_id", "place", F.concat("opening", "body", F.lit(CLOSE)).alias("piece"), span.alias("span"),
        F.when(F.col("n_attached") > 0, attachments).alias("attachments"), F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("tokens"),
    )
    gathered = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "piece", "span", "attachments"))).alias("rows"), F.sum("tokens").alias("expanded_tokens"))
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten(F.filter(F.transform("rows", lambda r: r["attachments"]), lambda a: a.isNotNull())).alias("attachments"),
        "expanded_tokens",
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text), texts unescaped, placeholders as they stand."""
    chunks = F.filter(F.split(formatted, CLOSE), lambda c: c != "")
    return F.transform(F.transform(chunks, lambda c: F.split(c, ">", 2)), lambda c: F.struct(
        unescape(F.substring(c[0], len("<turn:") + 1, 2**31 - 1)).alias("role"), unescape(c[1]).alias("text")))


def read_loss_texts(formatted: Column, loss_spans: Column) -> Column:
    """The unescaped texts under the loss mask. Cut by bytes, so that the work grows with the text, not with its square."""
    whole = formatted.cast("binary")
    return F.transform(loss_spans, lambda s: unescape(
        F.substring(whole, (s["byte_start"] + 1).cast("int"), (s["byte_stop"] - s["byte_start"]).cast("int")).cast("string")))
