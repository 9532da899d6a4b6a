"""Fill-in-middle transformation: texts cut into prefix, middle and suffix, and written in sentinel order.

Cuts are drawn in code points, texts are stored as bytes. A sparse exception index maps one to the other: it holds an entry
for each multibyte character alone, its position and the bytes that it takes beyond one. The byte of a cut is the cut plus
the excess of the characters before it, found by `searchsorted`; stretches of ASCII have no entries and stay arithmetic. One index
serves a whole batch of texts, which lie behind each other in one buffer, so nothing is decoded.

A text's form and cuts hang on a hash of its key alone. It is `plain` (left as it is) when it is empty or holds a sentinel, and
for `100 - rate` of 100 keys; of the others `spm_rate` of 100 are suffix-prefix-middle, the rest prefix-suffix-middle. As no text
that is cut holds a sentinel, and no sentinel begins within the end of another or of a text, `restored` finds the parts again.

Rows are transformed where they lie, without a shuffle. Null texts are empty; a null key is drawn for like an empty one; repeated rows
get equal results; texts are taken whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import ship, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULT = "form string, n long, prefix_chars long, middle_chars long, output string"


class ExceptionIndex:
    """Where the multibyte characters of a UTF-8 buffer begin, and how many bytes all of them up to each take beyond one."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate([[0], np.cumsum(excess)])
        self.chars = self.at - self.before[:-1]

    def chars_at(self, byte: np.ndarray) -> np.ndarray:
        """The number of characters before a byte at which a character begins."""
        return byte - self.before[np.searchsorted(self.at, byte)]

    def bytes_at(self, char: np.ndarray) -> np.ndarray:
        """The byte at which a character begins."""
        return char + self.before[np.searchsorted(self.chars, char)]


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an array of strings without nulls."""
    wide = texts.cast(pa.large_string())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def transform_batch(texts: pa.Array, draws: list[np.ndarray], rate: int, spm_rate: int) -> pa.StructArray:
    """Forms, sizes and outputs of a batch; `draws` holds four numbers a text."""
    offsets, data = _buffers(texts)
    if len(texts) == 0:
        return pa.array([], pa.struct([("form", pa.string()), ("n", pa.int64()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]))
    index = ExceptionIndex(data[: offsets[-1]])
    first = index.chars_at(offsets)
    n = np.diff(first)
    one, two = draws[0] % (n + 1), draws[1] % (n + 1)
    cuts = np.minimum(one, two), np.maximum(one, two)
    marked = np.zeros(len(n), bool)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        marked |= np.asarray(pc.match_substring(texts, sentinel), dtype=bool)
    plain = (n == 0) | marked | (draws[2] % 100 >= rate)
    form = np.where(plain, "plain", np.where(draws[3] % 100 < spm_rate, "spm", "psm"))
    places = zip(form.tolist(), offsets[:-1].tolist(), *(index.bytes_at(first[:-1] + c).tolist() for c in cuts), offsets[1:].tolist())
    held = memoryview(data)
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()

    def written(kind: str, a: int, b: int, c: int, d: int) -> bytes:
        if kind == "plain":
            return held[a:d]
        if kind == "psm":
            return b"".join((p, held[a:b], s, held[c:d], m, held[b:c]))
        return b"".join((s, held[c:d], p, held[a:b], m, held[b:c]))

    output = pa.array([bytes(written(*place)) for place in places], pa.binary()).view(pa.string())
    sizes = [pa.array(x, pa.int64(), mask=plain) for x in (cuts[0], cuts[1] - cuts[0])]
    return pa.StructArray.from_arrays([pa.array(form.tolist(), pa.string()), pa.array(n, pa.int64()), *sizes, output],
                                      ["form", "n", "prefix_chars", "middle_chars", "output"])


def draws(key: str | Column) -> list[Column]:
    """Four numbers of 32 bits from a key's decimal form."""
    name = F.col(key) if isinstance(key, str) else key
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(name.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transformer(df: DataFrame, rate: int = 90, spm_rate: int = 20):
    """A function (text column, key column) -> struct of form, n, prefix_chars, middle_chars and output."""
    ship(df.sparkSession)

    @F.arrow_udf(RESULT)
    def transform(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, *numbers in batches:
            yield transform_batch(texts, [n.to_numpy(zero_copy_only=False) for n in numbers], rate, spm_rate)

    transform = transform.asNondeterministic()
    return lambda text, key: transform(text_or_empty(text), *draws(key))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from."""
    head, tail = F.substring(output, F.lit(4), F.char_length(output)), F.substring_index(output, MIDDLE, -1)
    body = F.substring_index(head, MIDDLE, 1)
    psm = F.concat(F.substring_index(body, SUFFIX, 1), tail, F.substring_index(body, SUFFIX, -1))
    spm = F.concat(F.substring_index(body, PREFIX, -1), tail, F.substring_index(body, PREFIX, 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """One row a document: its key, form, n, prefix_chars, middle_chars and output."""
    made = docs.select(F.col(key), transformer(docs, rate, spm_rate)(text, key).alias("made"))
    return made.select(F.col(key), "made.*")
