"""Text functions with Python `str` semantics, written as native Spark expressions."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and str.split() treat as space.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The regex engine knows these as space, too, but for the four separators. A class that lists them all by hand would
# be far slower: long unions of ranges are tested range by range, and concurrently running tasks get in each other's way.
SEPARATORS = "\x1c\x1d\x1e\x1f"
WORD_PATTERN = r"(?U)\S+"
# Text with none of these, which are all spaces but blank and newline and some more, has its words counted without a search for each. The first
# class names each character and the other is one range: a class of both is slow, see above.
OTHER_SPACE_PATTERNS = (r"[\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0]", r"[\u1680-\u3000]")

# Tag pattern, shortest line kept, reading speed.
TAG_PATTERN = r"</?[^ >/][^>]*+>"
MIN_LINE_CHARS = 3
_INK = r"[\S&&[^\x1c-\x1f]]"
# What a line has that is long enough when stripped; of most lines only the first characters are looked at.
LONG_LINE_PATTERN = rf"(?Us){_INK}.{{{MIN_LINE_CHARS - 2},}}?{_INK}"
WORDS_PER_MINUTE = 200


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and hand it to `body`, whatever number of times `body` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def literal_array(values: Sequence[str]) -> Column:
    """An array of strings as one literal, whose plan has the same size for any number of values."""
    if any("\x00" in v for v in values):
        return F.array(*[F.lit(v) for v in values])
    return F.split(F.lit("\x00".join(values)), "\x00")


def _fold(text: Column, needles: Sequence[str], change: Callable[[Column, Column], Column]) -> Column:
    """Apply `change` for each needle in turn, but only to texts that contain it: the test costs far less than the change."""
    if not needles:
        return text
    return F.aggregate(
        literal_array(needles),
        text,
        lambda done, needle: F.when(F.contains(done, needle), change(done, needle)).otherwise(done),
    )


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def to_spaces(text: Column, chars: str) -> Column:
    return _fold(text, chars, lambda done, char: F.replace(done, char, F.lit(" ")))


def nonempty(text: Column) -> Column:
    """Null for the empty string; `text` is evaluated once."""
    return F.get(F.filter(F.array(text), lambda v: v != ""), 0)


def blank_to_null(text: Column) -> Column:
    return nonempty(strip(text))


def remove_tags(text: Column) -> Column:
    """Only what stands before the last ">" is searched, so that each "<" of it ends somewhere and the search is linear."""

    def cut(value: Column) -> Column:
        tail = F.substring_index(value, ">", -1)
        head = F.left(value, F.char_length(value) - F.char_length(tail))
        return F.concat(F.regexp_replace(head, TAG_PATTERN, ""), tail)

    return F.when(F.contains(text, F.lit("<")) & F.contains(text, F.lit(">")), let(text, cut)).otherwise(text)


def first_nonempty(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v != ""), 0)


def strip_all(values: Column) -> Column:
    """Strip every element and drop the ones that are null or blank."""
    return F.filter(F.transform(values, strip), lambda v: v != "")


# Up to so many phrases a test of each is quicker than a pattern of all.
FEW_PHRASES = 8


def phrase_pattern(phrases: Sequence[str]) -> str:
    """One pattern that finds any of the phrases: their prefix tree, so that a place of a text is tried once per branch and not once per phrase."""
    ordered = sorted(set(phrases))

    def literal(text: str) -> str:
        return "".join(c if c.isalnum() or ord(c) > 127 else f"\\x{ord(c):02x}" for c in text)

    def tree(begin: int, end: int, depth: int) -> str:
        """The phrases ordered[begin:end], which agree in their first `depth` characters."""
        if len(ordered[begin]) == depth:  # the shortest one is a prefix of the others
            return ""
        branches = []
        while begin < end:
            head, last = ordered[begin], begin + 1
            while last < end and ordered[last][depth] == head[depth]:
                last += 1
            shared = len(os.path.commonprefix([head, ordered[last - 1]]))
            branches.append(literal(head[depth:shared]) + tree(begin, last, shared))
            begin = last
        return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"

    return tree(0, len(ordered), 0)


def has_any_phrase(line: Column, phrases: Sequence[str]) -> Column:
    if not phrases:
        return F.lit(False)
    if len(phrases) <= FEW_PHRASES:
        return F.exists(literal_array(phrases), lambda phrase: F.contains(line, phrase))
    return F.contains(line, F.lit("")) if "" in phrases else line.rlike(phrase_pattern(phrases))


def cut_at_markers(text: Column, markers: Sequence[str]) -> Column:
    """Keep what stands before each marker; the order of the markers matters when they overlap."""
    return _fold(text, markers, lambda done, marker: F.call_function("substring_index", done, marker, F.lit(1)))


def clean_text(text: Column, phrases: Sequence[str] = (), markers: Sequence[str] = ()) -> Column:
    """Drop boilerplate from newline-separated text. Kept lines are not stripped, only the whole result is."""
    body = cut_at_markers(to_spaces(text, "\xa0"), markers)
    kept = F.filter(
        F.split(body, "\n"),
        lambda line: line.rlike(LONG_LINE_PATTERN) & ~has_any_phrase(line, phrases),
    )
    return strip(F.array_join(kept, "\n"))


def clean_content(blocks: Column, phrases: Sequence[str] = (), markers: Sequence[str] = ()) -> Column:
    """Join text blocks by newline and clean the result; null or empty input gives the empty string."""
    return F.coalesce(clean_text(F.array_join(blocks, "\n"), phrases, markers), F.lit(""))


def word_count(text: Column) -> Column:
    """Words as str.split() finds them. With single blanks and newlines only, they are what stands between these."""
    def count(blanked: Column) -> Column:
        gaps = F.octet_length(blanked) - F.octet_length(F.replace(blanked, F.lit(" "), F.lit("")))
        between = gaps + 1 - F.startswith(blanked, F.lit(" ")).cast("int") - F.endswith(blanked, F.lit(" ")).cast("int")
        searched = F.regexp_count(to_spaces(blanked, SEPARATORS), F.lit(WORD_PATTERN))
        narrow, wide = (blanked.rlike(p) for p in OTHER_SPACE_PATTERNS)
        single = (blanked != "") & ~F.contains(blanked, F.lit("  ")) & ~narrow & ((F.octet_length(blanked) == F.char_length(blanked)) | ~wide)
        return F.when(single, between).otherwise(searched)

    return let(F.replace(text, F.lit("\n"), F.lit(" ")), count)


def minutes_to_read(words: Column) -> Column:
    """Half-even rounding, at least one minute."""
    return F.greatest(F.lit(1), F.bround(words / F.lit(float(WORDS_PER_MINUTE)), 0).cast("int"))


def read_time(text: Column) -> Column:
    """Null for null or empty text."""
    return F.when(text != "", minutes_to_read(word_count(text)))


def split_tags(keywords: Column, keep_empty: bool = False) -> Column:
    tags = F.transform(F.split(keywords, ","), strip)
    return tags if keep_empty else F.filter(tags, lambda t: t != "")


def title_prefix(title: Column, length: int) -> Column:
    return F.concat(F.substring(F.coalesce(title, F.lit("N/A")), 1, length), F.lit("..."))


def percent_text(pct: Column) -> Column:
    return F.concat(F.format_string("%.1f", pct), F.lit("%"))
