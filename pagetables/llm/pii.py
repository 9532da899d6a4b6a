"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds spans written otherwise.

Base spans are leftmost and non-overlapping per kind; a match that fails its check (octets, digit count, Luhn) is dropped
and not retried. Each is found in time linear in the text.

The field segments the stretches of a text that hold digits, "@" or a bracketed "at" or "dot". A segment is one token
outside of any entity, or up to MAX_TOKENS tokens of one kind; features describe the whole segment (digit count, checksum,
octets, separators, ending, neighbours). Boundaries and kinds are chosen jointly by dynamic programming, whose work is
tokens x MAX_TOKENS for a stretch of any length. An entity found so is added where it touches no base span.

Training takes the base spans as labels, in a sample of stretches bounded by `train_windows` and chosen by hash over the whole
corpus; half of the spans are rewritten in other notations ("name (at) host", "0049 ...", dotted card groups), so that the model
learns forms that the patterns lack. Without any stretch there is no model and nothing is added.

Null and empty texts have no spans; repeated rows get equal spans; ids and other columns are not read.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import at_work, ship

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 24

_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_ANY = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]")
_NON_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _octet(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every address starts where the run of local-part characters before its "@" does, or where the last address ended."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
        # A failed "@" ends all runs before it; nothing left of it can belong to a later address.
        done = host.end() if host else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NON_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NON_DIGIT.sub("", m.group())) <= 15]
    return found


# --- stretches and tokens -----------------------------------------------------------------------------------------

_RUN = re.compile(r"\S*")
_TOKEN = re.compile(r"[^\W_]+|.", re.DOTALL)


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches that may hold an entity: words with a mark, joined when one blank parts them. Time linear in the text."""
    found: list[list[int]] = []
    pos = 0
    while mark := _ANY.search(text, pos):
        start = mark.start()
        while start > pos and not text[start - 1].isspace():
            start -= 1
        end = _RUN.match(text, mark.end()).end()
        if mark.group()[0] in "[(":  # a written-out sign belongs to the words around it
            while start > pos and text[start - 1].isspace():
                start -= 1
            while start > pos and not text[start - 1].isspace():
                start -= 1
            if end < len(text):
                end = _RUN.match(text, end + 1).end()
        if found and start - found[-1][1] <= 1:
            found[-1][1] = end
        else:
            found.append([start, end])
        pos = end
    return [(a, b) for a, b in found if b > a]


def _checks(segment: str, before: str, after: str, n_tokens: int) -> tuple[bool, ...]:
    """The features of a whole segment."""
    digits = _NON_DIGIT.sub("", segment)
    n = len(digits)
    letters = sum(c.isalpha() for c in segment)
    parts = segment.split(".")
    tail = re.search(r"(?:\.|[\[(]dot[\])]\s*)([A-Za-z]{2,6})$", segment)
    return (
        True,
        n == 0,
        1 <= n < 7,
        7 <= n < 9,
        9 <= n <= 12,
        13 <= n <= 15,
        16 <= n <= 19,
        n > 19,
        13 <= n <= 19 and luhn(digits),
        segment.count("@") == 1 or re.search(r"[\[(]at[\])]", segment) is not None,
        segment.count("@") > 1,
        len(parts) == 4 and all(p.isdigit() and _octet(p) for p in parts),
        tail is not None and letters > 2,
        segment[0] == "+",
        segment.startswith("00"),
        letters == 0,
        letters > n,
        " " in segment,
        "(" in segment,
        ")" in segment,
        bool(re.fullmatch(r"[0-9]{4}(?:[ .-]?[0-9]{4}){2,3}(?:[ .-]?[0-9]{1,3})?", segment)),
        bool(re.fullmatch(r"[+0-9(][0-9 ().-]*[0-9]", segment)),
        before == "" or before.isspace(),
        after == "" or after.isspace() or after in ",;:!?.",
        before.isalnum() or before in "@+.-_" and before != "",
        after.isalnum() or after in "@-_" and after != "",
        not segment[0].isalnum() and segment[0] not in "+(",
        not segment[-1].isalnum(),
        n_tokens == 1,
        n_tokens > 10,
        "=" in segment or '"' in segment or ":" in segment or "/" in segment,
    )


N_BITS = len(_checks("x", "", "", 1))
_LABELS = len(KINDS) + 1  # the last is "outside"
_OUT = len(KINDS)


class Field:
    """Weights of the segment features by label, and of neighbouring labels."""

    def __init__(self, weights: np.ndarray | None = None, links: np.ndarray | None = None):
        self.weights = np.zeros((_LABELS, N_BITS)) if weights is None else weights
        self.links = np.zeros((_LABELS, _LABELS)) if links is None else links

    @staticmethod
    def spans_and_rows(text: str, before: str = "", after: str = "") -> tuple[list[tuple[int, int]], Iterator[np.ndarray]]:
        """Token spans; for each end in turn, the features of the segments that end there (segments x features), shortest first."""
        spans = [m.span() for m in _TOKEN.finditer(text)]

        def rows() -> Iterator[np.ndarray]:
            for j, (_, end) in enumerate(spans):
                right = text[end] if end < len(text) else after
                row = []
                for k in range(min(j + 1, MAX_TOKENS)):
                    a = spans[j - k][0]
                    if k and text[a] == "\n":
                        break  # no entity runs over a line end
                    row.append(_checks(text[a:end], text[a - 1] if a else before, right, k + 1))
                yield np.array(row, dtype=float)

        return spans, rows()

    def _scores(self, row: np.ndarray) -> np.ndarray:
        """By segment and label; outside segments are one token long."""
        out = row @ self.weights.T
        out[1:, _OUT] = -np.inf
        return out

    def decode(self, text: str, before: str = "", after: str = "") -> list[tuple[str, int, int]]:
        """The best segmentation's entities. Holds two small numbers a token and label, and the last MAX_TOKENS scores."""
        spans, rows = self.spans_and_rows(text, before, after)
        best = np.full((MAX_TOKENS + 1, _LABELS), -np.inf)  # a ring: the scores of position j stand at j % its size
        best[0, _OUT] = 0.0
        lengths = np.zeros((len(spans), _LABELS), dtype=np.int8)
        sources = np.zeros((len(spans), _LABELS), dtype=np.int8)
        for j, row in enumerate(rows):
            came = best[(j - np.arange(len(row))) % len(best), :, None] + self.links[None]
            total = came.max(axis=1) + self._scores(row)
            lengths[j] = total.argmax(axis=0)
            sources[j] = came.argmax(axis=1)[lengths[j], np.arange(_LABELS)]
            best[(j + 1) % len(best)] = total.max(axis=0)
        found, j, label = [], len(spans), int(best[len(spans) % len(best)].argmax())
        while j > 0:
            n, source = int(lengths[j - 1, label]), int(sources[j - 1, label])
            if label != _OUT:
                found.append((KINDS[label], spans[j - 1 - n][0], spans[j - 1][1]))
            j, label = j - 1 - n, source
        return found[::-1]

    def gradient(self, ends: list[np.ndarray], gold: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Of the log-likelihood of a segmentation (end, length - 1, label): observed minus expected feature counts."""
        size = len(ends)
        scores = [self._scores(row) for row in ends]
        alpha = np.full((size + 1, _LABELS), -np.inf)
        alpha[0, _OUT] = 0.0
        arrive = []
        for j, s in enumerate(scores):
            came = alpha[j - np.arange(len(s)), :, None] + self.links[None]
            arrive.append(_log_sum(came, 1))
            alpha[j + 1] = _log_sum(arrive[j] + s, 0)
        beta = np.full((size + 1, _LABELS), -np.inf)
        beta[size] = 0.0
        for j in range(size - 1, -1, -1):
            reach = range(min(MAX_TOKENS, size - j))
            ahead = np.array([scores[j + k][k] + beta[j + k + 1] for k in reach if k < len(scores[j + k])])
            beta[j] = _log_sum(self.links + _log_sum(ahead, 0)[None], 1)
        z = _log_sum(alpha[size][None], 1)[0]
        d_weights, d_links = np.zeros_like(self.weights), np.zeros_like(self.links)
        for j, (s, row) in enumerate(zip(scores, ends)):
            p = np.exp(arrive[j] + s + beta[j + 1][None] - z)
            d_weights -= p.T @ row
            came = alpha[j - np.arange(len(s)), :, None] + self.links[None]
            d_links -= np.exp(came + (s + beta[j + 1] - z)[:, None, :]).sum(axis=0)
        last = _OUT
        for j, k, label in gold:
            d_weights[label] += ends[j][k]
            d_links[last, label] += 1
            last = label
        return d_weights, d_links


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


# --- training -----------------------------------------------------------------------------------------------------


def _rewritten(kind: str, span: str, rng: random.Random) -> str:
    if kind == "email":
        at, dot = rng.choice([(" (at) ", "."), ("(at)", "."), (" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", " (dot) ")])
        local, _, host = span.partition("@")
        return local + at + host.replace(".", dot)
    if kind == "card":
        digits = _NON_DIGIT.sub("", span)
        return rng.choice(".-").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if kind == "phone":
        return rng.choice(["00", "00 ", "(00)"]) + span[1:]
    return span


def train(stretches: list[str], epochs: int = 6, rate: float = 0.3, decay: float = 1e-3, seed: int = 7) -> Field | None:
    """Adaptive gradient ascent on the conditional likelihood of segmentations."""
    rng = random.Random(seed)
    cases = []
    for text in stretches:
        kept, end = [], 0
        for kind, a, b in sorted(base_spans(text), key=lambda s: (s[1], -s[2])):
            if a >= end:
                kept.append((kind, a, b))
                end = b
        out, gold, at = "", [], 0
        for kind, a, b in kept:
            new = _rewritten(kind, text[a:b], rng) if rng.random() < 0.5 else text[a:b]
            out += text[at:a]
            gold.append((kind, len(out), len(out) + len(new)))
            out, at = out + new, b
        out += text[at:]
        if len(out) > 400:
            continue
        spans, rows = Field.spans_and_rows(out)
        ends = list(rows)
        first = {a: i for i, (a, _) in enumerate(spans)}
        last = {b: i for i, (_, b) in enumerate(spans)}
        entities = {last[b]: (last[b] - first[a], KINDS.index(kind)) for kind, a, b in gold if a in first and b in last and last[b] - first[a] < MAX_TOKENS}
        inside = {i for j, (k, _) in entities.items() for i in range(j - k, j)}
        path = [(j, *entities.get(j, (0, _OUT))) for j in range(len(spans)) if j not in inside]
        cases.append((ends, path))
    if not cases:
        return None
    field = Field()
    seen = [np.full_like(field.weights, 1e-6), np.full_like(field.links, 1e-6)]
    for _ in range(epochs):
        rng.shuffle(cases)
        for ends, path in cases:
            for parameter, step, square in zip((field.weights, field.links), field.gradient(ends, path), seen):
                step = step - decay * parameter
                square += step * step
                parameter += rate * step / np.sqrt(square)
    return field


def _stretches_of(texts: list[str]) -> list[list[str]]:
    return [[t[a:b] for a, b in windows(t)] for t in texts]


def fit(docs: DataFrame, text: str = "text", train_windows: int = 500) -> Field | None:
    """Train on at most `train_windows` distinct stretches of up to 400 characters, those of smallest hash; the choice covers all rows.

    Half of the sample are stretches with base spans, so that rare kinds are seen whatever the share of plain numbers.
    """
    ship(docs.sparkSession)

    @F.arrow_udf("array<struct<stretch:string,labelled:boolean>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("stretch", pa.string()), ("labelled", pa.bool_())]))
        for batch in batches:
            rows = _stretches_of([t or "" for t in batch.to_pylist()])
            yield pa.array([[{"stretch": s, "labelled": bool(base_spans(s))} for s in set(row) if len(s) <= 400] for row in rows], kind)

    found = docs.select(F.explode(cut(F.col(text))).alias("w")).select("w.*").withColumn("mix", F.xxhash64("stretch"))
    halves = []
    for labelled in (True, False):
        part = found.filter(F.col("labelled") == labelled)
        halves.append(part.groupBy("mix").agg(F.min("stretch").alias("stretch")).orderBy("mix").limit(train_windows // 2))
    rows = halves[0].unionByName(halves[1]).collect()
    return train([r.stretch for r in rows])


# --- scoring ------------------------------------------------------------------------------------------------------


def all_spans(text: str, decode) -> list[tuple[str, int, int, bool]]:
    """Base spans, and the field's spans that touch none of them, by kind and start; the flag marks base spans."""
    base = base_spans(text)
    added = []
    for start, end in _free(windows(text), _merged(base)) if decode else ():
        if _ANY.search(text, start, end):
            found = decode(text[start:end], text[start - 1] if start else "", text[end : end + 1])
            added += [(kind, a + start, b + start, False) for kind, a, b in found]
    spans = [(*s, True) for s in base] + added
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def _free(stretches: list[tuple[int, int]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What is left of the stretches outside of the taken ones; both in order and disjoint."""
    i = 0
    for start, end in stretches:
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        while i < len(taken) and taken[i][0] < end:
            if start < taken[i][0]:
                yield start, taken[i][0]
            start = max(start, taken[i][1])
            if taken[i][1] > end:
                break
            i += 1
        if start < end:
            yield start, end


def _merged(spans: list[tuple]) -> list[tuple[int, int]]:
    """The stretches that spans cover, disjoint and in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s[1], s[2]) for s in spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def redacted(text: str, spans: list[tuple]) -> str:
    """Each covered stretch replaced by the kind, in brackets, of the span that starts it (the longest of these)."""
    kinds = {}
    for kind, a, b, *_ in sorted(spans, key=lambda s: s[2]):
        kinds[a] = kind
    out, at = [], 0
    for a, b in _merged(spans):
        out += [text[at:a], f"[{kinds[a].upper()}]"]
        at = b
    return "".join([*out, text[at:]])


SPAN_TYPE = "array<struct<kind:string,start:long,stop:long,base:boolean>>"


def finder(docs: DataFrame, field: Field | None):
    """A function Column -> Column: texts to their spans in code points, stop exclusive, by kind and start."""
    ship(docs.sparkSession)
    weights = None if field is None else (field.weights, field.links)

    @F.arrow_udf(SPAN_TYPE)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at_work("pii", dict)
        decode = None if weights is None else lru_cache(maxsize=10_000)(Field(*weights).decode)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))
        names = ("kind", "start", "stop", "base")
        for batch in batches:
            yield pa.array([[dict(zip(names, s)) for s in all_spans(t, decode)] if t else [] for t in batch.to_pylist()], kind)

    return find.asNondeterministic()


def span_text(spans: Column, only_base: bool = False) -> Column:
    """kind:start:stop, joined by commas."""
    kept = F.filter(spans, lambda s: s["base"]) if only_base else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redacted_fully(text: str, decode) -> str:
    """Redact until no span with a digit or "@" is found: what stands beside a replaced span may be a match of its own then.

    What replaces a span holds neither sign, so that every turn after the first leaves fewer of them and the last turn comes.
    """
    text = redacted(text, all_spans(text, decode))
    while spans := [s for s in all_spans(text, decode) if any(c == "@" or c.isdigit() for c in text[s[1] : s[2]])]:
        text = redacted(text, spans)
    return text


def redactor(docs: DataFrame, field: Field | None):
    """A function Column -> Column: texts with all spans replaced; nulls stay null."""
    ship(docs.sparkSession)
    weights = None if field is None else (field.weights, field.links)

    @F.arrow_udf("string")
    def redact(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at_work("pii", dict)
        decode = None if weights is None else lru_cache(maxsize=10_000)(Field(*weights).decode)
        for batch in batches:
            yield pa.array([redacted_fully(t, decode) if t else t for t in batch.to_pylist()], pa.string())

    return redact.asNondeterministic()
