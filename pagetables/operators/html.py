"""HTML source to a column of nodes, and selectors that read it.

`html_nodes` is the one Python step of the package: an Arrow UDF that sees only the html column and returns,
per page, an array of the elements some selector asks for. Every selector is then a native expression.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from html.entities import html5

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Executors get this module with the function, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_SCHEMA = (
    "array<struct<pos:int,tag:string,id:string,classes:array<string>,regions:array<string>,"
    "attrs:map<string,string>,texts:array<struct<pos:int,text:string>>>>"
)
_NODE_ARROW = pa.list_(
    pa.struct([
        ("pos", pa.int32()),
        ("tag", pa.string()),
        ("id", pa.string()),
        ("classes", pa.list_(pa.string())),
        ("regions", pa.list_(pa.string())),
        ("attrs", pa.map_(pa.string(), pa.string())),
        ("texts", pa.list_(pa.struct([("pos", pa.int32()), ("text", pa.string())]))),
    ])
)

# HTML element groups, and which open elements a new element ends.
VOID_TAGS = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
HEAD_TAGS = frozenset("base link meta noscript script style title".split())
ROOT_TAGS = frozenset(("html", "head", "body"))
RAW_TAGS = frozenset(("script", "style"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FONT_TAGS = frozenset("b big i s small strike tt u".split())
BLOCK_TAGS = (
    "address blockquote center dd dir div dl dt form h1 h2 h3 h4 h5 h6 hr li listing menu ol p pre table tbody td tfoot th "
    "thead title tr ul xmp"
).split()
ENDED_BY = {tag: frozenset(("p",)) for tag in BLOCK_TAGS} | {
    "p": HEADINGS | FONT_TAGS | {"p"},
    "a": frozenset(("a",)),
    "li": HEADINGS | {"p", "li"},
    "dd": frozenset(("p", "dd", "dt")),
    "dt": frozenset(("p", "dd", "dt")),
    "option": frozenset(("option",)),
    "td": frozenset("td th p span font a b i u".split()),
    "th": frozenset("td th p span font a b i u".split()),
    "tr": frozenset("td th tr caption col colgroup p".split()),
    "tbody": frozenset("td th tr caption col colgroup thead tfoot tbody p".split()),
    **{tag: HEADINGS | {"p"} for tag in HEADINGS},
}
# An end tag cannot reach past an open element of a higher rank.
END_RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180, "table": 190,
            "head": 200, "body": 200, "html": 220}
PLAIN_RANK = 100
# HTML that is scanned at once; its nodes are Python objects until they are packed.
SCANNED_BYTES = 2_000_000

# What can follow a "<": an end tag, a start tag with its attributes, a comment or a declaration.
_MARKUP = re.compile(
    r"</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+)(?:>|\Z)"
    r"|<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*(?:;|(?![a-zA-Z0-9=])))")
_RAW_END = {tag: re.compile(rf"</{tag}|\Z", re.IGNORECASE) for tag in RAW_TAGS}


@dataclass(frozen=True)
class Selector:
    """Elements by tag, class token, id, class substring or attribute value; all given tests must hold."""

    tag: str | None = None
    cls: str | None = None
    elem_id: str | None = None
    class_part: str | None = None
    attr: tuple[str, str] | None = None
    take: str | None = None  # attribute to read; None reads the direct text

    def matches(self, node: Column) -> Column:
        tests = []
        if self.tag:
            tests.append(node["tag"] == self.tag)
        if self.cls:
            tests.append(F.exists(node["classes"], lambda cls: cls == self.cls))
        if self.elem_id:
            tests.append(node["id"] == self.elem_id)
        if self.class_part:
            tests.append(F.contains(node["attrs"]["class"], F.lit(self.class_part)))
        if self.attr:
            tests.append(node["attrs"][self.attr[0]] == self.attr[1])
        condition = tests[0]
        for test in tests[1:]:
            condition = condition & test
        return F.coalesce(condition, F.lit(False))


@dataclass(frozen=True)
class NodeSpec:
    """Which elements the scan keeps. Only these leave the Python step, so rows stay small."""

    selectors: tuple[Selector, ...]
    regions: tuple[str, ...] = ()

    def attrs_of_interest(self) -> frozenset[str]:
        names = {s.take for s in self.selectors if s.take} | {s.attr[0] for s in self.selectors if s.attr}
        return frozenset(names | ({"class"} if any(s.class_part for s in self.selectors) else set()))

    def keeps(self, tag: str, elem_id: str | None, classes: list[str], attrs: dict[str, str]) -> bool:
        for s in self.selectors:
            if (
                (s.tag is None or s.tag == tag)
                and (s.cls is None or s.cls in classes)
                and (s.elem_id is None or s.elem_id == elem_id)
                and (s.class_part is None or s.class_part in attrs.get("class", ""))
                and (s.attr is None or attrs.get(s.attr[0]) == s.attr[1])
            ):
                return True
        return False


def _attribute_text(value: str) -> str:
    """Decoded value. Unlike in text, a name that runs on or is followed by "=" is no entity: "?a=1&copy=2" is a URL."""

    def decoded(found: re.Match) -> str:
        name = found[0][1:]
        return unescape(found[0]) if name in html5 or name.startswith("#") else found[0]

    return _REFERENCE.sub(decoded, value) if "&" in value else value


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTR.findall(source):
        found.setdefault(name.lower(), _attribute_text(double or single or bare))
    return found


def element_reader(spec: NodeSpec) -> Callable[[str, str], tuple]:
    """(tag, attribute source) -> (kept, id, classes, regions, kept attributes), remembering recent answers.

    Pages repeat the same few start tags over and over, so most elements cost one lookup.
    """
    wanted_attrs = spec.attrs_of_interest()

    def read(tag: str, source: str) -> tuple:
        attrs = _attributes(source) if source else {}
        classes = attrs.get("class", "").split()
        regions = tuple(c for c in spec.regions if c in classes)
        kept = spec.keeps(tag, attrs.get("id"), classes, attrs)
        return kept, attrs.get("id"), classes, regions, [(k, v) for k, v in attrs.items() if k in wanted_attrs]

    return lru_cache(maxsize=4096)(read)


def scan_page(html: str, read_element: Callable[[str, str], tuple]) -> list[tuple]:
    """The kept elements of one page, in document order, each with its direct text runs."""
    nodes: list[tuple] = []
    stack: list[tuple[str, list | None, tuple[str, ...]]] = []
    # Where open elements of a tag, and of a rank, stand in the stack: an end tag finds its element without walking.
    by_tag: dict[str, list[int]] = {}
    by_rank: dict[int, list[int]] = {}
    run: list[str] = []
    html = html.strip().replace("\x00", "")
    at, pos, size = 0, 0, len(html)

    def open_element(tag: str, source: str = "") -> None:
        kept, elem_id, classes, own_regions, attrs = read_element(tag, source)
        regions = stack[-1][2] if stack else ()
        if own_regions:
            regions += tuple(r for r in own_regions if r not in regions)
        texts = None
        if kept:
            texts = []
            nodes.append((pos, tag, elem_id, classes, regions, attrs, texts))
        if tag not in VOID_TAGS:
            by_tag.setdefault(tag, []).append(len(stack))
            by_rank.setdefault(END_RANK.get(tag, PLAIN_RANK), []).append(len(stack))
            stack.append((tag, texts, regions))

    def close_top() -> None:
        tag = stack.pop()[0]
        by_tag[tag].pop()
        by_rank[END_RANK.get(tag, PLAIN_RANK)].pop()

    def open_body() -> None:
        if stack and stack[-1][0] == "head":
            close_top()
        if not stack or (stack[-1][0] == "html"):
            open_element("body")

    def end_run() -> None:
        if not run:
            return
        if stack and stack[-1][1] is None and stack[-1][0] not in ("html", "head"):  # nobody asked for it
            run.clear()
            return
        text = "".join(run)
        run.clear()
        if (not stack or stack[-1][0] in ("html", "head")) and not text.isspace():
            open_body()
            open_element("p")
        if stack and stack[-1][1] is not None:
            raw = stack[-1][0] in RAW_TAGS
            stack[-1][1].append((pos, text if raw or "&" not in text else unescape(text)))

    while at < size:
        mark = html.find("<", at)
        if mark != at:
            run.append(html[at:mark] if mark > 0 else html[at:])
            at = mark if mark > 0 else size
            continue
        markup = _MARKUP.match(html, at)
        if markup is None:  # a "<" that opens nothing is text
            run.append("<")
            at += 1
            continue
        at, pos = markup.end(), pos + 1
        end_tag, start_tag, attributes = markup.groups()
        if start_tag:
            end_run()
            tag = start_tag.lower()
            if tag not in HEAD_TAGS and tag not in ROOT_TAGS:
                open_body()
            elif tag == "body" and stack and stack[-1][0] == "head":
                close_top()
            ends = ENDED_BY.get(tag, ())
            while stack and stack[-1][0] in ends:
                close_top()
            open_element(tag, attributes)
            if tag in RAW_TAGS:
                close = _RAW_END[tag].search(html, at)
                run.append(html[at : close.start()])
                at = close.start()
        elif end_tag:
            tag = end_tag.lower()
            if stack and stack[-1][0] == tag and tag not in ROOT_TAGS:  # the innermost element: nothing stands in the way
                end_run()
                close_top()
                continue
            rank = END_RANK.get(tag, PLAIN_RANK)
            depth = by_tag[tag][-1] if by_tag.get(tag) else -1
            blocked = any(higher > rank and places and places[-1] > depth for higher, places in by_rank.items())
            if depth >= 0 and not blocked and tag not in ("html", "body"):
                end_run()
                while len(stack) > depth:
                    close_top()
        else:
            end_run()
    end_run()
    return nodes


def page_runs(pages: pa.Array, limit: int = SCANNED_BYTES) -> list[pa.Array]:
    """Consecutive pages in runs that end once they have `limit` bytes."""
    sizes = pc.fill_null(pc.binary_length(pages), 0).to_pylist()
    runs, start, held = [], 0, 0
    for end, size in enumerate(sizes, 1):
        held += size
        if held >= limit or end == len(sizes):
            runs.append(pages.slice(start, end - start))
            start, held = end, 0
    return runs


def html_nodes(html: Column, spec: NodeSpec) -> Column:
    """Array of kept nodes per page; null for null html.

    Marked non-deterministic so that Catalyst never copies the scan below or above a filter: one scan per page.
    A few megabytes of HTML at a time are scanned and handed on, whatever the size of a batch.
    """

    def scan_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = element_reader(spec)
        for batch in batches:
            for part in page_runs(batch):
                yield pa.array([None if page is None else scan_page(page, reader) for page in part.to_pylist()], type=_NODE_ARROW)

    scan_batches.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(scan_batches, NODE_SCHEMA).asNondeterministic()(html)


def select_nodes(nodes: Column, selector: Selector) -> Column:
    return F.filter(nodes, selector.matches)


def select_texts(nodes: Column, selector: Selector) -> Column:
    """Direct texts (or attribute values) of the matching elements in document order; never null for a scanned page."""
    found = select_nodes(nodes, selector)
    if selector.take:
        return F.filter(F.transform(found, lambda n: n["attrs"][selector.take]), lambda v: v.isNotNull())
    runs = F.sort_array(F.flatten(F.transform(found, lambda n: n["texts"])))
    return F.transform(runs, lambda r: r["text"])


def first_text(nodes: Column, selector: Selector) -> Column:
    return F.get(select_texts(nodes, selector), 0)


def meta_content(nodes: Column, attr: str, value: str) -> Column:
    return select_texts(nodes, meta(attr, value))


def by_tag(tag: str) -> Selector:
    return Selector(tag=tag)


def by_class(cls: str) -> Selector:
    return Selector(cls=cls)


def by_id(elem_id: str) -> Selector:
    return Selector(elem_id=elem_id)


def by_class_part(tag: str, part: str) -> Selector:
    return Selector(tag=tag, class_part=part)


def meta(attr: str, value: str) -> Selector:
    return Selector(tag="meta", attr=(attr, value), take="content")


def spec_for(selectors: Iterable[Selector], regions: Iterable[str] = ()) -> NodeSpec:
    return NodeSpec(tuple(dict.fromkeys(selectors)), tuple(regions))
