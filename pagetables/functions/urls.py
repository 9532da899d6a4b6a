"""URL parts, resolution of hrefs against a page, and domain tests."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetables.functions.text import let, strip

# Generic URL syntax, characters a URL may carry as they are, trailing id segment.
URL_PATTERN = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?"
SAFE_URL_CHARS = string.ascii_letters + string.digits + "-._~:/?#[]@!$&'()*+,;=%|"
UNSAFE_URL_CHAR = "[^" + re.sub(r"(\W)", r"\\\1", SAFE_URL_CHARS) + "]"
URL_ID_PATTERN = r"/([a-z0-9]+)$"
WEB_SCHEMES = ("http", "https", "file", "ftp")


def url_parts(url: Column) -> Column:
    """STRUCT of scheme, authority, path, query (with '?') and fragment (with '#'); parts not there are empty."""

    def split(text: Column) -> Column:
        names = ("scheme", "authority", "path", "query", "fragment")
        return F.struct(*[F.regexp_extract(text, URL_PATTERN, i).alias(name) for i, name in enumerate(names, start=1)])

    return let(url, split)


def url_host(url: Column) -> Column:
    authority = F.regexp_extract(url, URL_PATTERN, 2)
    return F.lower(F.regexp_replace(authority, r"^.*@|:[0-9]*$", ""))


def in_domains(url: Column, domains: Sequence[str]) -> Column:
    """Host equals one of the domains or lies below it; no domains means no restriction."""
    if not domains:
        return F.lit(True)
    names = "|".join(d.lower().replace(".", r"\.") for d in domains)
    return url_host(url).rlike(rf"^(?:.*\.)?(?:{names})\z")


def escape_url(url: Column) -> Column:
    """Percent-encode (UTF-8) the characters a URL may not carry; text without any is passed through."""

    def escaped(char: Column) -> Column:
        return F.when(char == " ", F.lit("%20")).when(char.rlike(UNSAFE_URL_CHAR), F.url_encode(char)).otherwise(char)

    def escape(text: Column) -> Column:
        return F.when(text.rlike(UNSAFE_URL_CHAR), F.array_join(F.transform(F.split(text, ""), escaped), "")).otherwise(text)

    return let(url, escape)


def _drop_dot_segments(path: Column) -> Column:
    def step(done: Column, segment: Column) -> Column:
        return (
            F.when(segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
            .when(segment == ".", done)
            .otherwise(F.concat(done, F.array(segment)))
        )

    def resolve(segments: Column) -> Column:
        # A path that ends in a dot segment names a folder.
        end = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.concat(F.aggregate(segments, F.array().cast("array<string>"), step), end), "/")

    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), let(F.split(path, "/"), resolve)).otherwise(path)


def resolve_href(base: Column, href: Column) -> Column:
    """Resolve `href` against `base`, the `url_parts` struct column of the page it stands on."""
    root = F.concat(base["scheme"], F.lit("://"), base["authority"])

    def full_path(path: Column) -> Column:
        folder = F.regexp_extract(base["path"], r"^(.*/)?", 0)
        below = F.regexp_replace(F.concat(F.lit("/"), folder, path), r"/{2,}", "/")
        joined = F.when(F.startswith(path, F.lit("/")), path).otherwise(below)
        return let(let(joined, _drop_dot_segments), lambda p: F.when(p == "", F.lit("/")).otherwise(p))

    def build(part: Column) -> Column:
        # A query or fragment mark with nothing behind it is dropped.
        query = F.when(part["query"] != "?", part["query"]).otherwise(F.lit(""))
        fragment = F.when(part["fragment"] != "#", part["fragment"]).otherwise(F.lit(""))
        tail = F.concat(query, fragment)
        same_page = F.concat(root, base["path"], F.when(query == "", base["query"]).otherwise(query), fragment)
        return (
            F.when((part["scheme"] != "") & (part["scheme"] != base["scheme"]), F.lit(None).cast("string"))
            .when(part["authority"] != "", F.concat(base["scheme"], F.lit("://"), part["authority"], part["path"], tail))
            .when(part["path"] == "", same_page)
            .otherwise(F.concat(root, full_path(part["path"]), tail))
        )

    def resolve(text: Column) -> Column:
        whole_base = F.concat(root, base["path"], base["query"], base["fragment"])
        return F.when(text == "", whole_base).otherwise(F.coalesce(let(url_parts(text), build), text))

    return let(href, resolve)


def absolute_url(base_url: Column, href: Column) -> Column:
    """`href` as written on the page at `base_url`, stripped, escaped and resolved."""
    return let(url_parts(base_url), lambda base: resolve_href(base, escape_url(strip(href))))


def url_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, URL_ID_PATTERN, 1), F.lit(""))


def drop_trailing_slashes(url: Column) -> Column:
    return F.rtrim(url, F.lit("/"))


# What a path carries as it is, besides letters, digits and "-._*", which the encoder leaves alone.
PATH_MARKS = "!$&'()+,;=:@~"


# URLs that are canonical as they stand: no query, fragment or escape, host in lower case. The classes name every character: ranges would be
# tried one after the other, a list of characters is one look-up.
_LOWER, _UPPER, _DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
PLAIN_URL = rf"^(?:[{_LOWER}][{_LOWER}{_DIGITS}+.\-]*+://[^/?#{_UPPER}]++)?/[{_UPPER}{_LOWER}{_DIGITS}/._*!$&'()+,;=:@~\-]*+$"


def _normal_escapes(text: Column, form: bool) -> Column:
    """The text with escapes only where they are needed, in one spelling; text that cannot be decoded stays. In a `form`, plus is space."""
    if form:
        return F.coalesce(F.url_encode(F.try_url_decode(text)), text)
    encoded = F.replace(F.url_encode(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))), F.lit("+"), F.lit("%20"))
    for mark in PATH_MARKS:
        encoded = F.replace(encoded, F.lit(f"%{ord(mark):02X}"), F.lit(mark))
    return F.coalesce(encoded, text)


def _sorted_query(query: Column) -> Column:
    """Arguments by name and value, escapes normal, a missing value empty; empty for a query without arguments."""
    pairs = F.transform(F.filter(F.split(query, "&"), lambda a: a != ""), lambda a: F.struct(
        _normal_escapes(F.substring_index(a, "=", 1), True).alias("name"),
        _normal_escapes(F.when(F.contains(a, F.lit("=")), F.substr(a, F.instr(a, "=") + 1)).otherwise(F.lit("")), True).alias("value")))
    return F.array_join(F.transform(F.array_sort(pairs), lambda p: F.concat(p["name"], F.lit("="), p["value"])), "&")


def canonical_url(url: Column) -> Column:
    """What makes two URLs one page: scheme and host in lower case, normal escapes, sorted query, no fragment, at least "/" as path.

    Text that is no absolute URL keeps its path and has its query sorted alike.
    """
    def path(text: Column) -> Column:
        segments = F.transform(F.split(text, "/"), lambda s: _normal_escapes(s, False))
        return F.when(text.rlike(r"[^A-Za-z0-9/._*!$&'()+,;=:@~-]"), F.array_join(segments, "/")).otherwise(text)

    def build(part: Column) -> Column:
        root = F.when(part["scheme"] != "", F.concat(F.lower(part["scheme"]), F.lit(":"))).otherwise(F.lit(""))
        host = F.when(part["authority"] != "", F.concat(F.lit("//"), F.lower(part["authority"]))).otherwise(F.lit(""))
        below = F.when((part["authority"] != "") & (part["path"] == ""), F.lit("/")).otherwise(path(part["path"]))
        query = let(_sorted_query(F.substr(part["query"], F.lit(2))), lambda q: F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q)))
        return F.concat(root, host, below, F.when(part["query"] == "", F.lit("")).otherwise(query))

    return F.when(url.rlike(PLAIN_URL), url).otherwise(let(url_parts(url), build))
