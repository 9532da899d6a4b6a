"""JSON-LD metadata and embedded keyword lists, read from page source without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetables.functions.presence import variant_text, variant_truthy
from pagetables.functions.text import first_nonempty, let, nonempty

# Where scripts of the JSON-LD type stand in page source. Comments (an open one runs
# to the end of the page) and other scripts are consumed first, so that look-alikes inside them do not count; only a wanted script fills the group.
JSON_LD_TYPE = "application/ld+json"
JSON_LD_PATTERN = (
    r"(?s)<(?:!--.*?(?:-->|\z)"
    r"|(?i:script)\s(?:[^>]*\s)?(?i:type)\s*=\s*(?:\"application/ld\+json\"|'application/ld\+json'|application/ld\+json(?=[\s>]))"
    r"[^>]*>(.*?)(?:</(?i:script)|\z)"
    r"|(?i:script)\b.*?(?:</(?i:script)|\z))"
)
KEYWORDS_PATTERN = r'"keywords":(?U:\s*)(\[[^\]]+\])'

JSON_LD_FIELDS = ("datePublished", "dateModified", "author", "articleSection", "image_url")


def json_ld_scripts(html: Column) -> Column:
    """Bodies of the JSON-LD scripts in document order; pages without the type name are not searched."""
    bodies = F.filter(F.regexp_extract_all(html, F.lit(JSON_LD_PATTERN), F.lit(1)), lambda s: s != "")
    return F.when(F.contains(html, F.lit(JSON_LD_TYPE)), bodies).otherwise(F.array().cast("array<string>"))


def _member(node: Column, path: str) -> Column:
    return F.try_variant_get(node, path, "variant")


def _script_nodes(script: Column) -> Column:
    """The members of @graph, or the document itself; unreadable scripts and a @graph that is no list give nothing."""

    def nodes(doc: Column) -> Column:
        graph = F.try_variant_get(doc, "$['@graph']", "array<variant>")
        return (
            F.when(_member(doc, "$['@graph']").isNotNull(), F.coalesce(graph, F.array().cast("array<variant>")))
            .when(doc.isNotNull(), F.array(doc))
            .otherwise(F.array().cast("array<variant>"))
        )

    return let(F.try_parse_json(script), nodes)


def _author(node: Column) -> Column:
    return F.coalesce(_member(node, "$.author.name"), _member(node, "$.author[0].name"))


def _image(node: Column) -> Column:
    image = _member(node, "$.image")
    return F.coalesce(_member(node, "$.image.url"), F.when(F.schema_of_variant(image) == "STRING", image))


_READERS = {
    "datePublished": lambda node: _member(node, "$.datePublished"),
    "dateModified": lambda node: _member(node, "$.dateModified"),
    "author": _author,
    "articleSection": lambda node: _member(node, "$.articleSection"),
    "image_url": _image,
}


def _usable_types(field: str) -> tuple[str, ...]:
    # A list of texts stands for its first member, but a date must be a single text.
    return ("STRING",) if field == "datePublished" else ("STRING", "ARRAY<STRING>")


def json_ld_metadata(scripts: Column) -> Column:
    """STRUCT of the five fields, all STRING, plus `bad_types`: the fields whose value is no usable text.

    Scripts are read in document order; per field the first value that is not null, empty, zero or false wins.
    """

    def fields(nodes: Column) -> Column:
        return F.struct(*[
            F.get(F.filter(F.transform(nodes, reader), variant_truthy), 0).alias(name)
            for name, reader in _READERS.items()
        ])

    def texts(picked: Column) -> Column:
        def text(name: str) -> Column:
            value = picked[name]
            listed = F.when(
                (F.schema_of_variant(value) == "ARRAY<STRING>") & F.lit(name != "datePublished"),
                first_nonempty(F.try_variant_get(value, "$", "array<string>")),
            )
            return F.coalesce(variant_text(value), listed)

        bad = [
            F.when(picked[name].isNotNull() & ~F.schema_of_variant(picked[name]).isin(*_usable_types(name)), F.lit(name))
            for name in JSON_LD_FIELDS
        ]
        return F.struct(*[text(name).alias(name) for name in JSON_LD_FIELDS], F.array_compact(F.array(*bad)).alias("bad_types"))

    nodes = F.flatten(F.transform(scripts, _script_nodes))
    return let(let(nodes, fields), texts)


def json_list_text(list_text: Column) -> Column:
    """Join the truthy members of a JSON list by ', '; null when the text is not a JSON list."""

    def member(value: Column) -> Column:
        return F.coalesce(
            variant_text(value),
            F.when(F.schema_of_variant(value) == "BOOLEAN", F.lit("True")),
            F.to_json(value),
        )

    values = F.filter(F.try_variant_get(F.try_parse_json(list_text), "$", "array<variant>"), variant_truthy)
    return F.array_join(F.transform(values, member), ", ")


def page_keywords(meta_keywords: Column, html: Column) -> Column:
    """The keywords meta text as it stands, else the first "keywords":[...] list in the page source."""
    return F.coalesce(nonempty(meta_keywords), nonempty(json_list_text(F.regexp_extract(html, KEYWORDS_PATTERN, 1))))
