"""Merkle fingerprints of texts: blocks of words under paragraphs under sections under one root.

A paragraph is a line with its line end. Its leaves are blocks of words (of at most 64 characters each, longer ones are
cut) with the white space around them, so that every character is in a leaf. A block ends after a word that ends in one of
BLOCK_ENDS, at the latest after 16 words: boundaries follow content, and a word inserted into a line moves no block but its
own. The first 16 words of a text are a leaf each, so that short texts have leaves to share. A section ends after an empty
line, or after a paragraph whose hash starts with 1 or 2, so an insertion moves no other section either.

Written form: `root/section;section`, a section is `hash=paragraph,paragraph`, a paragraph `hash:leaf.leaf`. Every hash
covers what stands under it; the root is SHA-256, the others are 64-bit. Equal roots mean equal texts, and the differing
branches say where two texts differ (`changed_paragraphs`).

All is native. Null texts are empty; the empty text has a root and no section. Texts are read whole. Repeated rows are
fingerprinted alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import free_name

BLOCK_ENDS = "dgkp.?!"
BLOCK = rf"\s*+(?:\S{{1,64}}+\s*+){{1,15}}?(?<=[{BLOCK_ENDS}]\s)|\s*+(?:\S{{1,64}}+\s*+){{1,16}}+|\s++"
HEAD = r"^\s*+(?:\S{1,64}+\s*+){1,16}+"
WORD = r"\s*+\S{1,64}+\s*+"
BUCKET_ROWS = 500
MAX_BUCKETS = 65_536
SAMPLED = 8  # sampled keys a bucket
_CHUNK = 256


def _hash(text: Column) -> Column:
    return F.lower(F.hex(F.xxhash64(text)))


def fingerprint(text: Column) -> Column:
    paragraphs = F.filter(F.split(text, r"(?<=\n)"), lambda p: p != "")
    leaves = F.transform(paragraphs, lambda p, i: F.array_join(F.transform(F.when(i == 0, _opening(p)).otherwise(_blocks(p)), _hash), "."))
    hashed = F.transform(leaves, lambda ls: F.concat(_hash(ls), F.lit(":"), ls))
    blank = _blank_leaf()
    ended = F.transform(hashed, lambda p: F.concat(p, F.when(p.rlike("^[12]") | (p == blank), F.lit(";")).otherwise(F.lit(","))))
    sections = F.transform(F.filter(F.split(F.array_join(ended, ""), ";"), lambda s: s != ""), lambda s: F.rtrim(s, F.lit(",")))
    body = F.array_join(F.transform(sections, lambda s: F.concat(_hash(s), F.lit("="), s)), ";")
    return F.aggregate(F.array(body), F.lit(""), lambda _, b: F.concat(F.sha2(b.cast("binary"), 256), F.lit("/"), b))


def _blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(BLOCK), F.lit(0))


def _opening(paragraph: Column) -> Column:
    """The blocks of a text's first paragraph."""
    head = F.regexp_extract(paragraph, HEAD, 0)
    return F.concat(F.regexp_extract_all(head, F.lit(WORD), F.lit(0)), _blocks(F.substring(paragraph, F.char_length(head) + 1, F.char_length(paragraph))))


def _blank_leaf() -> Column:
    """The paragraph of a line end alone."""
    leaf = _hash(F.lit("\n"))
    return F.concat(_hash(leaf), F.lit(":"), leaf)


def root(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, "/", 1)


def leaf_hashes(fingerprint: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(fingerprint, F.lit("[:.]([0-9a-f]++)"), F.lit(1)))


def likeness(a: Column, b: Column) -> Column:
    """Shared leaves of two fingerprints: twice the common ones over the sum of both, distinct leaves counted; 1 for equal roots."""
    def share(left: Column, right: Column) -> Column:
        return 2.0 * F.size(F.array_intersect(left, right)) / (F.size(left) + F.size(right))

    pair = F.array(F.struct(leaf_hashes(a).alias("a"), leaf_hashes(b).alias("b")))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(F.element_at(F.transform(pair, lambda p: share(p["a"], p["b"])), 1))


def changed_paragraphs(a: Column, b: Column) -> Column:
    """Positions (from 0) of the paragraphs of `a` that no section or paragraph of `b` holds; sections that `b` holds are not looked into."""
    def sections(f: Column) -> Column:
        return F.filter(F.split(F.substring_index(f, "/", -1), ";"), lambda s: s != "")

    def paragraphs(section: Column) -> Column:
        return F.split(F.substring_index(section, "=", -1), ",")

    known_sections = F.transform(sections(b), lambda s: F.substring_index(s, "=", 1))
    known = F.transform(F.flatten(F.transform(sections(b), paragraphs)), lambda p: F.substring_index(p, ":", 1))
    flags = F.flatten(F.transform(sections(a), lambda s: F.transform(paragraphs(s), lambda p: ~(
        F.array_contains(known_sections, F.substring_index(s, "=", 1)) | F.array_contains(known, F.substring_index(p, ":", 1))))))
    return F.filter(F.transform(flags, lambda changed, i: F.when(changed, i)), lambda i: i.isNotNull())


def with_next(rows: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """`rows` with `next_<column>` of the row that follows in descending `key`, after the last the first again.

    No global window: keys fall into buckets of about BUCKET_ROWS rows, between bounds that are keys of a sample of the rows
    (SAMPLED keys a bucket, MAX_BUCKETS buckets at most), so that no gap or outlier among the keys crowds a bucket; the sample decides
    where rows meet, not what follows what. The first row of each bucket is sent to the bucket before it, too. Rows move
    once. Null keys come last; rows of equal key stand in one bucket and are ordered by a hash of what they carry.
    """
    top, n = rows.agg(F.max(key), F.count(key)).first()
    buckets = max(1, min(MAX_BUCKETS, -(-n // BUCKET_ROWS)))
    bounds: list[int] = []
    if buckets > 1:
        seen = sorted(r[0] for r in rows.select(key).dropna().sample(min(1.0, SAMPLED * buckets / n), seed=1).collect())
        bounds = sorted({seen[len(seen) * i // buckets] for i in range(1, buckets)} - {top}) if seen else []

    def listed(values: list[int]) -> Column:
        # one literal, folded when planned
        return (F.split(F.lit(",".join(map(str, values))), ",") if values else F.array()).cast("array<bigint>")

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < F.col(key)))

    # Bounds below the key: whole chunks first, then those of the chunk where the key falls.
    chunks = below(listed(bounds[_CHUNK - 1 :: _CHUNK])) * _CHUNK
    near = F.slice(listed(bounds), chunks + 1, F.lit(_CHUNK))
    bucket, mix, place, guest = (free_name(rows, name) for name in ("bucket", "mix", "place", "guest"))
    in_bucket = rows.withColumn(bucket, F.lit(len(bounds)) - chunks - below(near)).withColumn(mix, F.xxhash64(*carried))
    first = F.coalesce(F.array_contains(near, F.col(key)), F.lit(False)) | F.col(key).eqNullSafe(F.lit(top))
    before = F.when(F.col(bucket) == 0, len(bounds)).otherwise(F.col(bucket) - 1)
    places = F.array_compact(F.array(
        F.struct(F.col(bucket).alias("bucket"), F.lit(False).alias("guest")),
        F.when(first, F.struct(before.alias("bucket"), F.lit(True).alias("guest"))),
    ))
    placed = in_bucket.withColumn(place, F.explode(places)).withColumn(bucket, F.col(place)["bucket"]).withColumn(guest, F.col(place)["guest"])
    order = Window.partitionBy(bucket).orderBy(guest, F.desc_nulls_last(key), mix)
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in carried]
    return placed.select("*", *following).filter(~F.col(guest)).drop(bucket, mix, place, guest)


def edited_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside a text whose last third is replaced by the beginning of the next one, with both fingerprints."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("fingerprint", fingerprint(F.col("text")))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    return with_next(rows, "doc_id", ["text", "fingerprint"]).select(
        "doc_id", "text", "fingerprint", "next_fingerprint", n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)).alias("edited"),
    )
