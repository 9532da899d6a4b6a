"""Removal of byte strings that occur earlier, by threshold-bounded interval expansion on Burrows-Wheeler transforms.

Every string of `length` bytes that also starts earlier (in an earlier text, or earlier in its own) is covered; what remains of a text are the
bytes that no such string covers. Texts are ordered by id (null first), texts of one id by a hash.

*Candidates.* A text is cut into segments: runs of starts whose windows of `length` bytes have the same smallest hash of a `gram`-byte
string in them. Equal windows have equal smallest hashes, wherever they stand, so they meet in that hash's bucket. A batch of texts keeps the first
place of segments of equal content; its other places are covered, as runs, and need no bucket. So however common a segment is, its bucket gets one
row a batch. In a bucket the same is done once more, and only first places whose bucket holds other contents, or whose own windows may repeat, go on.

*Expansion.* Whole buckets come together in blocks of about BLOCK_BYTES. A block's strings, a separator behind each, are sorted by suffix as deep as
needed, and the Burrows-Wheeler transform is taken. Starting from the intervals of single symbols, breadth-first backward extension finds the intervals of
longer strings, level by level; an interval whose right end is new gives that end its common prefix, the level, and is extended further.
Levels stop at `length`: ends without a value then lie inside strings of that many bytes, and what lies between two ends with a value
is one repeated string, whose first place is kept.

*Crowded buckets.* The segments at the edges of a passage that very many texts share differ, but fall into few buckets. Which these are
is seen on a sample of the texts (it decides where rows go, not what is found; no more than SHARES buckets a partition can be that large). Their
segments are cut anew by grams of `length` - 1 bytes: such a bucket holds at most one free byte on either side, 65,536 strings.

Hashes only choose where strings meet, but for one use: segments are equal when their bucket's 64-bit hash, a second one and their length are.
Texts of one id are told apart by a 64-bit hash.

Defined results: null texts are empty; texts shorter than `length` are kept; repeated rows of one id are copies of each other, one of them is
the first; an empty table gives no rows; only id and text are read, other columns may have any names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import ship
from pagetables.plans.workspace import new_folder, store

SAMPLE = 1 / 16
SHARES = 8
LEAST_CROWD = 48
BLOCK_BYTES = 1 << 20
# Bytes cut at a time; positions in a stretch must fit the low 24 bits of a key.
STRETCH = 1 << 21
SEGMENT_STARTS = 4096
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_PLACE = np.uint64((1 << 24) - 1)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2 ** 64, as many as asked for."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            inverse = pow(_BASE, -1, 1 << 64)
            cls.up, cls.down = (np.cumprod(np.array([1] + [b] * (size - 1), np.uint64), dtype=np.uint64) for b in (_BASE, inverse))
        return cls.up[:n], cls.down[:n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the `gram` bytes from every place on, by differences of one running sum."""
    n = len(data)
    up, down = _Powers.of(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)])
    found = (sums[gram:] - sums[: n - gram + 1]) * down[: n - gram + 1]
    for shift in (32, 29):
        found ^= found >> np.uint64(shift)
        found *= np.uint64(_MIX)
    return found ^ (found >> np.uint64(32))


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours."""
    step = 1
    while 2 * step <= width:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    rest = width - step
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


@dataclass
class Segments:
    text: np.ndarray  # number of the text
    start: np.ndarray  # in the text
    starts: np.ndarray  # how many windows begin in the segment
    bucket: np.ndarray
    again: np.ndarray  # whether a window may occur twice in it


def _cut_stretch(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of the texts data[begins:ends] as (place, starts, bucket, again)."""
    hashes = gram_hashes(data, gram)
    least = _smallest((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
    inside = np.zeros(len(least) + 1, np.int8)
    np.add.at(inside, begins, 1)
    np.add.at(inside, ends - length + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]))
    chosen = least[at]
    bucket = hashes[(chosen & _PLACE).astype(np.int64)]
    apart = np.ones(len(at), bool)
    apart[1:] = (bucket[1:] != bucket[:-1]) | (at[1:] != at[:-1] + 1)
    run = np.flatnonzero(apart)
    size = np.diff(run, append=len(at))
    if (size > SEGMENT_STARTS).any():
        run = np.concatenate([np.arange(r, r + n, SEGMENT_STARTS) for r, n in zip(run.tolist(), size.tolist())])
        size = np.diff(run, append=len(at))
    moved = np.cumsum(np.concatenate([[0], chosen[1:] != chosen[:-1]]))
    return at[run], size, bucket[run], moved[run + size - 1] != moved[run]


def cut(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Segments:
    """Segments of all texts of a batch; texts shorter than `length` have none. Long texts are cut in overlapping stretches."""
    parts, sizes = [], np.diff(offsets)
    pieces = []  # text, first byte, byte after the last
    for text in np.flatnonzero(sizes >= length).tolist():
        a, z = int(offsets[text]), int(offsets[text + 1])
        pieces += [(text, b, min(b + STRETCH + length - 1, z)) for b in range(a, z - length + 1, STRETCH)]
    i = 0
    while i < len(pieces):
        j = i + 1
        while j < len(pieces) and pieces[j][2] - pieces[i][1] <= STRETCH:
            j += 1
        text, begins, ends = (np.array(x, np.int64) for x in zip(*pieces[i:j]))
        low = begins[0]
        place, starts, bucket, again = _cut_stretch(data[low : ends[-1]], begins - low, ends - low, length, gram)
        owner = text[np.searchsorted(begins, place + low, side="right") - 1]
        parts.append((owner, place + low - offsets[owner], starts, bucket, again))
        i = j
    if not parts:
        empty = np.empty(0, np.int64)
        return Segments(empty, empty, empty, empty.astype(np.uint64), empty.astype(bool))
    return Segments(*(np.concatenate(x) for x in zip(*parts)))


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of the suffixes that begin there, compared over `depth` symbols at least. Symbols are below 512; zeros follow the end."""
    n, step = len(symbols), 7
    padded = np.concatenate([symbols, np.zeros(step, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(step):
        key = (key << 9) | padded[i : i + n]
    while True:
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], sorted_key[1:] != sorted_key[:-1]]))
        if step >= depth or rank[order[-1]] == n:
            return order
        key = rank * (n + 1)
        key[: n - step] += rank[step:] if step < n else 0
        step *= 2


def common_strings(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and for every place of it the number of its string of `length` symbols (places of equal strings share one).

    Symbol 0 separates texts. Numbers hold for places with no separator within `length` symbols.
    """
    n = len(symbols)
    order = suffix_order(symbols, length)
    before = symbols[order - 1]
    before[order == 0] = 0
    counts = np.bincount(symbols, minlength=1)
    first = np.concatenate([[0], np.cumsum(counts)])
    heads = np.repeat(np.arange(len(counts)), counts)
    onward = np.empty(n, np.int64)
    onward[np.argsort(before.astype(np.uint16), kind="stable")] = np.arange(n)

    prefix = np.full(n + 1, -1, np.int16)
    present = np.flatnonzero(counts)
    prefix[first[present]] = 0
    prefix[n] = 0
    low, high = first[present], first[present + 1]
    for level in range(1, length):
        size = high - low
        total = int(size.sum())
        if total == 0:
            break
        owner = np.repeat(np.arange(len(size)), size)
        rows = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + low[owner]
        extended = before[rows] != 0
        target, owner = onward[rows[extended]], owner[extended]
        if len(target) > n >> 3:
            held = np.full(n, -1, np.int64)
            held[target] = owner
            target = np.flatnonzero(held >= 0)
            owner = held[target]
        else:
            by_place = np.argsort(target)
            target, owner = target[by_place], owner[by_place]
        if len(target) == 0:
            break
        last = np.ones(len(target), bool)
        last[:-1] = (owner[1:] != owner[:-1]) | (heads[target[1:]] != heads[target[:-1]]) | (target[1:] != target[:-1] + 1)
        ends = np.flatnonzero(last)
        begins = np.concatenate([[0], ends[:-1] + 1])
        right = target[ends] + 1
        new = prefix[right] < 0
        prefix[right[new]] = level
        low, high = target[begins[new]], right[new]
    return order, np.cumsum(prefix[:n] >= 0)


def later_windows(texts: list[bytes], places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, start) of all windows that are equal to one of smaller place; `places` holds the place of each text's first byte."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    symbols = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8).astype(np.int64) + 1
    symbols[begins + sizes] = 0
    order, number = common_strings(symbols, length)
    text = np.repeat(np.arange(len(texts)), sizes + 1)[order]
    start = order - begins[text]
    whole = start + length <= sizes[text]
    text, start, number = text[whole], start[whole], number[whole]
    place = places[text] + start
    least = np.full(int(number[-1]) + 1 if len(number) else 1, np.iinfo(np.int64).max)
    np.minimum.at(least, number, place)
    later = place > least[number]
    return text[later], start[later]


def runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and sizes of the runs of consecutive numbers in a sorted array."""
    begins = np.flatnonzero(np.diff(starts, prepend=-2) != 1)
    return starts[begins], np.diff(begins, append=len(starts))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = column.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


# A segment's row: start, number of windows (at most 4096) and whether it may repeat itself, in one number; covered runs have a negative one.
_STARTS_BITS = 14
_ROW = "bucket long, content long, at long, mark long, packed long"


def _ranks(at: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Numbers of texts in order of id and hash; equal texts of one id share one."""
    order = np.lexsort((mark, at))
    new = np.concatenate([[0], (at[order][1:] != at[order][:-1]) | (mark[order][1:] != mark[order][:-1])])
    rank = np.empty(len(at), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def _cut_batch(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, crowded: np.ndarray) -> tuple[Segments, np.ndarray]:
    """Segments of a batch, those of crowded buckets cut anew, and a second hash of each one's content."""
    found, held = cut(data, offsets, length, gram), memoryview(data)
    if len(crowded) and (hot := np.isin(found.bucket, crowded)).any():
        text, start, size = found.text[hot], found.start[hot], found.starts[hot] + length - 1
        begin = offsets[text] + start
        joint = np.frombuffer(b"".join([held[a:z] for a, z in zip(begin.tolist(), (begin + size).tolist())]), np.uint8)
        anew = cut(joint, np.concatenate([[0], np.cumsum(size)]), length, length - 1)
        parts = Segments(text[anew.text], start[anew.text] + anew.start, anew.starts, anew.bucket, anew.again)
        found = Segments(*(np.concatenate([getattr(found, f)[~hot], getattr(parts, f)]) for f in Segments.__dataclass_fields__))
    begin = offsets[found.text] + found.start
    content = [xxhash.xxh3_64_intdigest(held[a:z]) for a, z in zip(begin.tolist(), (begin + found.starts + length - 1).tolist())]
    return found, np.array(content, np.uint64)


def _segments(texts: DataFrame, length: int, gram: int, crowded: np.ndarray) -> DataFrame:
    """The first places a batch of all segments of `texts` (at, mark, text), and its covered runs."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_of(batch.column(2))
            found, content = _cut_batch(data, offsets, length, gram, crowded)
            at, mark = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            place = (_ranks(at, mark)[found.text] << 40) + found.start
            order = np.lexsort((place, found.starts, content, found.bucket))
            b, c, n, p = found.bucket[order], content[order], found.starts[order], place[order]
            new = np.ones(len(order), bool)
            new[1:] = (b[1:] != b[:-1]) | (c[1:] != c[:-1]) | (n[1:] != n[:-1])
            first = order[new]
            packed = (found.start[first] << _STARTS_BITS) | (found.starts[first] << 1) | found.again[first]
            owner = found.text[first]
            yield _rows(b[new].view(np.int64), c[new].view(np.int64), at[owner], mark[owner], packed)
            later = order[p > p[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]]
            later = later[np.argsort(place[later], kind="stable")]
            begin, size = place[later], found.starts[later]
            if len(later):
                joined = np.concatenate([[True], begin[1:] > (begin + size)[:-1]])
                run = np.flatnonzero(joined)
                owner, start = found.text[later[run]], found.start[later[run]]
                reach = np.maximum.reduceat(begin + size, run) - begin[run]
                yield _rows((start ^ mark[owner]) * 0x5851F42D, reach, at[owner], mark[owner], (-1 - start))

    return texts.select("at", "mark", F.col("text").cast("binary")).mapInArrow(emit, _ROW)


def _rows(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["bucket", "content", "at", "mark", "packed"])


def _crowded_buckets(texts: DataFrame, length: int, gram: int) -> np.ndarray:
    """Buckets that would hold much of a partition, by the distinct contents of a sample. Their number is bounded by that of the partitions."""
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sampled = _segments(texts.sample(SAMPLE, seed=7), length, gram, np.empty(0, np.uint64)).filter("packed >= 0")
    counts = sampled.groupBy("bucket", "content").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = max(LEAST_CROWD, total / (SHARES * partitions))
    found = counts.filter(F.col("n") > most).collect()
    return np.sort(np.array([r.bucket for r in found], np.int64).view(np.uint64))


def _met(segments: DataFrame) -> DataFrame:
    """What buckets show: covered places (bucket null) and contested first places, as (bucket, at, mark, start, starts)."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "at", "mark", "start", "starts"]

        def rows(covered: list[np.ndarray], contested: list[np.ndarray]) -> pa.RecordBatch:
            nothing = len(covered[0])
            bucket = pa.array(np.concatenate([np.zeros(nothing, np.int64), contested[0]]), mask=np.arange(nothing + len(contested[0])) < nothing)
            return pa.RecordBatch.from_arrays([bucket, *(pa.array(np.concatenate(x)) for x in zip(covered, contested[1:]))], names=names)

        def settle(b: np.ndarray, c: np.ndarray, at: np.ndarray, mark: np.ndarray, packed: np.ndarray) -> pa.RecordBatch:
            """Rows of whole buckets in order of bucket, content and place."""
            start, starts, again = packed >> _STARTS_BITS, (packed >> 1) & ((1 << (_STARTS_BITS - 1)) - 1), packed & 1
            apart = np.ones(len(b), bool)
            apart[1:] = b[1:] != b[:-1]
            new = apart.copy()
            new[1:] |= (c[1:] != c[:-1]) | (starts[1:] != starts[:-1])
            head = np.maximum.accumulate(np.where(new, np.arange(len(b)), 0))
            later = (at != at[head]) | (mark != mark[head]) | (start != start[head])
            number = np.cumsum(apart) - 1
            contested = (np.bincount(number, new) > 1) | (np.bincount(number, again) > 0)
            kept = new & contested[number]
            return rows([x[later] for x in (at, mark, start, starts)], [x[kept] for x in (b, at, mark, start, starts)])

        held = [np.empty(0, np.int64)] * 5
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            runs_here = columns[4] < 0
            if runs_here.any():
                _, n, at, mark, packed = (x[runs_here] for x in columns)
                yield rows([at, mark, -1 - packed, n], [np.empty(0, np.int64)] * 5)
                columns = [x[~runs_here] for x in columns]
            held = [np.concatenate(x) for x in zip(held, columns)]
            if not len(held[0]):
                continue
            whole = int(np.searchsorted(held[0], held[0][-1]))
            if whole:
                yield settle(*(x[:whole] for x in held))
                held = [x[whole:] for x in held]
        if len(held[0]):
            yield settle(*held)

    # Content stands before starts in `packed`'s order only through equal contents, whose starts are equal, too.
    dealt = segments.repartition("bucket").sortWithinPartitions("bucket", "content", "at", "mark", "packed")
    return dealt.mapInArrow(meet, "bucket long, at long, mark long, start long, starts long")


def _with_content(contested: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """(bucket, at, mark, start, text) of contested places: the bytes of their windows, taken from the texts."""
    asked = contested.groupBy("at", "mark").agg(F.collect_list(F.struct("bucket", "start", "starts")).alias("asked"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_of(batch.column(2))
            lists, at, mark = batch.column(3), *(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            flat, text, held = lists.flatten(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), memoryview(data)
            for a in range(0, len(flat), 50_000):
                part, owner = flat.slice(a, 50_000), text[a : a + 50_000]
                start = part.field(1).to_numpy()
                low = offsets[owner] + start
                high = low + part.field(2).to_numpy() + length - 1
                content = pa.array([bytes(held[x:y]) for x, y in zip(low.tolist(), high.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([part.field(0), pa.array(at[owner]), pa.array(mark[owner]), pa.array(start), content], names=["bucket", "at", "mark", "start", "text"])

    joined = texts.join(asked, ["at", "mark"]).select("at", "mark", F.col("text").cast("binary").alias("text"), "asked")
    return joined.mapInArrow(take, "bucket long, at long, mark long, start long, text binary")


def _expand(entries: DataFrame, length: int) -> DataFrame:
    """(at, mark, start, starts) of the windows of contested strings (bucket, at, mark, start, text) that are equal to one of smaller place."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size, last = 0, None

        def block() -> pa.RecordBatch:
            *keys, texts = zip(*held)
            at, mark, start = (np.array(k, np.int64) for k in keys)
            text, window = later_windows(list(texts), (_ranks(at, mark) << 40) + start, length)
            # Keyed by text, so that runs do not go on from one text to the next.
            wide = max(map(len, texts)) + 2
            first, n = runs(np.sort(text * wide + window))
            owner = first // wide
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (at[owner], mark[owner], start[owner] + first % wide, n)], names=["at", "mark", "start", "starts"])

        for batch in batches:
            for bucket, *entry in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if size >= BLOCK_BYTES and bucket != last:
                    yield block()
                    held, size = [], 0
                held.append(tuple(entry))
                size += len(entry[3])
                last = bucket
        if held:
            yield block()

    dealt = entries.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(search, "at long, mark long, start long, starts long")


def _stored_texts(docs: DataFrame, doc_id: str, text: str, folder: str) -> str:
    """The table (doc_id, at, mark, text) of all documents, bucketed by what identifies them, so that texts move once."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    at = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), at.alias("at"), F.xxhash64(content).alias("mark"), content.alias("text"))
    table, buckets = f"repeats_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.repartition(buckets, "at", "mark").write.bucketBy(buckets, "at", "mark")
    writer.option("path", f"{folder}/texts").option("compression", "zstd").saveAsTable(table)
    return table


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100, gram: int = 32) -> DataFrame:
    """One row a document: doc_id, n_bytes, spans (removed runs of bytes: start, end) and kept (the remaining bytes)."""
    if not 0 < gram < length:
        raise ValueError("gram must be shorter than length")
    spark = docs.sparkSession
    ship(spark)
    folder = new_folder(spark, "repeats")
    table = _stored_texts(docs, doc_id, text, folder)
    try:
        texts = spark.table(table)
        long = texts.filter(F.octet_length("text") >= length)
        met = store(_met(_segments(long, length, gram, _crowded_buckets(long, length, gram))), f"{folder}/met")
        places = ["at", "mark", "start", "starts"]
        expanded = _expand(_with_content(met.filter(F.col("bucket").isNotNull()), long, length), length)
        covered = met.filter(F.col("bucket").isNull()).select(places).unionByName(expanded)
        repeated = texts.groupBy("at", "mark").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
        span = F.when(F.col("starts").isNotNull(), F.struct("start", "starts"))
        told = covered.withColumn("times", F.lit(1).cast("long")).unionByName(repeated, allowMissingColumns=True)
        by_text = told.groupBy("at", "mark").agg(F.collect_list(span).alias("covered"), F.max("times").alias("times"))
        known = texts.join(store(by_text, f"{folder}/covered"), ["at", "mark"], "left")
        several = F.coalesce("times", F.lit(1)) > 1
        heads = known.filter(several).dropDuplicates(["at", "mark"])
        cleaned = _cleaned(known.filter(~several).drop("times").unionByName(heads.drop("times")), length)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    n, is_long = F.octet_length("text").cast("long"), F.octet_length("text") >= length
    whole, none = F.array(F.struct(F.lit(0).cast("long").alias("start"), n.alias("end"))), F.array().cast("array<struct<start:bigint,end:bigint>>")
    copies = heads.withColumn("copy", F.explode(F.sequence(F.lit(2).cast("long"), F.col("times"))))
    return cleaned.unionByName(copies.select(
        "doc_id", n.alias("n_bytes"), F.when(is_long, whole).otherwise(none).alias("spans"), F.when(is_long, F.lit(b"")).otherwise(F.col("text")).alias("kept")))


def _cleaned(texts: DataFrame, length: int) -> DataFrame:
    """doc_id, n_bytes, spans, kept of texts with the covered windows (start, starts) of each."""
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_of(batch.column(1))
            held, lists = memoryview(data), batch.column(2)
            begins, flat = lists.offsets.to_numpy(), lists.flatten()
            first, size = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            spans, kept = [], []
            for i, (a, z) in enumerate(zip(begins - begins[0], begins[1:] - begins[0])):
                low, high = int(offsets[i]), int(offsets[i + 1])
                found = merged(first[a:z], first[a:z] + size[a:z] + length - 1)
                spans.append([{"start": s, "end": e} for s, e in found])
                edges = [0, *(x for span in found for x in span), high - low]
                kept.append(b"".join(held[low + x : low + y] for x, y in zip(edges[::2], edges[1::2])))
            columns = [batch.column(0), pa.array(np.diff(offsets)), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept"])

    id_type = texts.schema["doc_id"].dataType.simpleString()
    empty = F.array().cast("array<struct<start:bigint,starts:bigint>>")
    asked = texts.select("doc_id", F.col("text").cast("binary").alias("text"), F.coalesce("covered", empty).alias("covered"))
    return asked.mapInArrow(clean, f"doc_id {id_type}, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary")


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Runs that cover the same as the given ones, in order, none touching the next."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return list(zip(starts[at].tolist(), reach[np.concatenate([at[1:] - 1, [len(starts) - 1]])].tolist()))
