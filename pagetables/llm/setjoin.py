"""Size-aware heavy-light join: texts whose sets of word shingles have a Jaccard likeness of at least a threshold.

A text's set holds 64-bit hashes of its distinct shingles. Texts of equal sets (by 63 bits of a hash) form a class, and one member stands for it. Two
sets of sizes s and t link when they share at least o(s, t) = ceil(theta / (1 + theta) * (s + t)) shingles.

Light sets (up to a boundary) enumerate their subsets of exactly o(s, t) shingles, for all partner sizes t: sets that share such a
subset link by that alone. Heavy sets are found by inverted lists. A list for a single shingle would hold every text with a
common passage, so the shingles are dealt by hash into more parts than linked sets can have differences, and the lists are
keyed by the content of a part: linked sets agree on at least one part, unrelated ones hardly ever do. Parts are counted by
size range; a set is listed in its own range and, where partners may lie there, in the next. Sets with many empty parts list
these, too, so that nothing is lost. The boundary between light and heavy is the one of least cost, from the sizes of all classes.

Lists are searched without making all pairs of a group. First each member is compared with its list's most typical member
only, by their sketches and then, if these allow a link, by their whole sets; what links is one component. Only members that are then still in different components are compared with each other. Their
sketches come first, too: the parities of a set's shingles by hash cell. Two sketches differ in no more cells than the sets do in shingles, so
that lists shrink to members whose sketches are near, without losing a link, before any whole set moves.
Every candidate is checked on the whole sets, so the links are exact (up to collisions of 64-bit hashes).

That gives the components, but not all links inside them. As links never leave a component, their number is counted there: all sets of
a component are compared with each other, whole and blockwise, and each class gets the number of classes it links with. Pairs stay in the task.

Defined results: null texts and texts without words have an empty set and link with nothing; texts with fewer words than a shingle have
one shingle, the whole. Repeated rows and equal texts link; null ids are members like others and come after all ids. Other
columns are not read. Intermediate tables lie in `folder`; what the results do not read is deleted. Keys go from the texts straight to the lists
and are never stored, and most are alone in theirs and end there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import at_work, free_name, ship, text_or_empty
from pagetables.plans.workspace import delete_folder, store

SLACK = 3
RANGE_PERCENT = 80  # size ranges grow by 100 / 80, or by 100 / percent where that is more: partners then lie in neighbouring ranges
BLOCK = 1024  # members of a list that a task compares at once
LINK_BLOCK = 2048  # classes of a component that a task holds of each side when it counts links,
LINK_TOKENS = 2**20  # and their shingles
LIGHT_LIMIT = 64  # sizes above are always heavy: their subsets are too many to be worth a thought
SEEN_CLASSES = 500_000  # that a task knows the last of, so that their copies are not listed again
CHECK_COST = 8  # of checking a candidate that a part's list may bring, in emitted keys


_WORD_HASHES: dict[bytes, int] = {}


def shingle_set(text: str, words_each: int = 3) -> np.ndarray:
    """Sorted distinct shingle hashes. Words are runs of anything but ASCII white space; A-Z are lower-cased."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < words_each:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], dtype=np.uint64)
    if len(_WORD_HASHES) > 150_000:
        _WORD_HASHES.clear()
    for w in set(words).difference(_WORD_HASHES):
        _WORD_HASHES[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(_WORD_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    n = len(h) - words_each + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(words_each):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out)


def sums_by(cell: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit values by cell, modulo 2 ** 64; the halves are summed exactly as doubles."""
    low = np.bincount(cell, weights=(values & np.uint64(0xFFFFFFFF)).astype(float), minlength=n)
    high = np.bincount(cell, weights=(values >> np.uint64(32)).astype(float), minlength=n)
    return low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def sketch(tokens: np.ndarray) -> bytes:
    """A bit a cell: whether it holds an odd number of shingles. A power of two of cells, two a shingle or more."""
    cells = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    at = mixed(tokens ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(cells - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=cells) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """The sketch with fewer cells, of `size` bytes."""
    out = np.frombuffer(bits, dtype=np.uint8)
    while len(out) > size:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def near_parts(sketches: list[bytes], sizes: np.ndarray, groups: np.ndarray, percent: int, split: int) -> np.ndarray:
    """For each member the number of the part it is in, -1 for none: parts are what pairs of different groups whose sketches allow a link connect.

    With `split` the members are in two blocks and only pairs across count (0: all pairs).
    """
    n, width = len(sketches), min(map(len, sketches))
    bits = np.unpackbits(np.stack([folded(x, width) for x in sketches]), axis=1).astype(np.float32)
    ones = bits.sum(axis=1)
    top = split or n
    apart = ones[:top, None] + ones[None, split:] - 2 * (bits[:top] @ bits[split:].T)  # counts below 2 ** 24 are exact
    total = sizes[:top, None] + sizes[None, split:]
    near = (apart <= total - 2 * -(-percent * total // (100 + percent))) & (groups[:top, None] != groups[None, split:])
    left, right = np.nonzero(near)
    right = right + split
    label = np.arange(n)
    while True:
        low, new = np.minimum(label[left], label[right]), label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        if (new == label).all():
            break
        label = new[new]
    out = np.full(n, -1)
    out[left], out[right] = label[left], label[right]
    return out


def needed(s: int, t: int, percent: int) -> int:
    """The least overlap of linked sets of sizes s and t."""
    return -(-percent * (s + t) // (100 + percent))


def partner_sizes(s: int, percent: int) -> range:
    return range(-(-s * percent // 100), s * 100 // percent + 1)


def subset_sizes(s: int, percent: int, boundary: int) -> list[int]:
    """Overlaps that a light set enumerates, by partners up to the boundary."""
    return sorted({o for t in partner_sizes(s, percent) if t <= boundary and (o := needed(s, t, percent)) <= min(s, t)})


class Ranges:
    """Size ranges with their number of parts."""

    def __init__(self, percent: int, largest: int):
        self.percent, self.starts = percent, [1]
        while self.starts[-1] <= largest:
            self.starts.append(self.starts[-1] * 100 // min(percent, RANGE_PERCENT) + 1)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def differences(self, i: int) -> int:
        """The most shingles in which linked sets can differ, the larger one being of this range."""
        total = 2 * (self.starts[i + 1] - 1)
        return total * (100 - self.percent) // (100 + self.percent)

    def listed(self, size: int) -> list[int]:
        own = self.of(size)
        return [own, own + 1] if size * 100 // self.percent >= self.starts[own + 1] else [own]

    def slack(self, i: int) -> int:
        """Parts beyond one more than the differences: so many that hardly any set of the range has as many empty parts."""
        n = self.differences(i) + 1
        expected = n * math.exp(-self.starts[i] / n)
        return SLACK + math.ceil(2.5 * expected + 3 * math.sqrt(expected))

    def parts(self, i: int) -> int:
        return self.differences(i) + 1 + self.slack(i)


def light_keys(tokens: np.ndarray, percent: int, boundary: int) -> list[tuple[int, int]]:
    """(subset size, hash) of the enumerated subsets. A subset's hash is the sum of its members' mixed hashes."""
    values = mixed(tokens)
    whole = values.sum(dtype=np.uint64)
    keys = []
    for o in subset_sizes(len(tokens), percent, boundary):
        gone = len(tokens) - o
        left = [whole - sum(c, np.uint64(0)) for c in combinations(values, gone)] if gone else [whole]
        keys += [(o, int(k)) for k in mixed(np.array(left, dtype=np.uint64) + np.uint64(o))]
    return keys


def heavy_keys(tokens: np.ndarray, ranges: Ranges) -> list[tuple[int, np.ndarray]]:
    """For each size range that lists the set: the range, and the keys of its parts."""
    out = []
    values = mixed(tokens ^ np.uint64(0x5851F42D4C957F2D))
    for i in ranges.listed(len(tokens)):
        n = ranges.parts(i)
        part = (tokens % np.uint64(n)).astype(np.int64)
        filled = np.bincount(part, minlength=n) > 0
        # Sets that agree on empty parts only have more of them in common than the slack.
        kept = filled if (~filled).sum() <= ranges.slack(i) else np.ones(n, dtype=bool)
        at = np.flatnonzero(kept).astype(np.uint64)
        keys = mixed(sums_by(part, values, n)[kept] + mixed(at * np.uint64(4096) + np.uint64(i)))
        out.append((i, keys))
    return out


def light_cost(s: int, percent: int) -> float:
    return float(sum(math.comb(s, s - o) for o in subset_sizes(s, percent, LIGHT_LIMIT + LIGHT_LIMIT // 4)))


def choose_boundary(sizes: dict[int, int], percent: int) -> int:
    """The light-heavy boundary of least total cost for a histogram of set sizes."""
    ranges = Ranges(percent, LIGHT_LIMIT * 2)

    def heavy_cost(s: int) -> float:
        return (1.0 + CHECK_COST) * sum(ranges.parts(i) for i in ranges.listed(s))

    small = {s: n for s, n in sizes.items() if 0 < s <= LIGHT_LIMIT}
    best, boundary, cost = 0.0, 0, 0.0
    for s in range(1, LIGHT_LIMIT + 1):
        cost += small.get(s, 0) * (light_cost(s, percent) - heavy_cost(s))
        if cost < best:
            best, boundary = cost, s
    return boundary


# --- the join -----------------------------------------------------------------------------------------------------


def _as_long(keys) -> np.ndarray:
    return np.asarray(keys, dtype=np.uint64).view(np.int64)


def set_class(tokens: np.ndarray) -> int:
    """The number of the class of a set: 63 bits of its hash."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) >> 1


def set_digests(docs: DataFrame, doc_id: str, text: str, words_each: int) -> DataFrame:
    """doc_id, size, class and sketch of the set; class and sketch are null for an empty set."""
    ship(docs.sparkSession)

    @F.arrow_udf("struct<size:long,class:long,sketch:binary>")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at_work("setjoin", _WORD_HASHES.clear)
        for batch in batches:
            sets = (shingle_set(t, words_each) for t in batch.to_pylist())
            rows = [(len(s), set_class(s), sketch(s)) if len(s) else (0, None, None) for s in sets]
            columns = list(zip(*rows)) or [()] * 3
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()))], ["size", "class", "sketch"])

    found = docs.select(F.col(doc_id).alias("doc_id"), digest.asNondeterministic()(text_or_empty(text)).alias("d"))
    return found.select("doc_id", "d.size", "d.class", "d.sketch")


def _keys(docs: DataFrame, words_each: int, percent: int, boundary: int, ranges: Ranges):
    """Column -> Column: class, and the keys of the lists of a text's set. Of the copies of a set that a task comes by only the first has keys;
    after `SEEN_CLASSES` classes it begins anew.
    """
    smallest_heavy_partner = -(-(boundary + 1) * percent // 100)

    @F.arrow_udf("struct<class:long,keys:array<long>>")
    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at_work("setjoin", _WORD_HASHES.clear)
        seen: set[int] = set()
        for batch in batches:
            classes, lists = [], []
            for t in batch.to_pylist():
                tokens = shingle_set(t, words_each)
                n, number = len(tokens), set_class(tokens)
                row = [np.zeros(0, dtype=np.uint64)]
                if number not in seen:
                    if len(seen) >= SEEN_CLASSES:
                        seen.clear()
                    seen.add(number)
                    if 0 < n <= boundary:
                        row.append(np.array([key for _, key in light_keys(tokens, percent, boundary)], dtype=np.uint64))
                    if n and n >= smallest_heavy_partner:
                        row += [found for _, found in heavy_keys(tokens, ranges)]
                classes.append(number)
                lists.append(_as_long(np.concatenate(row)))
            yield pa.StructArray.from_arrays([pa.array(classes, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], ["class", "keys"])

    return keys.asNondeterministic()


def _sets(docs: DataFrame, words_each: int):
    """Column -> Column: class and packed set of a text."""
    @F.arrow_udf("struct<class:long,tokens:binary>")
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at_work("setjoin", _WORD_HASHES.clear)
        for batch in batches:
            found = [shingle_set(t, words_each) for t in batch.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array(map(set_class, found), pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], ["class", "tokens"])

    return sets.asNondeterministic()


def sketches_near(a: bytes, b: bytes, s: int, t: int, percent: int) -> bool:
    """Whether the sketches of sets of sizes s and t allow a link: they differ in no more cells than the sets do in shingles."""
    width = min(len(a), len(b))
    apart = int.from_bytes((folded(a, width) ^ folded(b, width)).tobytes(), "little").bit_count()
    return apart <= s + t - 2 * needed(s, t, percent)


def _near(percent: int):
    """Columns -> Column: whether two sketches allow a link of their sets, whose sizes follow."""
    @F.arrow_udf("boolean")
    def near(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            yield pa.array([sketches_near(*row, percent) for row in zip(*(c.to_pylist() for c in columns))], pa.bool_())

    return near.asNondeterministic()


def _linked(docs: DataFrame, percent: int):
    """Columns -> Column: whether two packed sets link."""
    @F.arrow_udf("boolean")
    def linked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = []
            for a, b in zip(left, right):
                x, y = np.frombuffer(a.as_buffer(), dtype=np.uint64), np.frombuffer(b.as_buffer(), dtype=np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.array(out, pa.bool_())

    return linked.asNondeterministic()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """node, component (its smallest node) of every node in edges (a, b). Levels are written to `folder`.

    Each round sets a node's label to the smallest label around it, then to that label's own label, which halves paths.
    """
    both = store(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), f"{folder}/edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), f"{folder}/0")
    for level in range(1, 1000):
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        new = store(low.join(up, "label", "left").select("node", F.least("label", F.coalesce("higher", "label")).alias("label"), "was"), f"{folder}/{level}")
        if new.filter("label < was").isEmpty():
            break
        labels = new.select("node", "label")
    else:
        raise RuntimeError("labels still change after 999 rounds")
    return labels.select("node", F.col("label").alias("component"))


def linked_rows(sets: list[np.ndarray], percent: int, split: int) -> Iterator[tuple[int, np.ndarray]]:
    """Which sets link, as (number of the first row, rows of a matrix of flags). Rows are all sets, or with `split` those of the first block;
    columns are all sets, or those of the second block. Overlaps are counted exactly.
    """
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    number = np.cumsum(np.r_[False, tokens[1:] != tokens[:-1]])
    shared = np.bincount(number) > 1  # other shingles are in no overlap
    keep = shared[number]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[number[keep]]
    columns, width = int(shared.sum()), max(1, 2**22 // n)
    common = np.zeros((split or n, n - split), dtype=np.float32)  # counts below 2 ** 24 are exact
    for start in range(0, columns, width):
        low, high = np.searchsorted(column, [start, start + width])
        has = np.zeros((n, min(width, columns - start)), dtype=np.float32)
        has[owner[low:high], column[low:high] - start] = 1
        common += has[: split or n] @ has[split:].T
    for start in range(0, len(common), 256):
        overlap = common[start : start + 256].astype(np.int64)
        rows = np.arange(start, start + len(overlap))
        linked = 100 * overlap >= percent * (sizes[rows][:, None] + sizes[split:][None] - overlap)
        if not split:
            linked[np.arange(len(rows)), rows] = False
        yield start, linked


def links_of_members(sets: list[np.ndarray], percent: int, split: int) -> np.ndarray:
    """With how many of the sets each one links. With `split` the sets are in two blocks and only pairs across count (0: all pairs)."""
    found = np.zeros(len(sets), dtype=np.int64)
    for start, linked in linked_rows(sets, percent, split):
        found[start : start + len(linked)] += linked.sum(axis=1)
        if split:
            found[split:] += linked.sum(axis=0)
    return found


def forest_of_members(sets: list[np.ndarray], groups: np.ndarray, percent: int, split: int) -> list[tuple[int, int]]:
    """Links that connect all groups of members that links connect: a spanning forest, at most one pair less than members."""
    label, out = groups.copy(), []
    for start, linked in linked_rows(sets, percent, split):
        for row in np.flatnonzero((linked & (label[split:][None] != label[start : start + len(linked)][:, None])).any(axis=1)).tolist():
            i = start + row
            others = split + np.flatnonzero(linked[row])
            while len(others := others[label[others] != label[i]]):
                j = int(others[0])
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def link_counts(labels: DataFrame, sizes: DataFrame, sets: DataFrame, ranges: Ranges, percent: int) -> DataFrame:
    """class, n_links of the classes of components. labels: node, component; sizes: class, size; sets: class, tokens.

    Large components are parted by size range, of which only neighbours can link, and the ranges into blocks, compared two at a time.
    """
    placed = labels.withColumnRenamed("node", "class").join(sizes.select("class", "size"), "class")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / LINK_BLOCK), F.ceil(F.sum("size") / LINK_TOKENS)).cast("int")
    whole = placed.groupBy("component").agg(blocks.alias("whole"))
    own_range = F.size(F.filter(F.lit(ranges.starts), lambda start: start <= F.col("size")))
    ranged = placed.join(whole, "component").withColumn("range", F.when(F.col("whole") == 1, 0).otherwise(own_range)).drop("whole")
    number = ranged.groupBy("component", "range").agg(blocks.alias("blocks"))
    around = number.join(number.select("component", (F.col("range") - 1).alias("range"), F.col("blocks").alias("above")), ["component", "range"], "left")
    around = around.join(number.select("component", (F.col("range") + 1).alias("range"), F.col("blocks").alias("below")), ["component", "range"], "left")
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")

    def tiles(n: str, tile):
        return F.when(F.col(n) > 0, F.transform(F.sequence(F.lit(0), F.col(n) - 1), tile)).otherwise(F.array())

    def tile(low, i, high, j, second):
        return F.struct(low.alias("low"), i.alias("i"), high.alias("high"), j.alias("j"), second.alias("second"))

    own, x = F.col("range"), F.col("block")
    every = F.concat(
        tiles("blocks", lambda y: tile(own, F.least(x, y), own, F.greatest(x, y), x > y)),
        tiles("above", lambda y: tile(own, x, own + 1, y, F.lit(False))),
        tiles("below", lambda y: tile(own - 1, y, own, x, F.lit(True))),
    )
    laid = ranged.join(around, ["component", "range"]).withColumn("block", block).select("component", "class", F.explode(every).alias("tile"))
    keys = ["component", "low", "i", "high", "j"]
    rows = laid.select("component", "tile.*", "class").join(sets, "class").repartition(*keys).sortWithinPartitions(*keys, "second", "class")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current = None
        for batch in batches:
            out: list[tuple[int, int]] = []
            for row in zip(*[batch.column(c).to_pylist() for c in (*keys, "second", "class", "tokens")]):
                if row[:5] != current:
                    out += counted(held)
                    held, current = [], row[:5]
                held.append(row[1:])
            yield pack(out)
        yield pack(counted(held))

    def counted(rows: list[tuple]) -> list[tuple[int, int]]:
        if len(rows) < 2:
            return []
        low, i, high, j = rows[0][:4]
        split = 0 if (low, i) == (high, j) else sum(not r[4] for r in rows)
        if (low, i) != (high, j) and split in (0, len(rows)):
            return []
        found = links_of_members([np.frombuffer(r[6], dtype=np.uint64) for r in rows], percent, split)
        return [(r[5], n) for r, n in zip(rows, found.tolist()) if n]

    def pack(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())], names=["class", "n"])

    return rows.mapInArrow(count, "class long, n long").groupBy("class").agg(F.sum("n").alias("n_links"))


def join_sets(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", words_each: int = 3, percent: int = 90, count_links: bool = True) -> tuple[DataFrame, DataFrame]:
    """(members, connections). Members: doc_id, size, class, component (a class number; null for empty sets), and n_links, the exact number
    of other classes that the class links with (left out without `count_links`). Connections: pairs (a, b) of classes that link and
    connect every component; the other links inside components are counted, not listed.
    """
    ship(docs.sparkSession)
    spark, work = docs.sparkSession, f"{folder}/work"
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    digests = store(set_digests(texts, "doc_id", "text", words_each), f"{folder}/digests")
    classes = store(digests.filter("size > 0").select("class", "size", "sketch").dropDuplicates(["class"]), f"{work}/classes")
    histogram = {r["size"]: r["count"] for r in classes.filter(F.col("size") <= LIGHT_LIMIT).groupBy("size").count().collect()}
    boundary = choose_boundary(histogram, percent)
    largest = classes.agg(F.max("size")).first()[0] or 1
    ranges = Ranges(percent, largest * 100 // percent + 1)

    # Most keys stand alone. All that moves before these are gone is a key and a class, straight from the texts.
    listed = texts.select(_keys(docs, words_each, percent, boundary, ranges)("text").alias("k")).select("k.class", F.explode("k.keys").alias("key"))
    in_list = Window.partitionBy("key")
    shared = listed.withColumns({"low": F.min("class").over(in_list), "high": F.max("class").over(in_list)}).filter("low < high")
    postings = shared.select("key", "class").dropDuplicates().withColumn("n", F.count(F.lit(1)).over(in_list))
    postings = store(postings, f"{work}/postings")

    # First: every member with the most typical member of its list, the one that shares lists with most others.
    typical = postings.groupBy("class").agg(F.sum("n").alias("typical")).join(classes.select("class", "size"), "class")
    sized = postings.select("key", "class").join(typical, "class")
    best = sized.groupBy("key").agg(F.max(F.struct("typical", (-F.col("class")).alias("minus"), "size")).alias("best"))
    pivot = -F.col("best.minus")
    near = (F.least("size", "best.size") * 100 >= F.greatest("size", "best.size") * percent) & (F.col("class") != pivot)
    star = sized.join(best, "key").filter(near).select(F.least("class", pivot).alias("a"), F.greatest("class", pivot).alias("b")).distinct()
    first = store(_check(texts, digests, classes, star, words_each, percent, f"{work}/first"), f"{folder}/links1")
    found = components(first, f"{work}/components1")

    # Then: members of a list that are in different components still, compared whole inside a task.
    grouped = postings.join(classes.select("class", "size"), "class").join(found.withColumnRenamed("node", "class"), "class", "left")
    grouped = grouped.withColumn("group", F.coalesce("component", "class"))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / LINK_TOKENS)).cast("int").alias("blocks")
    # Near sets agree on many parts and meet in many lists of the same members: one list of each membership (128 bits and a count) will do.
    mixed_lists = grouped.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), blocks, *_membership("class")).filter("low < high")
    mixed_lists = mixed_lists.dropDuplicates(["m1", "m2", "m3"]).select("key", "blocks")
    mixed_members = grouped.join(mixed_lists, "key").select("key", "blocks", "class", "group")
    parts = store(_narrowed(mixed_members, classes, percent), f"{work}/mixed")
    kept = parts.groupBy(*TILE).agg(*_membership("class", "second")).dropDuplicates(["m1", "m2", "m3"]).select(*TILE)
    parts = parts.join(kept, TILE)
    sets = spark.read.schema("class long, tokens binary").parquet(f"{work}/first_sets")
    missing = parts.select("class").distinct().join(sets.select("class"), "class", "left_anti")
    sets = sets.unionByName(_made_sets(texts, digests, missing, words_each, f"{work}/second_sets"))
    second = store(_compare_lists(parts, sets, percent).distinct(), f"{folder}/links2")
    links = first.unionByName(second)
    final = components(links, f"{folder}/components2")
    members = digests.select("doc_id", "size", "class").join(final.withColumnRenamed("node", "class"), "class", "left")
    shown = ["doc_id", "size", "class", F.coalesce("component", "class").alias("component")]
    if count_links:
        counts = store(link_counts(final, classes, sets, ranges, percent), f"{folder}/n_links")
        members = members.join(counts, "class", "left")
        shown.append(F.coalesce("n_links", F.lit(0)).alias("n_links"))
    delete_folder(spark, work)
    return members.select(*shown), links


TILE = ["key", "i", "j", "part"]


def _membership(*columns: str) -> list:
    return [F.bit_xor(F.xxhash64(*columns)).alias("m1"), F.bit_xor(F.xxhash64(*columns, F.lit(1))).alias("m2"), F.count(F.lit(1)).alias("m3")]


def _by_tile(batches: Iterator[pa.RecordBatch], columns: list[str], width: int) -> Iterator[list[tuple]]:
    """The rows of each tile, which the first `width` columns name and in whose order the rows come."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in columns]):
            if held and row[:width] != held[0][:width]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _narrowed(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Lists cut into tiles and these into parts (TILE, second, class, group): the members whose sketches allow a link with one of another group.

    Long lists are cut into blocks, compared two at a time. A tile returns no more rows than it has members.
    """
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    tiles = members.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = [F.col("key"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    rows = tiles.select(*keys, (F.col("block") > F.col("other")).alias("second"), "class", "group")
    tile = TILE[:3]
    laid = rows.join(sketches, "class").repartition(*tile).sortWithinPartitions(*tile, "second", "class")
    schema = "key long, i int, j int, part long, second boolean, class long, group long"
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _by_tile(batches, [*tile, "second", "class", "group", "size", "sketch"], 3):
            out += parts(rows)
            if len(out) >= 10_000:
                yield pack(out)
                out = []
        yield pack(out)

    def parts(rows: list[tuple]) -> list[tuple]:
        _, i, j = rows[0][:3]
        split = sum(not r[3] for r in rows) if i != j else 0
        groups = np.array([r[5] for r in rows])
        if i != j and split in (0, len(rows)) or (groups == groups[0]).all():
            return []
        found = near_parts([r[7] for r in rows], np.array([r[6] for r in rows]), groups, percent, split).tolist()
        return [(*r[:3], rows[at][4], *r[3:6]) for r, at in zip(rows, found) if at >= 0]

    def pack(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=[*TILE, "second", "class", "group"])

    return laid.mapInArrow(narrow, schema)


def _compare_lists(parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of a part in different groups, as many as connect what links connect. The sets come into the
    task, and no pair leaves it that does not link.
    """
    laid = parts.join(sets, "class").repartition(*TILE).sortWithinPartitions(*TILE, "second", "class")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for rows in _by_tile(batches, [*TILE, "second", "class", "group", "tokens"], len(TILE)):
            out += pairs(rows)
            if len(out) >= 10_000:
                yield pack(out)
                out = []
        yield pack(out)

    def pairs(rows: list[tuple]) -> list[tuple[int, int]]:
        split = sum(not r[4] for r in rows) if rows[0][1] != rows[0][2] else 0
        found = forest_of_members([np.frombuffer(r[7], dtype=np.uint64) for r in rows], np.array([r[6] for r in rows]), percent, split)
        return [(min(rows[x][5], rows[y][5]), max(rows[x][5], rows[y][5])) for x, y in found]

    def pack(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return laid.mapInArrow(compare, "a long, b long")


def _made_sets(texts: DataFrame, digests: DataFrame, wanted: DataFrame, words_each: int, folder: str) -> DataFrame:
    """(class, tokens): the sets of some classes, made anew from one text of each."""
    last = F.lit(2**63 - 1)
    ids = digests.join(wanted, "class").groupBy("class").agg(F.min(F.coalesce("doc_id", last)).alias("id")).select("id").distinct()
    rows = texts.withColumn("id", F.coalesce(F.col("doc_id").cast("long"), last)).join(ids, "id", "left_semi")
    made = rows.select(_sets(texts, words_each)("text").alias("s")).select("s.*").join(wanted, "class", "left_semi").dropDuplicates(["class"])
    return store(made, folder)


def _check(texts: DataFrame, digests: DataFrame, classes: DataFrame, pairs: DataFrame, words_each: int, percent: int, folder: str) -> DataFrame:
    """The pairs of classes that link, by their whole sets. Only the sets of pairs whose sketches allow a link move."""
    left, right = (classes.select(F.col("class").alias(c), F.col("size").alias(f"size_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab")
    near = _near(percent)("sketch_a", "sketch_b", "size_a", "size_b")
    pairs = store(pairs.join(left, "a").join(right, "b").filter(near).select("a", "b"), f"{folder}_pairs")
    involved = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    sets = _made_sets(texts, digests, involved, words_each, f"{folder}_sets")
    left, right = sets.toDF("a", "left"), sets.toDF("b", "right")
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(_linked(texts, percent)("left", "right")).select("a", "b")


def smallest_ids(members: DataFrame, *carried: str) -> DataFrame:
    """doc_id, size, component_id and `carried` columns: the smallest id in the component, for empty sets the row's own."""
    low = members.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("low"))
    return members.join(low, "component", "left").select("doc_id", "size", F.coalesce("low", "doc_id").alias("component_id"), *carried)


def one_of_each(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that hold the smallest id of their component, all columns kept; of rows equal in id and text one stays.

    Texts with an empty set are in no component and stay.
    """
    members, _ = join_sets(docs, folder, doc_id, text, count_links=False, **options)
    kept = free_name(docs, "kept_id")
    ids = smallest_ids(members).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(kept)).distinct()
    return docs.join(ids, F.col(doc_id).eqNullSafe(F.col(kept)), "left_semi").dropDuplicates([doc_id, text])
