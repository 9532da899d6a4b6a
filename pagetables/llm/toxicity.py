"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Features are lower-cased letter runs, their first four and five letters, and marks that two or three different words of the text
begin so. Those associated with the label in the training rows make the vocabulary; their document frequencies are counted
over all documents. The examples lie in an inverted index of
blocks that knows, for each feature and block, the largest weight: the bound it gives on a block's cosines lets a search visit
blocks from the best down and stop as soon as no further block can hold a nearer example, so that the result is exact.
Neighbours vote, weighted by nearness; the vote is calibrated on the examples, each left out of its own vote.

Bounds: `train_rows` labelled rows and `max_features` features, chosen by hash and by association over all rows, make a
model of a few megabytes. A row may be trained on when crc32(doc_id as text) mod 5 is not 0.

Defined results: null and empty texts, and texts without any vocabulary feature, get the rate of toxic examples among those
without features; null doc_ids are held out; null labels are no labels, of several labels of a document the largest counts;
without labels the score is 0. Ties of cosine go to the smaller doc_id. Texts are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import at_work, ship, text_or_empty
from pagetables.llm.learn import fit_logistic, sigmoid
from pagetables.plans.workspace import store

PREFIXES = (4, 5)
REPEATS = (2, 3)
_LETTERS = regex.compile(r"\p{L}+")
_KNOWN_WORDS = 150_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def word_features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def text_features(text: str) -> set[str]:
    """All features of a text."""
    found: dict[str, int] = {}
    for word in set(_LETTERS.findall(text.lower())):
        for f in word_features(word):
            found[f] = found.get(f, 0) + 1
    repeats = {f"{f}{k}" for f, n in found.items() if f[-1] == "*" for k in REPEATS if n >= k}
    return repeats.union(found)


class BlockMaxIndex:
    """Unit vectors in blocks, with the largest weight of every feature in every block."""

    def __init__(self, vectors: list[dict[int, float]], ids: list[int], block: int = 64):
        # Examples that share their heaviest feature lie together, which keeps the bounds tight.
        order = sorted(range(len(vectors)), key=lambda i: (max(vectors[i], key=lambda f: (vectors[i][f], f)), ids[i]))
        self.blocks: list[tuple[np.ndarray, dict[int, int], np.ndarray]] = []
        peaks: dict[int, list[tuple[int, float]]] = {}
        for start in range(0, len(order), block):
            members = np.array(order[start : start + block])
            columns: dict[int, int] = {}
            for i in members:
                for f in vectors[i]:
                    columns.setdefault(f, len(columns))
            weights = np.zeros((len(columns), len(members)))
            for j, i in enumerate(members):
                for f, w in vectors[i].items():
                    weights[columns[f], j] = w
            for f, row in columns.items():
                peaks.setdefault(f, []).append((len(self.blocks), float(weights[row].max())))
            self.blocks.append((members, columns, weights))
        self.peaks = {f: (np.array([b for b, _ in p]), np.array([w for _, w in p])) for f, p in peaks.items()}
        self.ids = np.array(ids, dtype=np.int64)
        self.visited = 0

    def nearest(self, query: dict[int, float], k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest with a cosine over 0, nearest first, ties to the smaller id. `skip` is left out."""
        bounds = np.zeros(len(self.blocks))
        for f, w in query.items():
            if f in self.peaks:
                at, peak = self.peaks[f]
                bounds[at] += w * peak
        best_i, best_c = np.zeros(0, dtype=np.int64), np.zeros(0)
        for b in np.argsort(-bounds, kind="stable"):
            # A little slack: a bound and a cosine are sums in different order.
            if bounds[b] <= 0 or len(best_c) == k and bounds[b] < best_c[-1] - 1e-9:
                break
            self.visited += 1
            members, columns, weights = self.blocks[b]
            shared = [f for f in sorted(query) if f in columns]
            cosines = np.zeros(len(members))
            for f in shared:
                cosines += query[f] * weights[columns[f]]
            cosines = np.round(cosines, 12)  # sums in another order are still ties
            kept = (cosines > 0) & (members != skip)
            best_i, best_c = np.concatenate([best_i, members[kept]]), np.concatenate([best_c, cosines[kept]])
            order = np.lexsort((self.ids[best_i], -best_c))[:k]
            best_i, best_c = best_i[order], best_c[order]
        return best_i, best_c


@dataclass
class Model:
    vocabulary: dict[str, int] = field(default_factory=dict)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    index: BlockMaxIndex = field(default_factory=lambda: BlockMaxIndex([], []))
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rate: float = 0.0
    blank: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    k: int = 16
    examples: list[tuple[int, int, dict[int, int]]] = field(default_factory=list)
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)
    watched: set[str] = field(default_factory=set)

    def __post_init__(self):
        self.watched = {f.rstrip("0123456789") if "*" in f else f for f in self.vocabulary}

    def counts(self, text: str) -> dict[int, int]:
        """Vocabulary features of a text with their number of occurrences (of repeats: one)."""
        words = _LETTERS.findall(text.lower())
        if len(self.known) > _KNOWN_WORDS:
            self.known.clear()
        known, distinct = self.known, set(words)
        for w in distinct.difference(known):
            known[w] = tuple(f for f in word_features(w) if f in self.watched)
        begun: dict[str, int] = {}
        for w in distinct:
            for f in known[w]:
                begun[f] = begun.get(f, 0) + 1
        if not begun:
            return {}
        out: dict[int, int] = {}
        for w in words:
            for f in known[w]:
                if f in self.vocabulary:
                    out[self.vocabulary[f]] = out.get(self.vocabulary[f], 0) + 1
        for f, n in begun.items():
            for k in REPEATS:
                if n >= k and f"{f}{k}" in self.vocabulary:
                    out[self.vocabulary[f"{f}{k}"]] = 1
        return out

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        weights = {f: (1 + np.log(n)) * self.idf[f] for f, n in counts.items()}
        norm = np.sqrt(sum(w * w for w in weights.values()))
        return {f: w / norm for f, w in weights.items()} if norm > 0 else {}

    def vote(self, vector: dict[int, float], skip: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        at, cosines = self.index.nearest(vector, self.k, skip)
        weight = cosines / (1.1 - cosines)
        return float((weight @ self.labels[at] + self.rate) / (weight.sum() + 1.0)), at, cosines

    def score(self, counts: dict[int, int]) -> tuple[float, list[tuple[int, int, float]]]:
        vector = self.vector(counts)
        if not vector or not self.index.blocks:
            return self.blank, []
        vote, at, cosines = self.vote(vector)
        evidence = [(int(self.index.ids[i]), int(self.labels[i]), float(c)) for i, c in zip(at, cosines)]
        return float(sigmoid(np.array(self.slope * vote + self.shift))), evidence


def choose(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        train_rows: int = 8_000, max_features: int = 4_096, min_documents: int = 4, min_chi2: float = 25.0, k: int = 16) -> Model:
    """The vocabulary, and the training rows' counts; weigh() makes a complete model of it."""
    ship(docs.sparkSession)
    allowed = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")).filter(F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    sample = allowed.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    # train_rows bounds the broadcast side, and as each id gives one example, what reaches the driver.
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text"))
    per_label = rows.groupBy("label").count().collect()
    n1 = sum(r["count"] for r in per_label if r["label"] == 1)
    n0 = sum(r["count"] for r in per_label) - n1
    if not n1 or not n0:
        return Model(blank=float(n1 > 0), k=k)
    with1, with0 = F.col("with1"), F.col("with0")
    table = rows.select("label", "text").mapInArrow(_count_by_label, "feature string, with1 long, with0 long").groupBy("feature").agg(
        F.sum("with1").cast("double").alias("with1"), F.sum("with0").cast("double").alias("with0"))
    chi2 = (n1 + n0) * F.pow(with1 * (n0 - with0) - with0 * (n1 - with1), F.lit(2.0)) / (
        F.lit(float(n1)) * n0 * (with1 + with0) * F.greatest(n1 + n0 - with1 - with0, F.lit(0.5)))
    chosen = table.filter(with1 + with0 >= min_documents).withColumn("chi2", chi2).filter(F.col("chi2") >= min_chi2)
    terms = [r.feature for r in chosen.orderBy(F.desc("chi2"), "feature").limit(max_features).collect()]
    vocabulary = {t: i for i, t in enumerate(terms)}
    if not vocabulary:
        return Model(blank=n1 / (n1 + n0), k=k)
    return _with_examples(Model(vocabulary=vocabulary, rate=n1 / (n1 + n0), k=k), rows)


def _count_by_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a batch."""
    for batch in (whole.slice(start, 4 * ROWS_AT_ONCE) for whole in batches for start in range(0, whole.num_rows, 4 * ROWS_AT_ONCE)):
        found: dict[str, list[int]] = {}
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
            for f in text_features(text):
                found.setdefault(f, [0, 0])[label != 1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array([n[0] for n in found.values()], pa.int64()), pa.array([n[1] for n in found.values()], pa.int64())],
            names=["feature", "with1", "with0"])


ROWS_AT_ONCE = 250


def _row_runs(batch: pa.Array) -> Iterator[pa.Array]:
    """A batch in runs of rows, so that few of them are Python objects at a time."""
    for start in range(0, len(batch), ROWS_AT_ONCE):
        yield batch.slice(start, ROWS_AT_ONCE)


def _packed_counts(counts: list[dict[int, int]]) -> pa.Array:
    sizes = np.cumsum([0, *map(len, counts)])
    f = np.fromiter((f for c in counts for f in c), np.int32, sizes[-1])
    n = np.fromiter((n for c in counts for n in c.values()), np.int32, sizes[-1])
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays([pa.array(f), pa.array(n)], ["f", "n"]))


COUNT_TYPE = "array<struct<f:int,n:int>>"


def counter(docs: DataFrame, model: Model):
    """A function Column -> Column: texts to their vocabulary features with counts."""
    ship(docs.sparkSession)
    plain = Model(vocabulary=model.vocabulary)

    @F.arrow_udf(COUNT_TYPE)
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at_work("toxicity", plain.known.clear)
        for batch in batches:
            for rows in _row_runs(batch):
                yield _packed_counts([plain.counts(t or "") for t in rows.to_pylist()])

    return count.asNondeterministic()


def _added_up(size: int, counts: Iterator[pa.Array]) -> pa.RecordBatch:
    """The counts of a task: how many rows hold each feature, and all rows as feature -1."""
    found = np.zeros(size + 1, np.int64)
    for rows in counts:
        found[0] += len(rows)
        found[1:] += np.bincount(rows.flatten().field(0).to_numpy(), minlength=size)[:size]
    at = np.flatnonzero(found)
    return pa.RecordBatch.from_arrays([pa.array((at - 1).astype(np.int32)), pa.array(found[at])], names=["f", "n"])


FREQUENCIES = "f int, n long"


def weigh(model: Model, counted: DataFrame) -> Model:
    """Complete a model by document frequencies over all rows of `counted` (its column `counts`), and fit the calibration."""
    size = len(model.vocabulary)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _added_up(size, (batch.column(0) for batch in batches))

    return _weighed(model, counted.select("counts").mapInArrow(add_up, FREQUENCIES))


def _weighed(model: Model, frequencies: DataFrame) -> Model:
    size = len(model.vocabulary)
    held = {r.f: r.n for r in frequencies.groupBy("f").agg(F.sum("n").alias("n")).collect()}
    n, frequency = held.pop(-1, 0), np.zeros(size)
    for f, count in held.items():
        frequency[f] = count
    model.idf = np.log((1 + n) / (1 + frequency)) + 1
    return _index(model)


def _with_examples(model: Model, rows: DataFrame) -> Model:
    counted = rows.select("doc_id", "label", counter(rows, model)("text").alias("counts"))
    model.examples = [(r.doc_id, int(r.label == 1), {c.f: c.n for c in r.counts}) for r in sorted(counted.collect(), key=lambda r: r.doc_id)]
    return model


def _index(model: Model) -> Model:
    vectors = [model.vector(counts) for _, _, counts in model.examples]
    blanks = [label for (_, label, _), v in zip(model.examples, vectors) if not v]
    model.blank = (sum(blanks) + model.rate) / (len(blanks) + 1)
    kept = [(doc, label, v) for (doc, label, _), v in zip(model.examples, vectors) if v]
    model.labels = np.array([float(label) for _, label, _ in kept])
    model.index = BlockMaxIndex([v for _, _, v in kept], [doc for doc, _, _ in kept])
    if len(set(model.labels)) == 2:
        votes = np.array([model.vote(v, skip=i)[0] for i, (_, _, v) in enumerate(kept)])
        model.slope, model.shift = fit_logistic(votes[:, None], model.labels, l2=0.01).tolist()
    elif kept:
        model.slope, model.shift = 8.0, -4.0
    return model


SCORE_TYPE = "struct<score:double,evidence:array<struct<doc_id:long,label:int,cosine:double>>>"


def _packed_scores(found: list[tuple[float, list[tuple[int, int, float]]]]) -> pa.Array:
    one = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))
    evidence = [[dict(zip(("doc_id", "label", "cosine"), e)) for e in ev] for _, ev in found]
    return pa.StructArray.from_arrays([pa.array([s for s, _ in found], pa.float64()), pa.array(evidence, one)], ["score", "evidence"])


def scorer(docs: DataFrame, model: Model):
    """A function Column -> Column: counted features (see counter) to (score, evidence), the evidence being the nearest examples."""
    ship(docs.sparkSession)
    model.examples = []

    @F.arrow_udf(SCORE_TYPE)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for rows in _row_runs(batch):
                yield _packed_scores([model.score({c["f"]: c["n"] for c in counts or ()}) for counts in rows.to_pylist()])

    return score.asNondeterministic()


def fit(docs: DataFrame, labels: DataFrame, **options) -> Model:
    """A complete model, its document frequencies counted over `docs`."""
    model = choose(docs, labels, **options)
    plain = Model(vocabulary=model.vocabulary)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counting here, rather than in a column of its own, saves each task a second Python worker.
        at_work("toxicity", plain.known.clear)
        runs = (rows for batch in batches for rows in _row_runs(batch.column(0)))
        yield _added_up(len(plain.vocabulary), (_packed_counts([plain.counts(t or "") for t in rows.to_pylist()]) for rows in runs))

    return _weighed(model, docs.select(F.col(options.get("text", "text"))).mapInArrow(add_up, FREQUENCIES))


def text_scorer(docs: DataFrame, model: Model):
    """A function Column -> Column: texts to (score, evidence), counted and scored by one Python worker a task."""
    ship(docs.sparkSession)
    model.examples = []

    @F.arrow_udf(SCORE_TYPE)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at_work("toxicity", model.known.clear)
        for batch in batches:
            for rows in _row_runs(batch):
                yield _packed_scores([model.score(model.counts(t or "")) for t in rows.to_pylist()])

    return score.asNondeterministic()


def score_documents(docs: DataFrame, labels: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, score and evidence of every row. Texts are read once; their counts are kept in `folder`."""
    model = choose(docs, labels, doc_id=doc_id, text=text, **options)
    counted = store(docs.select(F.col(doc_id).alias("doc_id"), counter(docs, model)(text_or_empty(text)).alias("counts")), folder)
    found = counted.select("doc_id", scorer(docs, weigh(model, counted))("counts").alias("found"))
    return found.select("doc_id", "found.score", "found.evidence")
