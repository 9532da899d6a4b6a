"""Document quality by co-training two views: what the text is like, and what is said about it.

The content view describes characters, words and repetition of the whole text; the metadata view describes language, source
and stated size, and sees nothing of the text. Each view has a logistic classifier. In every round each classifier scores all
unlabelled documents, and hands every one it is confident of, of either class, to the other as a pseudo-labelled example. At the
end each view is calibrated, and a logistic model combines the calibrated views, both on labelled rows that neither view
was trained on; the combination scores every document.

Documents become short feature arrays in one pass over the texts, kept as a table; the rounds read that table only. Equal
feature arrays are one example, so that copies do not outvote the rest. Pseudo-labelled examples never reach the driver: each task
adds up their gradients and Hessians, and Newton's steps are taken on the sums. An example weighs `weight`, less where a class has more of
them than labels: together they weigh at most `weight` times the labels of their class. The only bound is `train_rows` labelled rows.

Defined results: null and empty texts have the feature values of an empty text; null languages, sources and sizes are a value of
their own, and so is a missing size column; null labels are none, of several labels of a document the smallest counts; of several texts of a labelled document
that with the smallest feature hash is trained on. Without labels of both classes every score is 1 (nothing can be told to be bad) or 0 (all
labels are 0). Where the labelled rows kept for calibration hold one class only, the training rows are used for it as well.
Repeated rows are scored alike. Texts are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import ship, text_or_empty
from pagetables.llm.learn import fit_logistic, logit, predict_logistic, sigmoid
from pagetables.plans.workspace import store

_CLASSES = np.zeros((256, 7))
for _b in range(256):
    _c = chr(_b)
    _CLASSES[_b, 0] = _b < 128 and _c.islower()
    _CLASSES[_b, 1] = _b < 128 and _c.isupper()
    _CLASSES[_b, 2] = _b < 128 and _c.isdigit()
    _CLASSES[_b, 3] = _c in " \t\r\n\f\v"
    _CLASSES[_b, 4] = _c in ".,;:?'\"()-"
    _CLASSES[_b, 5] = _b >= 128
_CLASSES[:, 6] = 1 - _CLASSES[:, :6].sum(axis=1)
HASHED = 16
ROWS_AT_ONCE = 250  # rows of a batch that are Python objects at a time
KEPT_FROM = 0.5


def content_features(text: str) -> list[float]:
    """Shares of character classes, word and sentence shape, repetition."""
    coded = np.frombuffer(text.encode(), dtype=np.uint8)
    counts = np.bincount(coded, minlength=256)
    shares = counts @ _CLASSES / max(len(coded), 1)
    words = text.split()
    n = max(len(words), 1)
    lines = text.split("\n")
    symbols = counts[[ord(c) for c in "!#$%&*|@<>{}\\"]] / n
    lengths = np.array([len(w) for w in words] or [0])
    return [
        *shares.tolist(), *np.minimum(symbols, 2.0).tolist(),
        len(set(words)) / n, len(set(lines)) / len(lines),
        float(lengths.mean()) / 10, float(lengths.std()) / 10, float((lengths <= 3).mean()), float((lengths > 20).mean()),
        min((counts[ord(".")] + counts[ord("?")]) / n, 1.0), float(not words),
    ]


def metadata_features(lang: str | None, source: str | None, size: int | None) -> list[float]:
    """Hashed language and source, stated size."""
    out = [0.0] * (2 * HASHED)
    out[zlib.crc32((lang or "\0").encode()) % HASHED] = 1.0
    out[HASHED + zlib.crc32((source or "\0").encode()) % HASHED] = 1.0
    log = np.log1p(max(size or 0, 0)) / 10
    return [*out, float(size is None), log, log**2]


N_CONTENT = len(content_features("a"))
N_METADATA = len(metadata_features(None, None, None))
WIDTHS = {"content": N_CONTENT, "metadata": N_METADATA}


def featured(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", size: str = "n_chars"):
    """A Column of both views' features."""
    ship(docs.sparkSession)

    @F.arrow_udf("struct<content:array<float>,metadata:array<float>>")
    def features(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        one = pa.list_(pa.float32())
        for columns in batches:
            for start in range(0, len(columns[0]), ROWS_AT_ONCE):
                texts, *about = (column.slice(start, ROWS_AT_ONCE).to_pylist() for column in columns)
                content = [content_features(t) for t in texts]
                metadata = [metadata_features(*row) for row in zip(*about)]
                yield pa.StructArray.from_arrays([pa.array(content, one), pa.array(metadata, one)], ["content", "metadata"])

    stated = F.col(size) if size in docs.columns else F.lit(None)
    return features.asNondeterministic()(text_or_empty(text), F.col(lang).cast("string"), F.col(source).cast("string"), stated.cast("long"))


@dataclass
class Model:
    """A logistic classifier and a calibration (slope, shift) a view, and their combination; without classifiers, one score for all."""

    content: np.ndarray | None = None
    metadata: np.ndarray | None = None
    calibration: dict[str, np.ndarray] | None = None
    mix: np.ndarray | None = None
    constant: float = 1.0

    def views(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return predict_logistic(content, self.content), predict_logistic(metadata, self.metadata)

    def calibrated(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Both views' calibrated log odds, side by side."""
        scales = [self.calibration[view] for view in WIDTHS]
        return np.column_stack([logit(p) * slope + shift for p, (slope, shift) in zip(self.views(content, metadata), scales)])

    def combined(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        return predict_logistic(self.calibrated(content, metadata), self.mix)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def scorer(model: Model):
    """A function Column -> Column: feature structs to the combined score."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            if model.mix is None:
                yield pa.array(np.full(len(batch), model.constant))
            else:
                yield pa.array(model.combined(*(_matrix(batch.field(view), n) for view, n in WIDTHS.items())))

    return score.asNondeterministic()


# What a view learns from: per class the number of examples, the gradient and the Hessian of their loss.
Sums = dict[str, dict[int, tuple[float, np.ndarray, np.ndarray]]]


def taught(features: dict[str, np.ndarray], teachers: Model, learners: dict[str, np.ndarray], confident: float) -> list[np.ndarray]:
    """The parts of Sums, view by view and class by class, of the rows that the other view is confident of."""
    parts = []
    for view, p in zip(WIDTHS, reversed(teachers.views(**features))):
        x = np.column_stack([features[view], np.ones(len(p))])
        learnt = sigmoid(x @ learners[view])
        for label in (0, 1):
            sure = (p if label else 1 - p) >= confident
            rows, q = x[sure], learnt[sure]
            parts += [np.array([float(len(rows))]), rows.T @ (q - label), ((rows * (q * (1 - q))[:, None]).T @ rows).ravel()]
    return parts


def _sums(flat: np.ndarray) -> Sums:
    out: Sums = {}
    at = 0
    for view, n in WIDTHS.items():
        for label in (0, 1):
            d = n + 1
            out.setdefault(view, {})[label] = (flat[at], flat[at + 1 : at + 1 + d], flat[at + 1 + d : at + 1 + d + d * d].reshape(d, d))
            at += 1 + d + d * d
    return out


def _gathered(unlabelled: DataFrame, teachers: Model, learners: dict[str, np.ndarray], confident: float) -> Sums:
    """`taught` over all rows: one row of sums a task, a few at the driver."""
    length = sum(2 * (1 + (n + 1) + (n + 1) ** 2) for n in WIDTHS.values())

    def row(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            total += np.concatenate(taught({v: _matrix(batch.column(v), n) for v, n in WIDTHS.items()}, teachers, learners, confident))
        yield row(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            total += batch.column("sums").flatten().to_numpy().reshape(-1, length).sum(axis=0)
        yield row(total)

    kind = "sums array<double>"
    found = unlabelled.select("features.content", "features.metadata").mapInArrow(learn, kind).repartition(8).mapInArrow(add, kind).collect()
    return _sums(np.sum([np.zeros(length), *(np.array(r.sums) for r in found)], axis=0))


def newton_step(w: np.ndarray, x: np.ndarray, y: np.ndarray, sums: dict[int, tuple[float, np.ndarray, np.ndarray]], weight: float, l2: float = 0.1) -> np.ndarray:
    """One step of the logistic fit on labelled rows together with the sums of pseudo-labelled ones."""
    x = np.column_stack([x, np.ones(len(x))])
    p = sigmoid(x @ w)
    penalty = np.full(len(w), l2)
    penalty[-1] = 1e-6
    gradient = x.T @ (p - y) + penalty * w
    hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
    for label, (n, slope, bend) in sums.items():
        each = weight * min(1.0, (y == label).sum() / max(n, 1.0))
        gradient, hessian = gradient + each * slope, hessian + each * bend
    step = np.linalg.solve(hessian, gradient)
    return w - step / max(1.0, np.abs(step).max() / 5)


def co_train(table: DataFrame, labels: DataFrame, folder: str, doc_id: str = "doc_id", label: str = "quality", train_rows: int = 12_000,
             rounds: int = 3, steps: int = 4, confident: float = 0.95, weight: float = 0.3) -> Model:
    """Train on a table of doc_id and features; the features of the unlabelled rows are set apart in `folder` once. A round takes `steps` steps
    of Newton's method from the last round's classifiers. One labelled row in four is kept for calibration, half of them for the
    views, half for the combination."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")).filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    # train_rows bounds the broadcast side and, as each id gives one row, what reaches the driver.
    one_each = table.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min_by("features", F.xxhash64("features")).alias("features"))
    rows = sorted(one_each.collect(), key=lambda r: r.doc_id)
    y = np.array([float(r.label == 1) for r in rows])
    if len(set(y.tolist())) < 2:
        return Model(constant=0.0 if len(y) and y[0] == 0 else 1.0)
    drawn = np.array([zlib.crc32(str(r.doc_id).encode()) for r in rows])
    kept = drawn % 4 == 0
    if len(set(y[kept].tolist())) < 2 or len(set(y[~kept].tolist())) < 2:
        kept[:] = False
    held = kept if kept.any() else ~kept
    halves = [held & (drawn // 4 % 2 == half) for half in (0, 1)]
    if any(len(set(y[half].tolist())) < 2 for half in halves):
        halves = [held, held]
    views = {v: np.array([r["features"][v] for r in rows], dtype=float) for v in WIDTHS}
    fitted = {v: fit_logistic(x[~kept], y[~kept], l2=0.1) for v, x in views.items()}
    unlabelled = store(table.join(known.select("doc_id"), "doc_id", "left_anti").select("features").distinct(), folder)
    for _ in range(rounds):
        teachers = Model(**fitted)
        for _ in range(steps):
            sums = _gathered(unlabelled, teachers, fitted, confident)
            fitted = {v: newton_step(fitted[v], x[~kept], y[~kept], sums[v], weight) for v, x in views.items()}
    model = Model(**fitted)
    first, second = ({v: x[half] for v, x in views.items()} for half in halves)
    odds = dict(zip(WIDTHS, map(logit, model.views(**first))))
    model.calibration = {v: fit_logistic(z[:, None], y[halves[0]], l2=0.1) for v, z in odds.items()}
    model.mix = fit_logistic(model.calibrated(**second), y[halves[1]], l2=0.1)
    return model


def score_documents(docs: DataFrame, labels: DataFrame, folder: str, doc_id: str = "doc_id", **options) -> tuple[DataFrame, Model]:
    """doc_id and score (1: good) of every row, and the model. Feature arrays of all rows are kept in `folder`."""
    table = store(docs.select(F.col(doc_id).alias("doc_id"), featured(docs).alias("features")), folder)
    model = co_train(table, labels, f"{folder}_unlabelled", **options)
    return table.select("doc_id", scorer(model)("features").alias("score")), model


def score_column(docs: DataFrame, model: Model) -> Column:
    """The score of the rows of `docs` by a trained model."""
    return scorer(model)(featured(docs))
