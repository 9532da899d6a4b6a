"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package's modules, so that Python workers import them and keep their caches between tasks."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="code-"), "pagetables_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def add_file(spark: SparkSession, path: str) -> str:
    """Send a vocabulary file to all executors; they open it by the returned name (see local_file)."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def local_file(name: str) -> str:
    """Inside a task: where a file sent by add_file lies."""
    return SparkFiles.get(name)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or a variant of it that no column of `df` has (column names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    return name if name.lower() not in taken else f"{name}_{uuid.uuid4().hex[:8]}"


def slices(sizes: Iterable[int], limit: int) -> Iterable[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to about `limit`; a larger single item gets a range of its own."""
    start = total = end = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= limit:
            yield start, end
            start, total = end, 0
    if end > start:
        yield start, end


_DROPS: dict[str, Callable[[], object]] = {}


def at_work(operator: str, drop: Callable[[], object]) -> None:
    """Inside a task: `operator` runs here now, and what other operators left in this worker's caches goes; `drop` empties its own."""
    for other in [o for o in _DROPS if o != operator]:
        _DROPS.pop(other)()
    _DROPS[operator] = drop


class WordCache:
    """Encoded words, kept between batches and tasks of a worker. A generation ends at `limit` bytes; two generations are held.

    `encode` gets a list of words not seen lately and returns their encodings, as bytes, in the same order.
    """

    ENTRY = 200  # bytes of an entry; three more for every letter

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 64_000_000, chunk: int = 40_000):
        self._encode, self._limit, self._chunk = encode, limit, chunk
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._bytes = 0

    def lookup(self, words: list[list[str]]) -> list[bytes]:
        """The concatenated encodings of each list of words."""
        if self._bytes > self._limit:
            self._old, self._young, self._bytes = self._young, {}, 0
        young, old = self._young, self._old
        missing = set().union(*words).difference(young) if words else set()
        known = missing.intersection(old)
        for word in known:
            young[word] = old[word]
        fresh = list(missing.difference(known))
        for at in range(0, len(fresh), self._chunk):
            part = fresh[at : at + self._chunk]
            young.update(zip(part, self._encode(part), strict=True))
        self._bytes += self.ENTRY * len(missing) + 3 * sum(map(len, missing))
        return [b"".join(map(young.__getitem__, ws)) for ws in words]


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
