"""Which folders of a stream's outputs count: a commit per batch, rolled up so that neither folders nor entries grow with the batches ever run.

A batch writes its folders under names of its own and is committed by one entry that lists them all. Readers take the folders from the
entries, so they see whole batches or nothing of them, in all outputs alike; folders of an attempt that died are never listed. A batch that
comes again after its commit is skipped. After `roll_every` batches the committed folders of each kind are merged into one, and one
entry stands for all of them. What an entry replaced is deleted at the roll-up after the next, so that readers under way can finish.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from pagetables.plans.workspace import delete_folder

Merge = Callable[[list[str], str], None]
_ENTRY = "batch bigint, rolled boolean, folders map<string,string>, replaced array<string>"


@dataclass
class Committed:
    """The state of a ledger: the batch up to which folders are rolled up, and the folders that count, by kind."""

    rolled_to: int = -1
    batches: list[int] = field(default_factory=list)
    folders: dict[str, list[str]] = field(default_factory=dict)
    replaced: list[str] = field(default_factory=list)

    def holds(self, batch: int) -> bool:
        return batch <= self.rolled_to or batch in self.batches


class Ledger:
    def __init__(self, spark: SparkSession, folder: str, roll_every: int = 64):
        self._spark, self._folder, self._roll_every = spark, folder.rstrip("/"), roll_every

    def committed(self) -> Committed:
        try:
            entries = self._spark.read.schema(_ENTRY).json(f"{self._folder}/*").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return Committed()
        rolled = max((e for e in entries if e.rolled), key=lambda e: e.batch, default=None)
        state = Committed() if rolled is None else Committed(rolled.batch, [], {k: [v] for k, v in rolled.folders.items()}, list(rolled.replaced))
        for entry in sorted((e for e in entries if not e.rolled and e.batch > state.rolled_to), key=lambda e: e.batch):
            state.batches.append(entry.batch)
            for kind, path in entry.folders.items():
                state.folders.setdefault(kind, []).append(path)
        return state

    def _enter(self, name: str, entry: dict) -> None:
        # One row in one file: it is there or it is not.
        self._spark.createDataFrame([(json.dumps(entry),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self._folder}/{name}")

    def commit(self, batch: int, folders: dict[str, str]) -> None:
        self._enter(f"{batch:010d}", {"batch": batch, "rolled": False, "folders": folders, "replaced": []})

    def roll_up(self, merges: dict[str, tuple[str, Merge]]) -> bool:
        """Merge what is committed if there are enough batches. `merges`: kind -> (folder to write below, function (paths, target))."""
        state = self.committed()
        if len(state.batches) < self._roll_every:
            return False
        last, folders = state.batches[-1], {}
        for kind, (base, merge) in merges.items():
            folders[kind] = f"{base.rstrip('/')}/to-{last:08d}-{uuid.uuid4().hex[:8]}"
            merge(state.folders[kind], folders[kind])
        replaced = [p for paths in state.folders.values() for p in paths]
        self._enter(f"{last:010d}-all", {"batch": last, "rolled": True, "folders": folders, "replaced": replaced})
        for path in state.replaced:
            delete_folder(self._spark, path)
        for batch in state.batches:
            delete_folder(self._spark, f"{self._folder}/{batch:010d}")
        if state.rolled_to >= 0:
            delete_folder(self._spark, f"{self._folder}/{state.rolled_to:010d}-all")
        return True


def attempt_folder(base: str, batch: int) -> str:
    """A folder for one attempt at a batch."""
    return f"{base.rstrip('/')}/{batch:08d}-{uuid.uuid4().hex[:8]}"


def merge_lines(spark: SparkSession) -> Merge:
    return lambda paths, target: spark.read.text(paths).write.text(target)


def merge_rows(spark: SparkSession, change: Callable[[DataFrame], DataFrame] = lambda df: df, partition_by: tuple[str, ...] = ()) -> Merge:
    """Rows of Parquet folders as one folder, `change`d on the way; small files are read many to a task, so few are written."""
    return lambda paths, target: change(spark.read.parquet(*paths)).write.partitionBy(*partition_by).parquet(target)
