"""Places of rows in an order, without a global window.

Rows are dealt to ranges of the order and sorted there; each task adds up weights from its own first row on, and the totals of all
(range, group) pairs, which are few, give the ranges their starts. Equal rows are told apart by where they were read, so that a row repeated very often
still falls into several ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import free_name, ship
from pagetables.plans.workspace import new_folder, store


def with_starts(rows: DataFrame, order: list[str], weight: str, group: str | None = None, start: str = "start", total: str = "total") -> DataFrame:
    """`rows` with the sum of `weight` (long) over the rows before in (`group`, `order`), and the sum over the whole group.

    `group`, if given, is a string column without nulls; starts count from its first row. Nulls of `order` come first. The
    result is stored in the shared folder.
    """
    spark = rows.sparkSession
    ship(spark)
    read = free_name(rows, "_read")
    keys = [*([group] if group else []), *order]
    dealt = rows.withColumn(read, F.monotonically_increasing_id()).repartitionByRange(*keys, read).sortWithinPartitions(*keys, read).drop(read)
    w, g = rows.columns.index(weight), rows.columns.index(group) if group else None

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, held = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            weights = batch.column(w).to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.cumsum(weights) - weights
            if g is None:
                base = np.full(len(before), held)
                held += int(weights.sum())
            else:
                coded = batch.column(g).dictionary_encode()
                codes = np.asarray(coded.indices)
                firsts = np.flatnonzero(np.diff(codes, prepend=-1))
                base = -np.repeat(before[firsts], np.diff(firsts, append=len(codes)))
                if coded.dictionary[0].as_py() == last:
                    base[codes == codes[0]] += held
                last = coded.dictionary[int(codes[-1])].as_py()
                held = int(before[-1] + base[-1] + weights[-1])
            columns = [*batch.columns, pa.array(before + base), pa.array(np.full(len(before), part, np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [*rows.columns, "within", "part"]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError("rows may not have columns named within or part")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    summed = store(dealt.mapInArrow(add_up, f"{types}, within long, part int"), new_folder(spark, "positions"))
    by = [group] if group else []
    parts = summed.groupBy("part", *by).agg(F.max(F.col("within") + F.col(weight)).alias("share"))
    within_group = Window.partitionBy(*by)
    begins = parts.select(
        "part", *by, F.sum("share").over(within_group).alias(total),
        (F.sum("share").over(within_group.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("share")).alias("begin"),
    )
    placed = summed.join(begins, ["part", *by])
    return placed.select(*rows.columns, (F.col("within") + F.col("begin")).alias(start), total)
