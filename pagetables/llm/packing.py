"""Cost-balanced packing of documents into training sequences.

A sequence of n tokens from one document costs `linear * n + quadratic * n * n` (feed-forward work and attention inside
the document). Documents are mixed by a hash and packed block by block: within a block, in order of descending cost, a document goes to the
sequence of lowest cost whose remaining capacity holds it; when none does, it is cut, and the sequence of lowest cost
with any capacity left takes as much as it can. A block's capacities are full sequences plus the powers of two that make
up the rest, so that all of them are filled to the last token and nothing is padded.

Blocks hold about `block_tokens` tokens. They bound a task's memory whatever the number of rows that share a hash, and
every task packs its own blocks, so there is no global step. Rows are sorted by hash and content before packing: a task
that runs again packs the same pieces. Null and empty texts are documents of the closing token alone; repeated rows are
packed like others; null ids are carried; an empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import ship, text_or_empty
from pagetables.llm.tokens import id_type, packed_ids

SEQUENCE_TOKENS = 4096


def capacities(total: int, sequence_tokens: int) -> list[int]:
    """Full sequences, then the powers of two that sum to the rest."""
    rest = total % sequence_tokens
    return [sequence_tokens] * (total // sequence_tokens) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def assign(lengths: np.ndarray, sequence_tokens: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that fill the block's sequences exactly."""
    size = np.array(capacities(int(lengths.sum()), sequence_tokens), dtype=np.int64)
    left, cost = size.copy(), np.zeros(len(size))
    pieces = []
    for doc in np.argsort(-lengths, kind="stable").tolist():
        start, need = 0, int(lengths[doc])
        while need:
            whole = left >= need
            usable = whole if whole.any() else left > 0
            candidates = np.flatnonzero(usable)
            lowest = candidates[cost[candidates] == cost[candidates].min()]
            at = int(lowest[np.argmax(left[lowest])])
            taken = min(need, int(left[at]))
            pieces.append((doc, start, taken, at, int(size[at] - left[at])))
            left[at] -= taken
            cost[at] += linear * taken + quadratic * taken * taken
            start, need = start + taken, need - taken
    return pieces


def pack(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", closing_id: int = 2,
         sequence_tokens: int = SEQUENCE_TOKENS, linear: float = 1.0, quadratic: float = 1 / 4096, block_tokens: int = 4_000_000) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit)."""
    if sequence_tokens & (sequence_tokens - 1):
        raise ValueError("sequence_tokens must be a power of two")
    spark = docs.sparkSession
    ship(spark)
    dtype = id_type(tokenizer_path)
    tokens = docs.select(F.col(doc_id).alias("doc_id"), packed_ids(spark, tokenizer_path, dtype, closing_id)(text_or_empty(text)).alias("ids"))
    mixed = tokens.withColumn("mix", F.xxhash64("doc_id", "ids")).repartition("mix").sortWithinPartitions("mix", "doc_id", "ids")

    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    id_schema = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {id_schema}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

    def pack_block(ids: list, texts: list[bytes], first: int) -> tuple[pa.RecordBatch, int]:
        arrays = [np.frombuffer(t, dtype=dtype) for t in texts]
        lengths = np.array([len(a) for a in arrays], dtype=np.int64)
        pieces = assign(lengths, sequence_tokens, linear, quadratic)
        doc, start, length, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*pieces))
        cut = [arrays[d][s : s + n].astype("<u4").tobytes() for d, s, n, _, _ in pieces]
        columns = [pa.array(ids).take(pa.array(doc)), start, length, lengths[doc], sequence + first, offset, cut]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names), int(sequence.max()) + 1

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 36
        ids, texts, held = [], [], 0
        for batch in batches:
            for an_id, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(an_id)
                texts.append(packed)
                held += len(packed) // np.dtype(dtype).itemsize
                if held >= block_tokens:
                    out, used = pack_block(ids, texts, first)
                    yield out
                    first, ids, texts, held = first + used, [], [], 0
        if held:
            yield pack_block(ids, texts, first)[0]

    return mixed.select("doc_id", "ids").mapInArrow(pack_partition, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, length, doc_ids and ids in order of offset."""
    rows = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("rows"))
    return rows.select(
        "sequence_id", F.aggregate("rows", F.lit(0).cast("long"), lambda a, r: a + r["length"]).alias("length"),
        F.transform("rows", lambda r: r["doc_id"]).alias("doc_ids"),
        F.unhex(F.array_join(F.transform("rows", lambda r: F.hex(r["ids"])), "")).alias("ids"),
    )
