"""Token sequences in training order: binary shards of fixed stride, read one after the other or from any slot.

Documents are tokenised and cut to sequences of `stride` tokens, as they follow each other in a task; the sequences are kept as a table with
a running number each task, and sums of the tasks' counts make the numbers global and dense. A keyed Feistel network permutes
0 .. N-1: it permutes a power of four that is at least N, and a value of N or more walks on along its cycle until it is below. So every
sequence has a slot of its own, any reader can compute either from the other (`slot_of`, `sequence_of`), and no
order is ever stored. Range partitions of the slots write shards of `shard_slots` sequences: slot s stands in shard
s // shard_slots at byte (s % shard_slots) * stride * width. A reader that has done n slots goes on at slot n.

Files are written through pyarrow's file system for the folder's URI, under a name of the attempt's own, and moved to their final name: a task
that runs again writes the same bytes. Unused ends of a sequence hold `filler`, an id outside of the vocabulary.

Defined results: null and empty texts are the closing token alone; repeated rows and null ids are kept like others; an empty table gives no shard.
Only id and text are read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.llm.common import add_file, ship, text_or_empty
from pagetables.llm.tokens import id_type, word_tokenizer
from pagetables.plans.workspace import store

STRIDE = 1024
SHARD_SLOTS = 2048
ROUNDS = 6


def _round(half: np.ndarray, key: int, number: int) -> np.ndarray:
    x = half + np.uint64((key * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _network(x: np.ndarray, bits: int, key: int, back: bool) -> np.ndarray:
    """A permutation of 0 .. 4 ** bits - 1."""
    mask = np.uint64(2**bits - 1)
    left, right = x >> np.uint64(bits), x & mask
    for number in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
        if back:
            left, right = right ^ (_round(left, key, number) & mask), left
        else:
            left, right = right, left ^ (_round(right, key, number) & mask)
    return (left << np.uint64(bits)) | right


def permute(numbers: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """The keyed permutation of 0 .. n-1, or its inverse."""
    bits = max(1, ((n - 1).bit_length() + 1) // 2)
    out = _network(numbers.astype(np.uint64), bits, key, back)
    while (far := out >= np.uint64(n)).any():
        out[far] = _network(out[far], bits, key, back)
    return out.astype(np.int64)


def slot_of(n: int, key: int):
    """A function Column -> Column: sequence numbers to slots."""
    return _permuted(n, key, False)


def sequence_of(n: int, key: int):
    """A function Column -> Column: slots to sequence numbers."""
    return _permuted(n, key, True)


def _permuted(n: int, key: int, back: bool):
    @F.arrow_udf("long")
    def permuted(numbers: pa.Array) -> pa.Array:
        return pa.array(permute(numbers.to_numpy(zero_copy_only=False), n, key, back)) if len(numbers) else pa.array([], pa.int64())

    return permuted


def cut_sequences(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", closing_id: int = 2, stride: int = STRIDE) -> DataFrame:
    """task, number (within the task), doc_ids, n_tokens, ids: packed tokens of full sequences, the last of a task may be shorter.

    The ids of a document run on over sequences; `doc_ids` lists those that a sequence holds tokens of.
    """
    ship(docs.sparkSession)
    dtype = np.dtype(id_type(tokenizer_path))
    kind = docs.schema[doc_id].dataType.simpleString()
    name = add_file(docs.sparkSession, tokenizer_path)
    closing = np.array([closing_id], dtype=dtype).tobytes()
    full = stride * dtype.itemsize
    names = ["task", "number", "doc_ids", "n_tokens", "ids"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        rest, rest_docs = b"", []
        made: list[tuple] = []
        kept = pa.list_(pa.int64()) if kind == "bigint" else None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*made)) or [()] * 5
            types = [pa.int64(), pa.int64(), kept, pa.int64(), pa.binary()]
            made.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

        def take(piece: bytes, owners: list) -> None:
            nonlocal number
            made.append((task, number, owners, len(piece) // dtype.itemsize, piece))
            number += 1

        # Tokenising here, rather than in a column of its own, saves a second Python worker and the way of all ids through the JVM.
        tokenizer = word_tokenizer(name, dtype.str)
        for whole in batches:
            for start in range(0, whole.num_rows, 2_000):
                part = whole.slice(start, 2_000)
                coded = tokenizer.encode(part.column(1).to_pylist())
                for owner, ids in zip(part.column(0).to_pylist(), coded):
                    ids, at = ids + closing, 0
                    while len(rest) + len(ids) - at >= full:
                        need = full - len(rest)
                        take(rest + ids[at : at + need], [*rest_docs, owner] if need else rest_docs)
                        at, rest, rest_docs = at + need, b"", []
                    if at < len(ids):
                        rest, rest_docs = rest + ids[at:], [*rest_docs, owner]
                if made:
                    yield flush()
        if rest:
            take(rest, rest_docs)
        yield flush()

    texts = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    return texts.mapInArrow(cut, f"task long, number long, doc_ids array<{kind}>, n_tokens long, ids binary")


def numbered(sequences: DataFrame) -> tuple[DataFrame, int]:
    """Global dense numbers for stored sequences, and how many there are. One row a task of the writing job is added up on the driver."""
    counts = sequences.groupBy("task").count().orderBy("task").collect()
    starts, total = [], 0
    for r in counts:
        starts.append((r.task, total))
        total += r["count"]
    offsets = sequences.sparkSession.createDataFrame(starts, "task long, before long")
    # A row a task: as small as the list of the table's files.
    return sequences.join(F.broadcast(offsets), "task").withColumn("sequence", F.col("before") + F.col("number")).drop("before"), total


def _squeezer():
    """A function Column -> Column: ids compressed one by one, for the shuffle, whose own codec finds little in token ids."""
    @F.arrow_udf("binary")
    def squeezed(ids: pa.Array) -> pa.Array:
        codec = pa.Codec("zstd", compression_level=3)
        return pa.array([codec.compress(x.as_buffer(), asbytes=True) for x in ids], pa.binary())

    return squeezed


def write_shards(sequences: DataFrame, total: int, folder: str, key: int, dtype: str, stride: int = STRIDE, shard_slots: int = SHARD_SLOTS, filler: int | None = None) -> DataFrame:
    """Write the shards under `folder`; returns shard, first_slot, slots, bytes, crc32 of each. Evaluate it once; store() does.

    `filler` stands behind the last token of a slot: by default the largest number of the type, which id_type keeps free of ids.
    """
    filler = np.iinfo(dtype).max if filler is None else filler
    shards = -(-total // shard_slots)
    placed = sequences.select(slot_of(total, key)("sequence").alias("slot"), _squeezer()("ids").alias("ids"), "n_tokens").withColumn("shard", F.floor(F.col("slot") / shard_slots).cast("long"))
    # Slots are dense, so the ranges are known; sampling for them would squeeze all ids once more.
    tasks = max(1, min(shards, 20_000))
    task = F.floor(F.col("shard") * tasks / max(1, shards)).cast("int")
    laid = placed.repartitionById(tasks, task).sortWithinPartitions("slot").select("shard", "slot", "n_tokens", "ids")
    empty = np.full(stride, filler, dtype=dtype).tobytes()
    width = np.dtype(dtype).itemsize

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder) if re.match(r"\w+:", folder) else (fs.LocalFileSystem(), folder)
        system.create_dir(root, recursive=True)

        def finish(shard: int, first: int, strides: list[bytes]) -> pa.RecordBatch:
            data = b"".join(strides)
            name = f"{root}/_{shard:010d}-{uuid.uuid4().hex}"
            with system.open_output_stream(name) as out:
                out.write(data)
            system.move(name, f"{root}/{shard:010d}.tokens")
            return pa.RecordBatch.from_pylist([{"shard": shard, "first_slot": first, "slots": len(strides), "bytes": len(data), "crc32": zlib.crc32(data)}])

        shard, first, strides = None, 0, []
        codec = pa.Codec("zstd")
        for batch in batches:
            for s, slot, n, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if s != shard and strides:
                    yield finish(shard, first, strides)
                    strides = []
                if not strides:
                    shard, first = s, slot
                strides.append(codec.decompress(ids, decompressed_size=n * width, asbytes=True) + empty[n * width :])
        if strides:
            yield finish(shard, first, strides)

    return laid.mapInArrow(write, "shard long, first_slot long, slots long, bytes long, crc32 long")


def read_shards(spark: SparkSession, folder: str, dtype: str, stride: int = STRIDE, shard_slots: int = SHARD_SLOTS, from_slot: int = 0, filler: int | None = None,
                order: tuple[int, int] | None = None) -> DataFrame:
    """slot, sequence, shard, n_tokens, ids of all slots from `from_slot` on. Shards before it are not opened.

    `order` is (number of sequences, key); without it sequence is null. It is worked out here, with the slots, in one Python worker.
    """
    filler = np.iinfo(dtype).max if filler is None else filler
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
    number = F.regexp_extract("path", r"(\d+)\.tokens$", 1).cast("long")
    wanted = files.withColumn("shard", number).filter(F.col("shard") >= from_slot // shard_slots).select("shard", "content")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(content.as_buffer(), dtype=dtype).reshape(-1, stride)
                lengths = (data != filler).sum(axis=1)
                at = shard * shard_slots + np.arange(len(data))
                sequence = pa.array(permute(at, *order, back=True)) if order else pa.nulls(len(data), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), sequence, pa.array(np.full(len(data), shard)), pa.array(lengths),
                     pa.array([row[:n].tobytes() for row, n in zip(data, lengths)], pa.binary())], names=["slot", "sequence", "shard", "n_tokens", "ids"])

    return wanted.mapInArrow(split, "slot long, sequence long, shard long, n_tokens long, ids binary").filter(F.col("slot") >= from_slot)


def materialise(docs: DataFrame, tokenizer_path: str, folder: str, key: int, stride: int = STRIDE, shard_slots: int = SHARD_SLOTS, **columns: str) -> tuple[DataFrame, DataFrame, int]:
    """Write a corpus in training order: the stored sequences with their global numbers, the stored list of shards, and the number of sequences."""
    cut = cut_sequences(docs, tokenizer_path, stride=stride, **columns)
    cut.write.option("compression", "zstd").parquet(f"{folder}/sequences")
    sequences, total = numbered(docs.sparkSession.read.schema(cut.schema).parquet(f"{folder}/sequences"))
    shards = write_shards(sequences, total, f"{folder}/shards", key, id_type(tokenizer_path), stride, shard_slots)
    return sequences, store(shards, f"{folder}/list"), total
