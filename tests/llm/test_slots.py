import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagetables.llm import slots
from pagetables.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4096, 4097, 65_537])
@pytest.mark.parametrize("key", [0, 1, 987654321])
def test_permutation_and_inverse(n, key):
    numbers = np.arange(n)
    out = slots.permute(numbers, n, key)
    assert sorted(out.tolist()) == numbers.tolist()
    assert slots.permute(out, n, key, back=True).tolist() == numbers.tolist()


def test_order_depends_on_the_key_and_mixes():
    a, b = (slots.permute(np.arange(10_000), 10_000, key) for key in (1, 2))
    assert (a != b).mean() > 0.99
    assert abs(np.corrcoef(np.arange(10_000), a)[0, 1]) < 0.05


def want_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def read_all(spark, folder, total, key, stride, shard_slots, from_slot=0):
    rows = slots.read_shards(spark, f"{folder}/shards", "<u2", stride, shard_slots, from_slot).collect()
    numbers = slots.permute(np.array([r.slot for r in rows]), total, key, back=True)
    return {int(s): np.frombuffer(bytes(r.ids), dtype="<u2").tolist() for s, r in zip(numbers, rows)}


def test_round_trip_and_resuming(spark, tmp_path):
    texts = [None, "", "a b c", "word " * 500, *[f"text number {i} " * (i % 40) for i in range(60)], "same", "same"]
    docs = spark.createDataFrame([(i if i else None, t, "x", 5) for i, t in enumerate(texts)], "doc_id long, text string, ids string, task int").coalesce(1)
    folder = str(tmp_path)
    sequences, shards, total = slots.materialise(docs, PATH, folder, 3, stride=32, shard_slots=8)
    got = read_all(spark, folder, total, 3, 32, 8)
    assert sorted(got) == list(range(total))
    assert [i for s in range(total) for i in got[s]] == [i for t in texts for i in want_ids(t)]
    owners = {r.sequence: r.doc_ids for r in sequences.collect()}
    assert set(i for o in owners.values() for i in o) == {None, *range(1, len(texts))}
    for r in shards.collect():
        data = (tmp_path / "shards" / f"{r.shard:010d}.tokens").read_bytes()
        assert len(data) == r.bytes == r.slots * 64 and zlib.crc32(data) == r.crc32 and r.first_slot == r.shard * 8
    placed = slots.read_shards(spark, f"{folder}/shards", "<u2", 32, 8, order=(total, 3)).select("slot", "sequence", slots.sequence_of(total, 3)("slot").alias("again"))
    assert all(r.sequence == r.again for r in placed.collect())
    rest = read_all(spark, folder, total, 3, 32, 8, from_slot=13)
    assert len(rest) == total - 13 and all(got[s] == ids for s, ids in rest.items())


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op5_training_order"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows))) == sorted(r.sequence for r in rows)
    assert sum(r.n_tokens for r in rows) == sum(len(want_ids(d.text)) for d in docs)
    assert {i for r in rows for i in r.doc_ids} == {d.doc_id for d in docs}
    assert all(r.shard == r.slot // slots.SHARD_SLOTS for r in rows)


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    sequences, shards, total = slots.materialise(docs, PATH, str(tmp_path / "a"), 1)
    assert total == 0 and sequences.count() == 0 and shards.count() == 0
    docs.write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    assert QUERIES["op5_training_order"](spark, str(tmp_path / "sf")).count() == 0
    assert spark.range(0).select(slots.slot_of(5, 1)("id")).filter(F.lit(True)).count() == 0


def test_ids_above_16_bits_and_the_old_filler_survive(spark, tmp_path):
    ids = np.array([65_535, 7, 70_000], dtype="<u4")
    rows = spark.createDataFrame([(0, 3, ids.tobytes()), (1, 1, ids[:1].tobytes())], "sequence long, n_tokens long, ids binary")
    slots.write_shards(rows, 2, str(tmp_path / "s"), 3, "<u4", 4, 8).collect()
    got = slots.read_shards(spark, str(tmp_path / "s"), "<u4", 4, 8, order=(2, 3)).collect()
    assert {r.sequence: np.frombuffer(bytes(r.ids), dtype="<u4").tolist() for r in got} == {0: ids.tolist(), 1: [65_535]}


def test_sequences_are_worked_out_once_on_their_way_to_the_shards(spark, tmp_path):
    """A pass that samples them for range bounds would do so twice."""
    met = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    ids = np.arange(4, dtype="<u4").tobytes()
    rows = spark.createDataFrame([(i, 4, bytearray(ids)) for i in range(50)], "sequence long, n_tokens long, ids binary").repartition(3).mapInArrow(count, "sequence long, n_tokens long, ids binary")
    shards = slots.write_shards(rows, 50, str(tmp_path), 3, "<u4", 4, 8).withColumn("task", F.spark_partition_id()).collect()
    assert met.value == 50
    assert sorted((r.shard, r.slots) for r in shards) == [(i, 8) for i in range(6)] + [(6, 2)]
    assert len({r.task for r in shards}) == 7
    assert sorted(r.sequence for r in slots.read_shards(spark, str(tmp_path), "<u4", 4, 8, order=(50, 3)).collect()) == list(range(50))
