"""Registered queries of the operators here. Each reads the given tables whole and returns its operator's full result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.llm import bpe, chat, infill, manifest, merkle, packing, pii, quality, repeats, rpforest, setjoin, slots, toxicity
from pagetables.llm.common import text_or_empty
from pagetables.llm.tokens import id_type
from pagetables.plans.workspace import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored, _ = quality.score_documents(docs, labels, new_folder(spark, "quality"))
    return scored.select("doc_id", "score", (F.col("score") >= quality.KEPT_FROM).alias("kept"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = _table(spark, sf_dir, "documents").select("doc_id", bpe.round_trip(spark, path, pattern)(text_or_empty("text")).alias("coded"))
    return coded.select(
        "doc_id",
        F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.ids_text(F.col("coded.ids")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


def op3_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = merkle.edited_with_next(_table(spark, sf_dir, "documents"))
    marked = pairs.select("*", merkle.fingerprint(F.col("edited")).alias("edited_fingerprint"))
    return marked.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        merkle.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        merkle.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return rpforest.nearest(vectors, F.col("vec_id") % 100 == 0, new_folder(spark, "forest"))


ORDER_KEY = 20_260


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slot, as read back from the shards, beside what its number says it must hold."""
    path, folder = public_tokenizers.path("word_bpe_49k.json"), new_folder(spark, "order")
    sequences, shards, total = slots.materialise(_table(spark, sf_dir, "documents"), path, folder, ORDER_KEY)
    held = sequences.select("sequence", "doc_ids")
    if not total:
        return held.select(F.lit(0).cast("long").alias("slot"), "sequence", F.lit(0).cast("long").alias("shard"),
                           F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("ids_crc32"), "doc_ids")
    read = slots.read_shards(spark, f"{folder}/shards", id_type(path), order=(total, ORDER_KEY))
    found = read.select("slot", "sequence", "shard", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return found.join(held, "sequence").select("slot", "sequence", "shard", "n_tokens", "ids_crc32", "doc_ids")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = setjoin.join_sets(_table(spark, sf_dir, "documents"), new_folder(spark, "setjoin"))
    return setjoin.smallest_ids(members, "n_links").select("doc_id", F.col("size").alias("n_shingles"), "component_id", "n_links")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = toxicity.score_documents(docs, labels, new_folder(spark, "toxicity"))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("evidence.doc_id").alias("nearest_doc_ids"),
    )


CHAT_CASE = "\\### Assistant: </turn> ok"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    case = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CHAT_CASE).alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(case)
    formatted = chat.format_conversations(turns.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts")))
    read = formatted.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat.read_loss_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
    )
    as_lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(as_lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    spans = docs.select("doc_id", pii.finder(docs, pii.fit(docs))(text_or_empty("text")).alias("spans"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return spans.select(
        "doc_id", *map(count, pii.KINDS),
        F.sha2(pii.span_text(F.col("spans"), only_base=True).cast("binary"), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.fill_in_middle(_table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify(manifest.manifest(_table(spark, sf_dir, "documents")))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return cleaned.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_merkle": op3_merkle,
    "op4_nearest": op4_nearest,
    "op5_training_order": op5_training_order,
    "op6_packing": op6_packing,
    "op7_set_join": op7_set_join,
    "op8_toxicity": op8_toxicity,
    "op9_chat_format": op9_chat_format,
    "op10_pii": op10_pii,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_manifest": op12_manifest,
    "op13_repeats": op13_repeats,
}
