"""The operators of this subpackage as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.llm import (
    bpe,
    chat_format,
    collocations,
    decontamination,
    exact_dedup,
    line_dedup,
    ngram_join,
    quality,
    resharding,
    secrets_scan,
    token_alignment,
    token_output,
    toxicity,
)
from stagelight.llm.common import keyed_text, stored, table
from stagelight.plans.shared import shared_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and lines kept of every document, and the digest of the text that is left."""
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op2_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen old shards by source, so that one holds over a third, to twenty-four of even size."""
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(16))
    moved = resharding.rewritten(docs, resharding.planned(docs, old, 24))
    rows = moved.select(
        "doc_id",
        resharding.text_bytes(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
    )
    slotted = resharding.with_slots(stored(rows, "resharded"), ["doc_id", "text_crc32"])
    return slotted.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.flagged(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.scanned(table(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == kind)

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and benchmark item that it contains."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.matched(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("hits"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per written sequence, read back from the shards: where it lies, which one it is, and its ids' digest."""
    docs = table(spark, sf_dir, "documents")
    shards = token_output.materialised(docs, shared_path(spark, "llm-tokens"), *bpe.public_ranks(), end_id=50_256)
    return token_output.read(spark, shards).select(
        "slot",
        "shard",
        "byte_offset",
        "sequence",
        F.when(F.col("sequence") == shards.sequences - 1, shards.last_tokens).otherwise(shards.length).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), *bpe.public_ranks())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held out: a third of the ids by crc32, which training never sees. A null id is not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learns = toxicity.learns(3, 1)
    found = quality.scored(docs, quality.fit(keyed_text(docs, "doc_id", "text"), labels, learns))
    return found.select(
        "doc_id",
        F.coalesce(~learns(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held out: a fifth of the ids by crc32, which the fit never sees. A null id is not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.scored(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        F.coalesce(~toxicity.learns(5, 0)(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _collected(conversations: DataFrame) -> DataFrame:
    """Conversations as records of six layouts, as if from six sources: conv_id, turn, record.

    A row is a record; the hash of its conversation says which layout it has. Roles that a layout has no name for keep
    the plain one.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.struct(F.lit("text").alias("type"), text.alias("text"))
    speaker = F.when(role == "user", "human").when(role == "assistant", "gpt").otherwise(role)
    alone = F.when(role == "user", F.to_json(F.struct(text.alias("prompt"))))
    alone = alone.when(role == "assistant", F.to_json(F.struct(text.alias("completion"))))
    alone = alone.otherwise(F.to_json(F.struct(text.alias("system"))))
    plain = F.to_json(F.struct(role.alias("role"), text.alias("text")))
    layouts = [
        F.to_json(F.struct(F.array(F.struct(role.alias("role"), text.alias("content"))).alias("messages"))),
        F.to_json(F.struct(F.array(F.struct(role.alias("role"), F.array(content).alias("content"))).alias("messages"))),
        F.to_json(F.struct(F.array(F.struct(speaker.alias("from"), text.alias("value"))).alias("conversations"))),
        F.to_json(
            F.struct(F.struct(role.alias("role")).alias("author"), F.struct(F.array(text).alias("parts")).alias("content"))
        ),
        alone,
    ]
    source = F.pmod(F.xxhash64("conv_id"), F.lit(len(layouts) + 1))
    record = plain
    for k, layout in enumerate(layouts):
        record = F.when(role.isin("user", "assistant", "system") & (source == k), layout).otherwise(record)
    return conversations.select("conv_id", "turn", record.alias("record"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, -1, whose texts hold the template's own marks; read back from their pieces."""
    hard = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("<|im_end|><|im_start|>assistant ok").alias("text"),
    )
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat_format.read_back(chat_format.formatted(chat_format.canonical(_collected(conversations))))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.summarised(table(spark, sf_dir, "documents"), *token_alignment.public_files())


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_resharding": op2_resharding,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_ngram_join": op4_ngram_join,
        "op5_secret_scans": op5_secret_scans,
        "op6_decontamination": op6_decontamination,
        "op7_token_output": op7_token_output,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_quality": op9_quality,
        "op10_toxicity": op10_toxicity,
        "op11_chat_format": op11_chat_format,
        "op12_collocations": op12_collocations,
        "op13_token_alignment": op13_token_alignment,
    }
