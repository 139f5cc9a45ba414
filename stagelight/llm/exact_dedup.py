"""Exact deduplication in two passes over a Bloom filter.

Pass one hashes every normalised text to positions of a bit field and keeps the positions that two rows or more hit: a
Bloom filter of possibly repeated texts. Pass two tests every row against it. A row that it rules out is unique and
passes straight through; only the others are shuffled and compared by SHA-256. A full filter sends more rows through
the shuffle but never changes a result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import bit_field, bits_at, field_size, keyed_text, ship, stored, unused

#: Fixed value: the characters that do not count.
SPACES = r"[\x20\x09-\x0D]"
SEEDS = (11, 12)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def _digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _positions(digest: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), digest), F.lit(bits)) for seed in SEEDS]


def maybe_repeated(digests: DataFrame, max_bits: int) -> Callable[[Column], Column]:
    """The filter over column ``text_sha256`` of ``digests``, as a test of a digest column.

    It holds, per hash seed, the positions that two rows or more hit.
    """
    spark = digests.sparkSession
    ship(spark)
    bits = field_size(digests.count(), max_bits)
    fields = []
    for at in _positions(F.col("text_sha256"), bits):
        # Combined before the shuffle: a text that a third of all rows share sends one count per task.
        often = digests.groupBy(at.alias("at")).count().where("count > 1")
        fields.append(bit_field(often, bits))
    shared = spark.sparkContext.broadcast(fields)  # bits / 8 bytes per seed, whatever the input

    @F.arrow_udf("boolean")
    def admitted(first: pa.Array, second: pa.Array) -> pa.Array:
        hit = np.ones(len(first), dtype=bool)
        for field, at in zip(shared.value, (first.to_numpy(), second.to_numpy()), strict=True):
            hit &= bits_at(field, at)
        return pa.array(hit)

    return lambda digest: admitted(*_positions(digest, bits))


def flagged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 28) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without the characters of ``SPACES``; a null text counts as empty, and
    empty texts equal each other. Of equal texts the row with the most code points stays, then the one with the
    smallest id; a null id comes last. Rows that repeat both id and length of the kept row are flagged kept with it.
    Other columns of ``docs`` are not read. An empty table gives an empty result. The filter takes ``max_bits`` bits
    per seed at most; beyond a sixteenth as many rows it admits more rows to the shuffle.
    """
    rows = keyed_text(docs, id_col, text_col)
    points, digest = F.length("text").cast("long").alias("points"), _digest(F.col("text")).alias("text_sha256")
    rows = stored(rows.select("doc_id", points, digest), "digests")
    tested = rows.withColumn("maybe", maybe_repeated(rows, max_bits)(F.col("text_sha256")))
    single = tested.where(~F.col("maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    several = tested.where("maybe")
    rank = F.struct(
        (-F.col("points")).alias("shortness"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id")
    )
    groups = several.groupBy("text_sha256").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = stored(groups, "groups")  # read back, so that adaptive execution can split a hot text in the join
    joined = several.join(groups, "text_sha256")
    kept = F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("points") == -F.col("best.shortness"))
    return single.unionByName(
        joined.select("doc_id", F.col("best.id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")
    )


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 28
) -> DataFrame:
    """``docs`` with exactly one row of each group of equal texts, chosen as in ``flagged``; all columns stay.

    Rows that the filter rules out are not shuffled; of the others each task sends on one row per text at most. Rows
    alike in length and id are chosen between by a hash of their original text.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    test = maybe_repeated(stored(docs.select(_digest(text).alias("text_sha256")), "digests"), max_bits)
    digest, maybe = unused(docs, "digest"), unused(docs, "maybe")
    tested = docs.withColumn(digest, _digest(text))
    tested = tested.withColumn(maybe, test(F.col(digest)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    identity = F.col(f"`{id_col}`")
    rank = F.struct((-F.length(text)).alias("a"), identity.isNull().alias("b"), identity.alias("c"), F.xxhash64(text))
    several = tested.where(F.col(maybe)).groupBy(digest).agg(F.min_by(F.struct(*columns), rank).alias("row"))
    return tested.where(~F.col(maybe)).select(*columns).unionByName(several.select("row.*"))
