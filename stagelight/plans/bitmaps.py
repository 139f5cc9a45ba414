"""Sets of integral keys as bits: a chunk stands for 256 keys that follow each other and holds a bit for each in four
longs.

Chunks are made in the task, combined by a plain hash aggregation in generated code, and met by chunk number, so a
shuffle moves a fraction of a byte for each of a dense row of keys and one small row for a key that stands alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = ["b0", "b1", "b2", "b3"]
INDEX = "chunk long, n long, b0 long, b1 long, b2 long, b3 long"


def chunk_of(key: Column) -> Column:
    """The chunk of an integral key or a date."""
    return F.shiftright(key, 8)


def as_long(key: Column, kind: str) -> Column:
    """An integral key or date as a long; dates are days since 1970."""
    return (F.unix_date(key) if kind == "date" else key).cast("long")


def is_integral(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint", "date")


def bits_of(key: Column, where: Column | None = None, prefix: str = "") -> list[Column]:
    """Aggregates: the bits of the keys of one chunk, of those rows alone that ``where`` admits."""
    word = F.shiftright(key, 6).bitwiseAND(F.lit(3))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))
    if where is not None:
        word = F.when(where, word)
    return [
        F.coalesce(F.bit_or(F.when(word == k, bit)), F.lit(0).cast("long")).alias(prefix + name)
        for k, name in enumerate(BITS)
    ]


def count_bits(bits: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.bit_count(b) for b in bits])


def key_index(rows: DataFrame, column: str) -> DataFrame:
    """Chunks of a key column with the number of rows in each; rows without a key are a chunk of their own, NULL."""
    key = F.col(column).cast("long")
    return rows.groupBy(chunk_of(key).alias("chunk")).agg(F.count(F.lit(1)).alias("n"), *bits_of(key))


def unfolded(chunks: DataFrame, key: str) -> DataFrame:
    """The keys whose bits are set, one row each."""
    parts = [F.struct((F.col("chunk") * 4 + k).alias("word"), F.col(name).alias("bits")) for k, name in enumerate(BITS)]
    words = chunks.select(F.inline(F.array(*parts))).where(F.col("bits") != 0)
    places = words.select("word", "bits", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("place"))
    is_set = F.call_function("shiftright", F.col("bits"), F.col("place")).bitwiseAND(F.lit(1)) == 1
    return places.where(is_set).select((F.col("word") * 64 + F.col("place")).alias(key))
