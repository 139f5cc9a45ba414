"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stagelight.plans.shared import scratch, shared_path

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of every executor, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="stagelight-code-"), "stagelight_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = shared_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Build a table, write it to the shared folder, and remove what building it wrote there."""
    path = shared_path(spark, f"llm-{label}")
    with scratch(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names differ by more than case)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names; a null text counts as empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))


def arrow_rows(schema: StructType | str, columns: dict) -> pa.RecordBatch:
    """A record batch from columns of Python or numpy values, in order."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns)
    )


def in_pieces(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20):
    """Slices of a batch with about ``limit`` bytes of text each; one row at least, never part of a text."""
    lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
    start, size = 0, 0
    for row, length in enumerate(lengths):
        if row > start and size + (length or 0) > limit:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += length or 0
    if start < batch.num_rows:
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()


#: A chunk of bitmap_construct_agg has this many bits.
CHUNK_BITS = 32_768


def bit_field(positions: DataFrame, bits: int) -> np.ndarray:
    """The set of values of column ``at``, from 0 to ``bits`` - 1, as bits. The driver receives ``bits`` / 8 bytes."""
    chunks = positions.groupBy(F.floor(F.col("at") / CHUNK_BITS).alias("chunk")).agg(
        F.bitmap_construct_agg(F.col("at") % CHUNK_BITS).alias("bits")
    )
    field = np.zeros(bits // 8, dtype=np.uint8)
    for row in chunks.collect():
        start = row["chunk"] * (CHUNK_BITS // 8)
        part = np.frombuffer(row["bits"], dtype=np.uint8)[: len(field) - start]
        field[start : start + len(part)] = part
    return field


def bits_at(field: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (field[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def field_size(rows: int, max_bits: int) -> int:
    """Bits for so many rows: sixteen each as a power of two, at most ``max_bits``."""
    return min(max_bits, 1 << max(16, (16 * rows).bit_length()))
