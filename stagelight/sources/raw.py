"""The raw input: one row per application, read as text and converted column by column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from stagelight.schemas import RAW, RAW_SOURCE_NAMES

#: A CSV line with too many or too few fields, as it stands in the file; NULL for a sound line.
BROKEN_LINE = "_broken_line"


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def text_reader(
    reader: DataFrameReader | DataStreamReader, fmt: str = "csv", extra: Sequence[str] = ()
) -> DataFrameReader | DataStreamReader:
    """A reader of raw files in any format Spark reads; text formats are read as text, without inference.

    ``extra`` names columns that the files have after the known ones. CSV has a header, which must match all of them;
    a line with another number of fields is marked in ``BROKEN_LINE``.
    """
    names = [*RAW_SOURCE_NAMES, *extra]
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN_LINE)
        reader = reader.option("columnPruning", False)  # a pruned reader does not count fields
        names = [*names, BROKEN_LINE]
    if fmt in ("csv", "json"):
        reader = reader.schema(_text_schema(names))
    return reader.format(fmt)


def read_raw_text(spark: SparkSession, path: str, fmt: str = "csv", extra: Sequence[str] = ()) -> DataFrame:
    """The raw files with every column as text, under our column names; ``extra`` columns keep theirs."""
    return rename_raw(text_reader(spark.read, fmt, extra).load(path), extra)


def rename_raw(source: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Rename the file's columns to ours and make all of them text. Broken lines stay marked where they can be."""
    renamed = zip(RAW_SOURCE_NAMES, RAW.names, strict=True)
    columns = [F.col(f"`{theirs}`").cast("string").alias(ours) for theirs, ours in renamed]
    kept = [*extra, *([BROKEN_LINE] if BROKEN_LINE in source.columns else [])]
    return source.select(*columns, *[F.col(f"`{name}`").cast("string") for name in kept])


def _converted(field: T.StructField) -> Column:
    """The text as the field's type, NULL if it is not one. Whole numbers may be written with a fraction: 4500.0."""
    text = F.col(field.name)
    value = text.try_cast(field.dataType)
    if isinstance(field.dataType, T.IntegralType):
        number = text.try_cast("double")
        value = F.coalesce(value, F.when(number == F.rint(number), number.try_cast(field.dataType)))
    return value


def typed(text: DataFrame) -> DataFrame:
    """Convert to the types of ``RAW``; text that does not convert becomes NULL and the row stays.

    Columns beyond ``RAW`` stay as they are. The mark of a broken line goes: count those with ``cast_failures``.
    """
    more = [F.col(f"`{c}`") for c in text.columns if c not in {*RAW.names, BROKEN_LINE}]
    return text.select(*[_converted(f).alias(f.name) for f in RAW], *more)


def cast_failures(text: DataFrame) -> DataFrame:
    """Per converted column: how many non-NULL texts ``typed`` would turn into NULL. One pass.

    Of CSV text also, as ``BROKEN_LINE``, how many lines have too many or too few fields: the surplus is not in the
    columns, and what is missing is NULL.
    """
    fields = [f for f in RAW if not isinstance(f.dataType, T.StringType)]
    failed = [F.count_if(F.col(f.name).isNotNull() & _converted(f).isNull()).alias(f.name) for f in fields]
    names = [f.name for f in fields]
    if BROKEN_LINE in text.columns:
        failed.append(F.count_if(F.col(BROKEN_LINE).isNotNull()).alias(BROKEN_LINE))
        names.append(BROKEN_LINE)
    return text.agg(*failed).unpivot([], names, "column_name", "failed_casts")


def read_raw(spark: SparkSession, path: str, fmt: str = "csv", extra: Sequence[str] = ()) -> DataFrame:
    return typed(read_raw_text(spark, path, fmt, extra))
