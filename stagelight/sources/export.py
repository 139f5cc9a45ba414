"""CSV export for dashboards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _plain(field: T.StructField) -> Column:
    """Fractional numbers in fixed notation, whole ones without a fraction: 7, not 7.0, and 12345678, not 1.2345678E7.

    From 10^28 on and below 10^-20 they keep the exponent.
    """
    number = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return number
    size, text = F.abs(number), number.cast("string")
    fixed = F.when((size >= 1e7) & (size < 1e28), text.try_cast("decimal(38,9)").cast("string"))
    fixed = fixed.when((size < 1e-3) & (size >= 1e-20), text.try_cast("decimal(38,37)").cast("string")).otherwise(text)
    whole = F.regexp_replace(fixed, r"\.0+$", "")
    shown = F.when(fixed.rlike("[.][0-9]*[1-9]0+$"), F.regexp_replace(fixed, "0+$", "")).otherwise(whole)
    return shown.alias(field.name)


def export_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` as CSV without a header, replacing what is there.

    The parts, in order of name, hold the rows in the order of ``df``. Adaptive execution makes one part of a result
    with a few rows; larger ones are written in parallel, sorted or not.
    """
    df.select([_plain(f) for f in df.schema]).write.mode("overwrite").option("header", False).csv(path)


def export_results(results: Mapping[str, DataFrame], folder: str) -> None:
    """Export each result to its own directory ``<name>.csv`` under ``folder``."""
    for name, df in results.items():
        export_csv(df, f"{folder}/{name}.csv")
