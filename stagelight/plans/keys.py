"""Surrogate keys without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stagelight.plans.shared import written


def numbered(values: DataFrame) -> DataFrame:
    """Number the distinct (column_name, value) rows 1..n per column_name in order of value.

    The rows are range-partitioned and written once, so each row's partition is settled. A row's key is its position
    in its partition plus the rows in the partitions before; only one count per partition is ever put together. The
    first write also cuts off the scan of the source, which is read a single time.
    """
    order = ["column_name", "value"]
    ranged = values.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    parts = written(ranged, "values")
    before = W.partitionBy("column_name").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.groupBy("column_name", "part").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("column_name", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    position = F.row_number().over(W.partitionBy("column_name", "part").orderBy("value"))
    keyed = parts.join(starts, ["column_name", "part"])
    return keyed.select("column_name", (F.col("start") + position).cast("int").alias("key"), "value")
