"""Facts in buckets of the application, sorted by it: their joins and groupings by application need no shuffle.

Spark keeps a bucketed layout in its catalog. The tables here are external, at a folder that the caller names, and
``read_bucketed`` registers them in any session from a line in ``_layout``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.plans.shared import remove
from stagelight.schemas import TABLES

KEY = "application_id"
FACTS = ["fact_application", "fact_stage_event"]
LAYOUT = "name string, buckets int"
#: Events that an application may have at most in a bucketed fact: all its events share a bucket.
MOST_EVENTS = 10_000


def _registered(folder: str, name: str) -> str:
    """The catalog's name of a table at a folder."""
    return f"stagelight_{name}_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"


def refuse_hot(rows: DataFrame, most: int = MOST_EVENTS) -> None:
    """Fail if an application has over ``most`` rows, which would make one bucket as large; counted map-side first."""
    counts = rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    found = counts.agg(F.count(F.lit(1)).alias("hot"), F.max("n").alias("n")).first()
    if found.hot:
        raise ValueError(f"{found.hot} applications have over {most} rows, one of them {found.n}: not for buckets")


def write_bucketed(facts: dict[str, DataFrame], folder: str, buckets: int) -> dict[str, DataFrame]:
    """Store both facts under ``folder`` in the same number of buckets, each one file, and read them back.

    Each is shuffled once, here, and never again for a join or grouping by application. Take as many buckets as keep one
    near a gigabyte, and at least as many as there are cores. The folder must be new. An application with more than
    ``MOST_EVENTS`` rows stops the call before anything is written; such facts stay in their plain layout, where adaptive
    execution can split a hot key.
    """
    spark = next(iter(facts.values())).sparkSession
    for name in FACTS:
        refuse_hot(facts[name])
    try:
        for name in FACTS:
            rows = facts[name].select(TABLES[name].names).repartition(buckets, KEY)
            table = _registered(folder, name)
            spark.sql(f"drop table if exists {table}")
            rows.write.bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{folder}/{name}").saveAsTable(table)
        layout = spark.createDataFrame([(name, buckets) for name in FACTS], LAYOUT)
        layout.coalesce(1).write.json(f"{folder}/_layout")
    except BaseException:
        forget_bucketed(spark, folder)
        for name in FACTS:
            remove(spark, f"{folder}/{name}")
        raise
    return read_bucketed(spark, folder)


def read_bucketed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The facts under ``folder`` with their layout known to Catalyst; a session that does not know them registers them."""
    found = {}
    for row in spark.read.schema(LAYOUT).json(f"{folder}/_layout").collect():
        table = _registered(folder, row.name)
        place = f"{folder}/{row.name}".replace("'", "\\'")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES[row.name])
        spark.sql(
            f"create table if not exists {table} ({columns}) using parquet clustered by ({KEY}) sorted by ({KEY}) "
            f"into {row.buckets} buckets location '{place}'"
        )
        found[row.name] = spark.table(table)
    return found


def forget_bucketed(spark: SparkSession, folder: str) -> None:
    """Take the facts under ``folder`` out of the session's catalog; their files stay."""
    for name in FACTS:
        spark.sql(f"drop table if exists {_registered(folder, name)}")
