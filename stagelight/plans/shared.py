"""Tables written to the folder all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode with nothing set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stagelight-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


#: Paths handed out and not removed yet, oldest first.
_handed_out: list[str] = []


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder. What is written there stays until ``remove_written`` or ``scratch``."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever file system holds it; nothing happens if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def remove_written(spark: SparkSession, since: int = 0) -> None:
    """Remove the intermediate tables of this process. Results that still read them can no longer be computed."""
    for path in _handed_out[since:]:
        remove(spark, path)
    del _handed_out[since:]


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what is written to the shared folder inside."""
    begun = len(_handed_out)
    try:
        yield
    finally:
        remove_written(spark, begun)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives Catalyst the real size, so it broadcasts the table
    only if that size is under the session's limit. Without compression the files are as large as the values in them,
    where long texts that compress well would pass for a small table.
    """
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "uncompressed").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
