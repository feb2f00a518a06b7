"""Written tables in the folder that driver and executors share: plans start anew from files that outlive any executor."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_MADE: list[tuple[SparkSession, str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where that is unset, a session within one machine gets a folder under its warehouse; any other is an error, as a
    folder of the driver's machine would be out of the executors' sight.
    """
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"


def materialize(df: DataFrame, path: str | None = None, name: str = "tributary") -> DataFrame:
    """The rows as Parquet, written once and read again: under ``path``, which stays, or in the shared folder.

    What is written to the shared folder goes with ``clear`` or at the end of the process.
    """
    spark = df.sparkSession
    if path is None:
        path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        _MADE.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear() -> None:
    """Removes what this process has written to the shared folder; for callers that have read their results."""
    while _MADE:
        spark, path = _MADE.pop()
        try:
            remove(spark, path)
        except Exception:  # the session has gone, and with it the way to the files
            return


atexit.register(clear)
