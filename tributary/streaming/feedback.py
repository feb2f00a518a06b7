"""Feedback that keeps arriving. The stages are narrow and stateless, so a stream runs the batch plan."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tributary.plans.classifier import Classifier
from tributary.sources.feedback import SCHEMA


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = SCHEMA, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)


def classify_stream(classifier: Classifier, feedback: DataFrame, out: str, checkpoint: str, **trigger: Any) -> StreamingQuery:
    """Writes results to ``out``, a folder per micro-batch (``batch=N``) that a repeated batch overwrites.

    Within a micro-batch the replies are written before they are parsed, so its two stages do not call twice.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        classifier.classify(batch).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    return feedback.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
