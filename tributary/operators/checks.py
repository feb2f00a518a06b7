"""Extensions: membership in the taxonomy, outcome counts, lint. Nothing here changes or drops a result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIORITIES = ("High", "Medium", "Low")

#: Entries up to which a taxonomy is broadcast; it is a job parameter, counted on the driver. Beyond it, Spark joins as it likes.
BROADCAST_ENTRIES = 100_000


def small(df: DataFrame, entries: int) -> DataFrame:
    return F.broadcast(df) if entries <= BROADCAST_ENTRIES else df


def membership(results: DataFrame, taxonomy: DataFrame, entries: int, key: str = "feedback_id") -> DataFrame:
    """``(key, class_ok, leaf_ok, priority_ok)``; the leaf is looked up together with its class."""
    classes = small(taxonomy.select(F.col("class").alias("prediction_class")).distinct().withColumn("class_ok", F.lit(True)), entries)
    leaves = small(taxonomy.select(F.col("class").alias("prediction_class"), F.col("leaf").alias("attribution")).distinct().withColumn("leaf_ok", F.lit(True)), entries)
    joined = results.join(classes, "prediction_class", "left").join(leaves, ["prediction_class", "attribution"], "left")
    return joined.select(
        key,
        F.coalesce("class_ok", F.lit(False)).alias("class_ok"),
        F.coalesce("leaf_ok", F.lit(False)).alias("leaf_ok"),
        F.coalesce(F.col("priority").isin(*PRIORITIES), F.lit(False)).alias("priority_ok"),
    )


def outside(results: DataFrame, taxonomy: DataFrame, entries: int) -> DataFrame:
    """The rows whose class the taxonomy lacks; the fallback record's class is one of these."""
    return results.join(small(taxonomy.select(F.col("class").alias("prediction_class")).distinct(), entries), "prediction_class", "left_anti")


def outcomes(results: DataFrame) -> DataFrame:
    """Rows by status, class, priority and class of error."""
    return results.groupBy("status", "prediction_class", "priority", "error_class").agg(F.count("*").alias("n"))


def lint(taxonomy: DataFrame) -> DataFrame:
    """Leaves that are empty or stand under several classes: ``(leaf, n_classes, n_entries)``."""
    counted = taxonomy.groupBy("leaf").agg(F.countDistinct("class").alias("n_classes"), F.count("*").alias("n_entries"))
    return counted.where((F.col("n_classes") > 1) | (F.col("leaf") == ""))
