"""Feedback as ``(feedback_id, feedback STRING)`` from the tables at hand or from files; ids are of any type, BIGINT where files are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "feedback_id BIGINT, feedback STRING"


def from_table(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Any table with an id and a text; other columns are pruned at the scan."""
    return df.select(df[id_column].cast("bigint").alias("feedback_id"), df[text_column].cast("string").alias("feedback"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_table(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")


def user_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user's turns of ``conversations``, named ``conversation:turn``; the filter reaches the scan."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").where(F.col("role") == "user")
    return turns.select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("feedback_id"), F.col("text").alias("feedback"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the two columns; no inference pass over the files."""
    return spark.read.schema(SCHEMA).json(path)
