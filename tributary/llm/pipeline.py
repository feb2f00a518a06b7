"""A corpus in five stages: quality, near duplicates, benchmark passages, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last return the
columns of ``documents``. Their output is written as Parquet and read again between stages.

In all stages: a null text counts as empty (it fails the quality stage and so goes there), null ids take part like
any other, repeated rows are judged alike (the near duplicates keep one of them), an empty table gives an empty table,
texts of any length are read whole, and other columns, whatever their names, pass unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bpe, decontaminate, neardup, pii, quality
from tributary.llm.scratch import saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Percent of the union of two texts' five-word shingles that makes them near duplicates.
NEAR = 80
#: A document with passages of this many benchmark items goes; from others the passages are cut.
ITEMS = 2


def packed(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, others)``: no column of the documents meets one that an operator adds."""
    others = [x for x in docs.columns if x not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(0).alias("_")).alias("others"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as they were; ``n_chars`` follows the text, which may have changed."""

    def one(name: str) -> Column:
        if name in ("doc_id", "text"):
            return F.col(name)
        own = F.col("others")[name]
        return (F.when(F.col("changed"), F.length("text").cast("bigint")).otherwise(own) if name == "n_chars" else own).alias(name)

    return df.select(*map(one, columns))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that fail the base rules, or are bad by the weighed votes, go; at a probability of just a half they stay."""
    kept = quality.judge(packed(docs)).where("kept")
    return unpacked(kept.withColumn("changed", F.lit(False)), docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays; a null id only in groups without any other."""
    return neardup.keep_one(docs, percent=NEAR)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of several items go; single passages are cut out; all else stays as it is."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.find(packed(docs), benchmark, trim=True).where(F.size("found.items") < ITEMS)
    return unpacked(found.withColumn("changed", F.size("found.hits") > 0), docs.columns)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets give way to their kind in brackets; overlapping ones to the first's."""
    found = pii.find(packed(docs)).withColumn("text", pii.mask(F.col("text"), F.col("pii")))
    return unpacked(found.withColumn("changed", F.size("pii") > 0), docs.columns)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang`` and ``source`` with the number of tokens and the digests of the ids and of the text they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("benchmark", without_benchmark),
    ("personal_data", masked),
    ("tokens", tokenised),
]

#: The quality stage fits a model and the near duplicates take components of a graph; tests hold both against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
