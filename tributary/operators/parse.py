"""Replies to typed rows: cleaning, JSON, and the fixed record where either fails."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.functions.response import clean

FIELDS = ("prediction_class", "attribution", "priority", "reason")

# The record that stands in for a failed call or parse.
FALLBACK = {"prediction_class": "未分类", "attribution": "解析失败", "priority": "Low"}
ERROR_PREFIX = "System Error: "

PARSED = ("raw_json", *FIELDS, "parse_class", "parse_text")


def as_text(value: object) -> str:
    """JSON text that Spark can hold; lone surrogates stay escaped."""
    try:
        (text := json.dumps(value, ensure_ascii=False)).encode("utf-8")
        return text
    except UnicodeEncodeError:
        return json.dumps(value)


def project(value: object) -> list[str | None]:
    """The four fields of an object; strings as they are, other values as JSON text, missing ones null."""
    if not isinstance(value, dict):
        return [None] * len(FIELDS)
    fields = [value.get(x) for x in FIELDS]
    return [x if x is None or (isinstance(x, str) and x.isascii()) else x.encode("utf-8", "replace").decode("utf-8") if isinstance(x, str) else as_text(x) for x in fields]


def parse_one(text: str) -> tuple:
    try:
        value = json.loads(text)
        return (as_text(value), *project(value), None, None)
    except Exception as error:
        return (None, *[None] * len(FIELDS), type(error).__name__, str(error))


def parse_json(df: DataFrame, column: str) -> DataFrame:
    """Adds the columns of PARSED. Python's parser decides: it takes ``NaN``, the last of equal keys and any JSON value, and no text after it.

    Null stays null in all of them. Other columns pass as Arrow arrays, untouched; those named like one of PARSED are replaced.
    """
    kept = [x for x in df.columns if x not in PARSED]
    rows = df.select(*kept, df[column].alias("__reply"))
    schema = StructType([rows.schema[x] for x in kept])
    for name in PARSED:
        schema = schema.add(name, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [parse_one(x.as_py()) if x.is_valid else (None,) * len(PARSED) for x in batch.column(len(kept))]
            made = [pa.array([x[i] for x in got], pa.string()) for i in range(len(PARSED))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], schema.fieldNames())

    return rows.mapInArrow(run, schema)


def results(responses: DataFrame, key: str = "feedback_id", mode: str = "compat") -> DataFrame:
    """``(key, status, error_class, error_text, raw_json, four fields)`` from the table that ``infer`` made.

    ``status`` is ``ok`` or ``fallback``. A parsed value that is not an object, or lacks keys, is ``ok``
    with null fields; nothing is validated here. A row with neither response nor error counts as a reply
    of None.
    """
    cleaned = responses.withColumn("c", clean(F.col("response"), mode)).select(
        F.col(key).alias("key"),
        F.coalesce("error_class", F.when(F.col("c.error").isNotNull(), "IndexError"), F.when(F.col("response").isNull(), "AttributeError")).alias("early_class"),
        F.coalesce("error_text", "c.error", F.when(F.col("response").isNull(), "'NoneType' object has no attribute 'strip'")).alias("early_text"),
        F.when(F.col("error_class").isNull(), F.col("c.cleaned")).alias("cleaned"),
    )
    parsed = parse_json(cleaned, "cleaned")
    text = F.coalesce("early_text", "parse_text")
    failed = F.coalesce("early_class", "parse_class").isNotNull()
    fields = [F.when(failed, F.lit(FALLBACK[x])).otherwise(F.col(x)).alias(x) for x in FIELDS[:3]]
    return parsed.select(
        F.col("key").alias(key),
        F.when(failed, "fallback").otherwise("ok").alias("status"),
        F.coalesce("early_class", "parse_class").alias("error_class"),
        text.alias("error_text"),
        F.when(~failed, F.col("raw_json")).alias("raw_json"),
        *fields,
        F.when(failed, F.concat(F.lit(ERROR_PREFIX), F.coalesce(text, F.lit("")))).otherwise(F.col("reason")).alias("reason"),
    )
