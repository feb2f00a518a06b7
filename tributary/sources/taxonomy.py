"""A two-level taxonomy: ordered classes, each with ordered leaves.

The mapping is a job parameter of a few hundred strings, so it lives on the driver; as a table it is
``(class_ord, class, leaf_ord, leaf)``. A leaf alone is not a key: the same string may stand under
several classes, and may be empty.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Taxonomy = Mapping[str, Sequence[str]]

#: A taxonomy for tests and demonstrations: one leaf under two classes, one empty leaf, one not in ASCII.
SAMPLE: dict[str, list[str]] = {
    "Accounts": ["sign-in fails", "password reset (mail/text)", "profile: picture, name"],
    "Payments": ["charged twice", "refund missing", "sign-in fails"],
    "Display": ["text overlaps", "", "Schaltfläche fehlt"],
    "Network": ["slow loading", "lost connection"],
}


def load(path: str, spark: SparkSession | None = None) -> dict[str, list[str]]:
    """Reads the mapping from a JSON object file; with a session, through Spark's file systems."""
    if spark is None:
        text = Path(path).read_text(encoding="utf-8")
    else:
        text = spark.read.text(path, wholetext=True).first()[0]
    return validated(json.loads(text))


def validated(mapping: object) -> dict[str, list[str]]:
    """The mapping itself, or a TypeError that says what is wrong with its shape."""
    if not isinstance(mapping, Mapping):
        raise TypeError("a taxonomy is an object of class -> list of leaves")
    for name, leaves in mapping.items():
        if not isinstance(name, str) or isinstance(leaves, str) or not all(isinstance(x, str) for x in leaves):
            raise TypeError(f"class {name!r} must be a string with a list of strings")
    return {name: list(leaves) for name, leaves in mapping.items()}


def nested(spark: SparkSession, taxonomy: Taxonomy) -> DataFrame:
    """One row per class: ``(class_ord, class, leaves)``."""
    rows = [(i, name, list(leaves)) for i, (name, leaves) in enumerate(taxonomy.items())]
    return spark.createDataFrame(rows, "class_ord INT, class STRING, leaves ARRAY<STRING>")


def table(spark: SparkSession, taxonomy: Taxonomy) -> DataFrame:
    """One row per leaf entry: ``(class_ord, class, leaf_ord, leaf)``; a class without leaves has no row."""
    return nested(spark, taxonomy).select("class_ord", "class", F.posexplode("leaves").alias("leaf_ord", "leaf"))


def as_json(taxonomy: Taxonomy) -> str:
    """The text that stands in the prompt: indented by two, characters as they are, in the given order."""
    return json.dumps(taxonomy, ensure_ascii=False, indent=2)
