"""Joins that no single key can hold up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than one in this many rows is dealt over several parts; there are fewer such keys than this.
PARTS = 256


def lookup(rows: DataFrame, facts: DataFrame, keys: Sequence[str], *, parts: int = PARTS, counted: DataFrame | None = None, how: str = "left") -> DataFrame:
    """Join of ``rows`` with ``facts``, which has one row a key; null keys meet, and the keys stand once in the result.

    Keys are counted at once, added up before the shuffle. Of those with more than one in ``parts`` rows, fewer than
    ``parts`` by what that means, the hashes come to the driver; their rows are dealt by a hash of all columns over as
    many parts as bring each below that share, and their facts are repeated for each part. All other keys are joined as
    they are. ``counted`` has the rows' keys where counting them in ``rows`` would make these twice.
    """
    whole = F.xxhash64(*keys)
    counts = (rows if counted is None else counted).groupBy(whole.alias("hash")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    hot = {r["hash"]: r["spread"] for r in counts.where(F.col("n") * parts > total).select("hash", F.ceil(F.col("n") * parts / total).cast("int").alias("spread")).collect()}
    same = F.lit(True)
    dealt = facts
    if hot:
        spread: Column = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
        rows = rows.withColumn("__part", F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.element_at(spread, whole)), F.lit(0)))
        dealt = dealt.withColumn("__with", F.explode(F.sequence(F.lit(0), F.coalesce(F.element_at(spread, whole), F.lit(1)) - 1)))
        same = F.col("__part") == F.col("__with")
    for i, key in enumerate(keys):
        dealt = dealt.withColumnRenamed(key, f"__key{i}")
        same = same & F.col(key).eqNullSafe(F.col(f"__key{i}"))
    return rows.join(dealt, same, how).drop("__part", "__with", *[f"__key{i}" for i in range(len(keys))])
