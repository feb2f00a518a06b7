"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size: an offset and a step,
both from the md5 of its name. The shards take turns, and each claims the first slot in its order that is
free, until the table is full. A row's key is hashed to a slot, and the slot names the shard. Shards get
equal parts of the table to within one slot, and when a shard joins or leaves, few other slots move.

Nulls: a null key is placed as the empty string, with which it shares a slot. Repeated rows are placed
alike. An empty table of rows gives an empty result. Other columns, of any name but the two added, pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots at most: at this size the broadcast table takes about 16 MB. It depends on no row.
MAX_SLOTS = 1 << 20


def digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill(shards: Sequence[str], slots: int) -> list[int]:
    """The shard's number for each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need names of their own")
    if not is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"the number of slots must be a prime from the number of shards to {MAX_SLOTS}")
    at = [digest(f"offset:{name}") % slots for name in shards]
    step = [digest(f"skip:{name}") % (slots - 1) + 1 for name in shards]
    owner = [-1] * slots
    for turn in range(slots):
        i = turn % len(shards)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + step[i]) % slots
        owner[at[i]] = i
    return owner


def lookup(spark: SparkSession, owner: Sequence[int]) -> DataFrame:
    """The table as ``(slot, shard)``."""
    text = F.split(F.lit(",".join(map(str, owner))), ",")
    return spark.range(1).select(F.posexplode(text).alias("slot", "shard")).select(F.col("slot").cast("bigint"), F.col("shard").cast("int"))


def slot_of(key: Column, slots: int) -> Column:
    """60 bits of the key's md5, modulo the size of the table."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("bigint") % F.lit(slots)


def hot_keys(df: DataFrame, key: str, shards: int) -> DataFrame:
    """``(key, spread)`` of the keys that have more than a shard's share of the rows; they are fewer than the shards.

    Counts are added up before the shuffle. ``spread`` is the number of parts that bring each below that share.
    """
    counts = df.groupBy(F.col(key).alias("hot_key")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    return counts.where(F.col("n") * shards > total).select("hot_key", F.ceil(F.col("n") * shards / total).cast("int").alias("spread"))


def place(df: DataFrame, key: str, shards: Sequence[str], slots: int, *, spread_by: str | None = None) -> DataFrame:
    """Adds ``slot BIGINT`` and ``shard INT``. No row moves: the lookup table goes to the rows.

    With ``spread_by``, a column that differs within a key, the rows of a key with more than a shard's
    share are dealt over several slots by it; all other keys stay whole.
    """
    own = df[key].cast("string")
    if spread_by is not None:
        hot = hot_keys(df, key, len(shards)).select(F.col("hot_key").alias("__hot"), F.col("spread").alias("__spread"))
        df = df.join(F.broadcast(hot), df[key].eqNullSafe(hot["__hot"]), "left")  # fewer rows than shards, by what hot means
        part = F.pmod(F.xxhash64(spread_by), F.col("__spread").cast("bigint"))
        own = F.when(F.col("__spread").isNotNull(), F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("#"), part.cast("string"))).otherwise(F.col(key).cast("string"))
    kept = [x for x in df.columns if x not in ("slot", "shard", "__hot", "__spread")]
    keyed = df.withColumn("__slot", slot_of(own, slots)).select(*kept, F.col("__slot").alias("slot"))
    return keyed.join(F.broadcast(lookup(df.sparkSession, fill(shards, slots))), "slot", "left").select(*kept, "slot", "shard")


def write(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Placed rows as Parquet, one folder per shard. Tasks write what they hold, so a large shard loads no single task."""
    df.write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
