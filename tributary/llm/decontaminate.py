"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, against all documents' windows.

Words are runs of digits, a-z and anything beyond ASCII, after A-Z become lower case. A benchmark item's windows
are its runs of ``size`` words; an item of fewer words, but not none, is one window. Words of the benchmark are
numbered; a document's words are looked up, runs of known words are hashed, hashes that the set holds are verified
word by word, and every word inside a verified window is hit.

The set goes to the workers in blocks of at most ``BLOCK_BYTES`` of benchmark text, whatever the benchmark's size:
one block is broadcast at a time, all documents are scanned against it, and only what it hits is written, by a hash
of the text. An item with more text than that is cut into parts that overlap by a window less one word. The hits then go
to the documents; up to ``BROADCAST_BYTES`` of them by broadcast, and no document is moved.

Item ids are integers, or cast to such. Nulls: a null text has no words. An item without words, or with a null id, has
no windows. Repeated items count once; repeated documents are each judged alike; of items with equal windows all are
found. Texts of any length are scanned whole, each in one task. Empty tables on either side give no hits. Other columns of the
documents pass; those that are added replace any of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.scratch import saved
from tributary.llm.worker import let_go, slices, tidy

SIZE = 8
#: Text of benchmark items in one broadcast; the set takes some 60 times as much in a worker's memory.
BLOCK_BYTES = 1_000_000
#: Hits, as counted, that are broadcast; beyond, documents and hits are joined by the text's hash.
BROADCAST_BYTES = 32_000_000
#: Words of documents that are looked up together in a worker.
TOGETHER = 250_000

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
FOUND = "struct<n_words:bigint,hits:array<struct<start:int,end:int>>,items:array<bigint>>"


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())  # bytes: only A-Z are lowered


class Windows:
    """The windows of one block of items: numbered words, and by length of window the sorted hashes."""

    def __init__(self, items: list[tuple[int, str]], size: int = SIZE):
        self.ids: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], tuple[int, ...]] = {}
        for item, text in items:
            words = [self.ids.setdefault(w, len(self.ids)) for w in words_of(text)]
            for i in range(max(1, len(words) - size + 1) if words else 0):
                window = tuple(words[i : i + size])
                known = self.windows.get(window, ())
                if item not in known:
                    self.windows[window] = (*known, item)
        rng = np.random.default_rng(7)
        self.odds = rng.integers(1, 1 << 62, size=size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.hashes: dict[int, np.ndarray] = {}
        for n in sorted({len(w) for w in self.windows}):
            table = np.array([w for w in self.windows if len(w) == n], np.int64).reshape(-1, n)
            self.hashes[n] = np.unique(self.hash(table))

    def hash(self, table: np.ndarray) -> np.ndarray:
        return ((table.astype(np.uint64) + np.uint64(1)) * self.odds[: table.shape[1]]).sum(axis=1, dtype=np.uint64)

    def scan(self, docs: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], list[int]]]:
        """For each document: the runs of hit words, as starts and ends, and the items found, sorted."""
        words: list[bytes] = []
        ends = []
        for doc in docs:
            words += doc
            words.append(b"")  # no window crosses from one document into the next
            ends.append(len(words))
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        hit = np.zeros(len(words) + 1, np.int32)
        found: dict[int, set[int]] = {}
        edges = np.array(ends)
        for n, known in self.hashes.items():
            if len(ids) < n:
                continue
            at = np.flatnonzero(unknown[n:] == unknown[:-n])
            if not len(at):
                continue
            rows = ids[at[:, None] + np.arange(n)]
            hashes = self.hash(rows)
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for k in np.flatnonzero(known[place] == hashes):
                items = self.windows.get(tuple(rows[k].tolist()))
                if items is not None:
                    i = int(at[k])
                    hit[i] += 1
                    hit[i + n] -= 1
                    found.setdefault(int(np.searchsorted(edges, i, side="right")), set()).update(items)
        if not found:
            return [([], [])] * len(docs)
        covered = np.cumsum(hit[:-1]) > 0
        out = []
        for d, end in enumerate(ends):
            if d not in found:
                out.append(([], []))
                continue
            begin = ends[d - 1] if d else 0
            step = np.flatnonzero(np.diff(np.concatenate([[0], covered[begin:end].astype(np.int8), [0]])))
            out.append((list(zip(step[::2].tolist(), step[1::2].tolist(), strict=True)), sorted(found[d])))
        return out


def parts_of(text: str, limit: int, size: int) -> Iterator[str]:
    """The text, or its words in parts of about ``limit`` bytes that have all its windows."""
    if len(text.encode()) <= limit:
        yield text
        return
    words = words_of(text)
    begin = 0
    while begin == 0 or begin + size <= len(words):
        end, room = begin, limit
        while end < len(words) and (room > 0 or end < begin + size):
            room -= len(words[end]) + 1
            end += 1
        yield b" ".join(words[begin:end]).decode()
        begin = max(begin + 1, end - size + 1)


def blocks(benchmark: DataFrame, item: str, text: str, limit: int, size: int = SIZE) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's rows, in lists of about ``limit`` bytes of text at most."""
    rows = benchmark.where(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).cast("bigint").alias("item"), F.col(text).alias("text"))
    block: list[tuple[int, str]] = []
    room = limit
    for row in rows.toLocalIterator():
        for part in parts_of(row.text, limit, size):
            n = len(part.encode())
            if block and n > room:
                yield block
                block, room = [], limit
            block.append((row.item, part))
            room -= n
    if block:
        yield block


def scanned(docs: DataFrame, windows, text: str, trim: bool = False) -> DataFrame:
    """Adds ``found``; ``windows`` is the broadcast of a block, or None for word counts only. ``trim`` cuts the hits out."""
    names = [x for x in docs.columns if x != "found"]
    schema = docs.select(*names).schema
    rows = docs.select(*names)
    place = names.index(text)
    kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        table = windows.value if windows is not None else None
        for batch in slices(batches, place):
            out: list[dict] = []
            group: list[list[bytes]] = []
            size = 0

            def flush() -> None:
                got = table.scan(group) if table is not None else [([], [])] * len(group)
                out.extend({"n_words": len(w), "hits": [{"start": a, "end": b} for a, b in hits], "items": items} for w, (hits, items) in zip(group, got, strict=True))

            for x in batch.column(place):
                group.append(words_of(x.as_py()))
                size += len(group[-1])
                if size > TOGETHER:
                    flush()
                    group, size = [], 0
            flush()
            columns = list(batch.columns)
            if trim and any(x["hits"] for x in out):
                texts = [cut(t.as_py(), [(h["start"], h["end"]) for h in x["hits"]]) if x["hits"] else t.as_py() for t, x in zip(columns[place], out, strict=True)]
                columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, kind)], [*names, "found"])

    return rows.mapInArrow(tidy(run), T.StructType([*schema, T.StructField("found", T.DataType.fromDDL(FOUND))]))


def merged(runs: Column) -> Column:
    """Sorted runs with those that meet or overlap made one."""
    kind = "array<struct<start:int,end:int>>"

    def step(out: Column, x: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        grown = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(out) > 0) & (last["end"] >= x["start"]), grown).otherwise(F.concat(out, F.array(x))).cast(kind)

    return F.aggregate(F.sort_array(runs), F.array().cast(kind), step)


def find(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", size: int = SIZE, block_bytes: int = BLOCK_BYTES, trim: bool = False) -> DataFrame:
    """Adds ``found``: the number of words, the runs of hit words, and the ids of the items with occurring windows, sorted.

    ``trim`` cuts the hit runs out of the texts, in the same pass where the benchmark is one block.
    """
    context = docs.sparkSession.sparkContext
    made = blocks(benchmark, item, item_text, block_bytes, size)
    first = next(made, None)
    second = next(made, None)
    if second is None:
        return scanned(docs, context.broadcast(Windows(first, size)) if first else None, text, trim)
    texts = docs.select(F.col(text).alias("__text"))
    parts = []
    for block in (b for group in ([first, second], made) for b in group):
        sent = context.broadcast(Windows(block, size))
        hits = scanned(texts, sent, "__text").where(F.size("found.items") > 0)
        parts.append(saved(hits.select(F.sha2("__text", 256).alias("__sha"), "found").dropDuplicates(["__sha"]), "hits"))
        sent.unpersist()
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    # a text occurs once in each part: what is gathered for it is bounded by its own words and the benchmark's items
    whole = together.groupBy("__sha").agg(F.flatten(F.collect_list("found.hits")).alias("h"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("found.items")))).alias("i"))
    whole = whole.select("__sha", merged(F.col("h")).alias("__h"), F.col("i").alias("__i"))
    whole = saved(whole, "hits")
    weight = whole.agg(F.coalesce(F.sum(F.size("__h") * 8 + F.size("__i") * 8 + 100), F.lit(0))).first()[0]
    counted = scanned(docs, None, text).withColumn("__sha", F.sha2(text, 256))
    joined = counted.join(F.broadcast(whole) if weight <= BROADCAST_BYTES else whole, "__sha", "left")
    full = joined.withColumn("found", F.struct(F.col("found.n_words"), F.coalesce("__h", "found.hits").alias("hits"), F.coalesce("__i", "found.items").alias("items"))).drop("__sha", "__h", "__i")
    return without_hits(full, text) if trim else full


def hit_words(found: Column) -> Column:
    return F.aggregate(found["hits"], F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])


def cut(text: str, hits: list[tuple[int, int]]) -> str:
    """The text without its hit words, from the first to the last of each run; where a run goes, one space stays."""
    if not hits:
        return text
    data = text.encode()
    at = [m.span() for m in WORD.finditer(data.lower())]
    out, done = [], 0
    for a, b in hits:
        out.append(data[done : at[a][0]].decode().rstrip(" \t"))
        done = at[b - 1][1]
    out.append(data[done:].decode().lstrip(" \t"))
    return " ".join(x for x in out if x)


def without_hits(docs: DataFrame, text: str = "text") -> DataFrame:
    """Cuts the hit runs out of the texts; those without hits stay as they are, in the JVM's hands."""

    @F.pandas_udf("string")
    def cutter(texts: pd.Series, hits: pd.Series) -> pd.Series:
        return pd.Series([cut(t, [(x["start"], x["end"]) for x in h]) if t is not None and h is not None else t for t, h in zip(texts, hits, strict=True)])

    some = F.size("found.hits") > 0
    return docs.where(~some).unionByName(docs.where(some).withColumn(text, cutter(F.col(text), F.col("found.hits"))))
