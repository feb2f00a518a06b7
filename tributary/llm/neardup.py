"""Near duplicates: circulant MinHash, banding, exact Jaccard verification, connected components.

1. Each text's shingle set is hashed and signed (see ``shingles``). Texts of equal sets are one class from here
   on, however many rows they are; the class's least id stands for it.
2. The signature is cut into bands; classes that agree in a band meet in a bucket. Buckets are dealt by ranges of
   (band's key, class), so that a large one lies in several tasks. All members are paired with the first of their
   part, these with each other's least, and in buckets of up to ``SMALL`` members all with all.
3. Pairs that sizes or odd sketches rule out go no further; the others are verified on the full sets, and their links
   contracted to components. A sketch has a bit for each remainder of the shingles' hashes, set where an odd number of
   shingles has it: two sketches differ in no more bits than the sets in shingles, so no linked pair is ruled out.
4. Larger buckets that still hold several components are open. Their classes meet again by the rarest of their
   shingles, so many that linked sets must have one of these in common, which is not what a template has in many of
   them. Of these lists, again all are paired with one member, another in each list; then, in lists with several
   components left, all pairs across components that places, sizes and sketches leave. Lists of any length are
   cut into blocks that meet in tasks of their own. So no group is turned into all its pairs, and no link between
   components is left out.
5. Components come from alternating star contractions of the links, as tables.

A link needs ``percent`` of the union in common, on whole sets. All steps but the bands are exact; the chance that a
linked pair shares no band is 2e-8 at 85 percent and 7e-6 at 80.

Nulls: texts without words are linked with nothing. Rows with a null id take part; a component of such rows only
has a null id. Rows of one id and unlike texts are judged each by its text. An empty table gives an empty table.
Ties: of equal ids any row may stand for its class, the result is the same. Texts of any length are read whole; the
hashes of one text, or of a pair, lie in a worker's memory. Signatures of texts of millions of words become alike,
as they fill the permutations' universe: such texts are verified with more others than they need to be.
Only the id and the text are read; other columns stay behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.scratch import saved
from tributary.llm.shingles import U, circulant, mixed, shingle_sets
from tributary.llm.worker import let_go, slices, tidy
from tributary.operators.joins import lookup

BANDS, ROWS = 30, 5
SMALL = 6
#: 64-bit words of an odd sketch.
WORDS = 16
#: Members of a list that meet in one task.
BLOCK = 512
#: Cells of the table of shingles' counts, as powers of two: as many as shingles within these bounds, a byte each. Cells that shingles share only make some look less rare.
CELLS = (16, 24)
SIGNED = "id BIGINT, seal BIGINT, n INT, set_id BINARY, keys ARRAY<BIGINT>, bits ARRAY<BIGINT>"
PAIR, MEMBER, EDGE = 0, 1, 2


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    counts = np.bincount((hashes % U(WORDS * 64)).astype(np.int64), minlength=WORDS * 64)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def lists(values: list[np.ndarray], sizes: list[int]) -> pa.Array:
    """Arrays of BIGINT from their values in a row."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64), pa.int64()))


def sign(docs: DataFrame, key: str, text: str) -> DataFrame:
    """SIGNED, a row per document. ``seal`` is a hash of the text, by which a row is found again beside its id."""
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("seal"), F.col(text).alias("text"))
    names = [x.split()[0] for x in SIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = circulant(BANDS * ROWS)
        band = mixed(np.arange(1, BANDS + 1, dtype=U))
        odds = mixed(np.arange(101, 101 + ROWS, dtype=U)) | U(1)
        for batch in slices(batches, 2):
            sizes, ids, keys, bits = [], [], [], []
            for hashes in shingle_sets(batch.column(2).to_pylist()):
                sizes.append(len(hashes))
                if not len(hashes):
                    ids.append(None)
                    continue
                least = signer.sign(hashes)
                ids.append(hashes.sum(dtype=U).tobytes() + mixed(hashes ^ U(0xABCDEF)).sum(dtype=U).tobytes())
                keys.append(mixed((least.reshape(BANDS, ROWS).astype(U) * odds).sum(axis=1, dtype=U) ^ band).view(np.int64))
                bits.append(odd_sketch(hashes))
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(sizes, pa.int32()),
                pa.array(ids, pa.binary()),
                lists(keys, [BANDS if n else 0 for n in sizes]),
                lists(bits, [WORDS if n else 0 for n in sizes]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(tidy(run), SIGNED)


def classes(signed: DataFrame) -> DataFrame:
    """``(node, set_id, id, seal, n, keys, bits)``, a row per distinct set; ``id`` and ``seal`` name one row that has it."""
    first = F.struct(F.col("id").isNull().alias("none"), "id", "seal")
    rest = [F.first(x).alias(x) for x in ("n", "keys", "bits")]
    grouped = signed.where("n > 0").groupBy("set_id").agg(F.min(first).alias("row"), *rest)
    return grouped.select(F.monotonically_increasing_id().alias("node"), "set_id", "row.id", "row.seal", "n", "keys", "bits")


def alike(x: str, y: str, percent: int) -> Column:
    """False where the sizes or sketches of two structs rule a link out."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    unlike = F.lit(0)
    for i in range(WORDS):
        unlike = unlike + F.bit_count(F.get(f"{x}.bits", F.lit(i)).bitwiseXOR(F.get(f"{y}.bits", F.lit(i))))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (unlike * (100 + percent) <= (n + m) * (100 - percent))


def sketched(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs ``(a, b)`` that sizes and sketches leave."""
    sketch = F.struct("n", "bits")
    left = nodes.select(F.col("node").alias("a"), sketch.alias("x"))
    right = nodes.select(F.col("node").alias("b"), sketch.alias("y"))
    pairs = saved(pairs.select("a", "b").distinct(), "candidates")
    joined = lookup(pairs.join(left, "a"), right, ["b"], counted=pairs, how="inner")
    return joined.where(alike("x", "y", percent)).select("a", "b")


def meet(rows: DataFrame, small: int, members: bool) -> DataFrame:
    """Pairs within lists, from ``(key, place, node, root)``: ``(kind, x, y)``.

    Rows are dealt by ranges of (key, place, node), so that a list of any length is spread over tasks as its length
    asks. ``PAIR``: x is a member and y the first of its list in the task, of unlike roots; in lists of up to ``small``
    members all pairs. ``MEMBER``: (key, node) of longer lists, or of those that may go on beyond what is seen.
    ``EDGE``: (key, node) of the first member of lists at the task's ends.
    """
    ranged = rows.select("key", "place", "node", "root").repartitionByRange("key", "place", "node").sortWithinPartitions("key", "place", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind: int, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int8)), pa.array(x), pa.array(y)], ["kind", "x", "y"])

        let_go()
        known = None  # the last list's key, first node and its root
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, root = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            start = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            size = np.diff(np.concatenate([start, [len(key)]]))
            first, first_root = node[start].copy(), root[start].copy()
            goes_on = known is not None and known[0] == key[0]
            if goes_on:
                first[0], first_root[0] = known[1:]
            which = np.repeat(np.arange(len(start)), size)
            paired = (node != first[which]) & (root != first_root[which])
            yield out(PAIR, node[paired], first[which][paired])
            whole = size <= small  # lists seen from end to end
            whole[-1] = False
            if known is None or goes_on:
                whole[0] = False
            rank = np.arange(len(key)) - start[which]
            for back in range(1, small - 1):
                at = np.flatnonzero(whole[which] & (rank > back))
                at = at[root[at] != root[at - back]]
                yield out(PAIR, node[at], node[at - back])
            if members:
                rest = ~whole[which]
                yield out(MEMBER, key[rest], node[rest])
            if known is None:
                yield out(EDGE, key[:1], first[:1])
            known = (key[-1], first[-1], first_root[-1])
        if known is not None:
            yield out(EDGE, np.array([known[0]]), np.array([known[1]]))

    return ranged.mapInArrow(tidy(run), "kind TINYINT, x BIGINT, y BIGINT")


def pairs_met(met: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that ``meet`` made, with those of lists that go on over several tasks; ``a`` is the greater."""
    edges = met.where(F.col("kind") == EDGE).select(F.col("x").alias("key"), F.col("y").alias("node")).distinct()  # two a task at most
    least = edges.groupBy("key").agg(F.min("node").alias("least"))
    bridges = edges.join(least, "key").where("node != least").select(F.col("node").alias("x"), F.col("least").alias("y"))
    both = met.where(F.col("kind") == PAIR).select("x", "y").unionByName(bridges)
    return both.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have ``percent`` of their union in common.

    Each pair goes to its second member with the text of the first; a member of very many pairs is dealt over tasks.
    """
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    joined = lookup(pairs.join(left, "a"), right, ["b"], counted=pairs, how="inner").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = part.column(2).to_pylist() + part.column(3).to_pylist()
                sets = list(shingle_sets(texts))
                half = part.num_rows
                keep = []
                for x, y in zip(sets[:half], sets[half:], strict=True):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
                yield pa.RecordBatch.from_arrays(part.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(tidy(run), "a BIGINT, b BIGINT")


def is_stars(edges: DataFrame) -> bool:
    """Whether every node is either a root or has one edge, to a root."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    odd = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR (out = 1 AND into = 1)")
    return odd.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Contracts edges to stars: ``(a, b)``, where b is the least node of a's component; roots have no row."""
    flat = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = saved(flat, "edges")
    while not is_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        joined = small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = saved(joined.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    return now


def rooted(df: DataFrame, stars: DataFrame, column: str, to: str) -> DataFrame:
    """Adds the component's root of a node column."""
    return df.join(stars.select(F.col("a").alias(column), F.col("b").alias("__root")), column, "left").withColumn(to, F.coalesce("__root", column)).drop("__root")


def texts_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``(node, text)`` for the wanted nodes, by one pass over the documents."""
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("seal"), F.col(text).alias("text"))
    places = nodes.select("node", F.col("id").alias("own"), F.col("seal").alias("mark")).join(wanted, "node", "left_semi")
    found = rows.join(places, (F.col("seal") == F.col("mark")) & F.col("id").eqNullSafe(F.col("own")))
    return found.select("node", "text").dropDuplicates(["node"])


def links(docs: DataFrame, nodes: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """The components of the classes, as stars."""
    buckets = nodes.select(F.explode("keys").alias("key"), F.lit(0).alias("place"), "node", F.col("node").alias("root"))
    met = saved(meet(buckets, SMALL, True), "met")
    tested = saved(sketched(pairs_met(met), nodes, percent), "pairs")
    large = met.where(F.col("kind") == MEMBER).select(F.col("x").alias("key"), F.col("y").alias("node"))
    wanted = tested.select(F.explode(F.array("a", "b")).alias("node")).unionByName(large.select("node")).distinct()
    texts = saved(texts_of(docs, nodes, wanted, key, text), "texts")
    found = components(verified(tested, texts, percent))

    open_ = saved(split(large, found).select("node").distinct().join(nodes.select("node", "n"), "node"), "open")
    if open_.isEmpty():
        return found
    rare = prefixes(open_, texts, percent)
    stars = meet(rooted(rare, found, "node", "root").withColumn("place", F.xxhash64("key", "node")), 2, False)
    for candidates in (lambda now: pairs_met(stars), lambda now: across(rare, now, nodes, percent)):
        pairs = saved(sketched(candidates(found), nodes, percent).join(tested, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            found = components(found.unionByName(verified(pairs, texts, percent)))
            tested = tested.unionByName(pairs)
    return found


def split(rows: DataFrame, stars: DataFrame) -> DataFrame:
    """The rows ``(key, node, ..)`` of the lists that have several roots, with ``root`` and ``members``, the list's length."""
    placed = rooted(rows, stars, "node", "root")
    several = placed.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("members")).where("r0 != r1")
    return lookup(placed, several.select("key", "members"), ["key"], counted=rows, how="inner")


def prefixes(open_: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``(key, node, n, pos)``: the rarest shingles of each open class, in order, of which linked sets share one.

    Rarity is a shingle's number of open classes, counted in a table of cells that goes to the workers; any order
    would do, and of shingles as rare the hash decides.
    """
    spark = open_.sparkSession
    own = texts.join(open_, "node").select("node", "text")
    cells = min(max(int(open_.agg(F.sum("n")).first()[0]).bit_length(), CELLS[0]), CELLS[1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in slices(batches, 1):
            got = np.concatenate([np.zeros(0, U), *shingle_sets(batch.column(1).to_pylist())]) >> U(64 - cells)
            cell, n = np.unique(got, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(n.astype(np.int64))], ["cell", "n"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            level = np.minimum(4 * np.log2(n), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (cell, level)], ["cells", "levels"])

    summed = own.mapInArrow(tidy(count), "cell INT, n BIGINT").groupBy("cell").agg(F.sum("n").alias("n"))
    table = np.zeros(1 << cells, np.uint8)
    for row in summed.mapInArrow(pack, "cells BINARY, levels BINARY").collect():  # five bytes a cell at most
        table[np.frombuffer(row.cells, np.int32)] = np.frombuffer(row.levels, np.uint8)
    sent = spark.sparkContext.broadcast(table)  # a byte a cell, whatever the input

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        levels = sent.value
        for batch in slices(batches, 1):
            keys, sizes, all_ = [], [], []
            for hashes in shingle_sets(batch.column(1).to_pylist()):
                n = len(hashes)
                order = np.lexsort((mixed(hashes), levels[hashes >> U(64 - cells)]))
                keys.append(hashes[order[: n - (n * percent + 99) // 100 + 1]].view(np.int64))
                sizes.append(len(keys[-1]))
                all_.append(n)
            total = np.array(sizes, np.int64)
            pos = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
            columns = [
                pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)),
                pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), total)),
                pa.array(np.repeat(np.array(all_, np.int32), total)),
                pa.array(pos.astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", "n", "pos"])

    made = saved(own.mapInArrow(tidy(cut), "key BIGINT, node BIGINT, n INT, pos INT"), "prefixes")
    sent.unpersist()
    return made


def across(rows: DataFrame, stars: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: pairs within lists ``(key, node, n, pos)``, of unlike roots, that may yet be linked.

    What follows a common shingle bounds what two sets can share. A list is cut into blocks; each two of
    them, and each with itself, meet under a key of their own.
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    known = split(rows, stars).join(nodes.select("node", "bits"), "node")
    dealt = known.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.struct("node", "n", "pos", "root", "own", "bits").alias("s"))
    left, right = dealt.withColumnRenamed("s", "x"), dealt.withColumnRenamed("s", "y")
    shared = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    may = shared * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent
    once = (F.col("i") == F.col("j")) | (F.col("x.own") != F.col("y.own"))
    met = left.join(right, ["key", "i", "j"]).where((F.col("x.node") > F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & once & may & alike("x", "y", percent))
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``(key, seal, n_shingles, component_id, kept)``, one row per document.

    ``component_id`` is the least id that links lead to, the row's own included; ``kept`` says that they are equal.
    """
    signed = saved(sign(docs, key, text), "signed")
    nodes = saved(classes(signed), "classes")
    stars = links(docs, nodes, key, text, percent)
    labelled = rooted(nodes.select("node", "set_id", F.col("id").alias("least")), stars, "node", "root")
    heads = labelled.groupBy("root").agg(F.min("least").alias("component"))
    named = lookup(labelled, heads, ["root"], counted=stars.select(F.col("b").alias("root")), how="inner").select("set_id", "component")
    joined = lookup(signed.select("id", "seal", "n", "set_id"), named, ["set_id"])
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return joined.select(F.col("id").alias(key), "seal", F.col("n").cast("bigint").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The documents without near duplicates: of each component the row with its id, and once where rows repeat."""
    judged = near_duplicates(docs, key=key, text=text, percent=percent)
    names = docs.columns
    kept = judged.where("kept").groupBy(F.col(key).alias("__id"), F.col("seal").alias("__seal")).agg(F.count("*").alias("__same"))
    sealed = docs.withColumn("__mark", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    joined = sealed.join(kept, (F.col("__mark") == F.col("__seal")) & F.col(key).cast("bigint").eqNullSafe(F.col("__id")))
    once = joined.where("__same = 1").select(*names)
    return once.unionByName(joined.where("__same > 1").dropDuplicates(["__id", "__seal"]).select(*names))
