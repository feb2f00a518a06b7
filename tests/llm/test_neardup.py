"""Near duplicates against brute force over all pairs."""

import random
import re

import numpy as np

from tributary.llm import neardup, shingles
from tributary.llm.registry import QUERIES

DOCS = "doc_id BIGINT, text STRING"


def shingle_set(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs, percent):
    sets = {k: shingle_set(v) for k, v in docs.items()}
    where = {}
    for k, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(k)
    root = {k: k for k in docs}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, s in sets.items():
        for other in {o for x in s for o in where[x] if o > k}:
            common = len(s & sets[other])
            if 100 * common >= percent * len(s | sets[other]):
                a, b = sorted((find(k), find(other)))
                root[b] = a
    return {k: (len(s), find(k)) for k, s in sets.items()}


def check(rows, docs, percent):
    expected = brute(docs, percent)
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_shingles, r.component_id, r.kept) == (*expected[r.doc_id], r.doc_id == expected[r.doc_id][1]), r.doc_id


def test_query(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
        check(QUERIES["op7_near_duplicates"](spark, sf).collect(), docs, 85)


def test_chains_and_borders(spark):
    """Groups whose members drift apart step by step, so that ends are linked by what lies between only."""
    rng = random.Random(11)
    docs, n = {}, 0
    for size in (12, 30, 60, 120):
        for _ in range(4):
            words = [f"w{rng.randrange(5000)}" for _ in range(size)]
            for _ in range(14):
                docs[n] = " ".join(words)
                n += 1
                for _ in range(max(1, size // 60)):
                    words[rng.randrange(size)] = f"v{rng.randrange(5000)}"
    for i, text in enumerate([None, "", " \t", "One", "one", "ONE ", "a b c d", "a b c d e", "a  b\nc d", "É b c d e f", "é b c d e f"]):
        docs[n + i] = text
    ids = list(docs)
    rng.shuffle(ids)
    docs = {i: docs[k] for i, k in enumerate(ids)}
    rows = spark.createDataFrame([(k, v, 1, "x") for k, v in docs.items()], DOCS + ", n INT, keys STRING")
    for percent in (85, 80):
        check(neardup.near_duplicates(rows, percent=percent).collect(), docs, percent)


def test_large_bucket_with_several_components(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 2)
    monkeypatch.setattr(neardup, "BANDS", 30)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(40)]
    docs = {}
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(40)] = f"x{rng.randrange(3)}"
        docs[i] = " ".join(words)
    rows = spark.createDataFrame(list(docs.items()), DOCS)
    check(neardup.near_duplicates(rows, percent=85).collect(), docs, 85)


def test_edges(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    assert neardup.keep_one(spark.createDataFrame([], DOCS + ", seal STRING, a INT")).count() == 0
    rows = spark.createDataFrame([(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "A b c d e f"), (None, "other words"), (7, None), (7, None), (3, "unlike text")], DOCS)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(rows).collect()), key=str)
    assert got == sorted([(5, 3, False), (3, 3, True), (3, 3, True), (None, 3, False), (None, None, True), (7, 7, True), (7, 7, True), (3, 3, True)], key=str)
    assert sorted(((r.doc_id, r.text) for r in neardup.keep_one(rows).collect()), key=str) == sorted([(3, "a b c d e f"), (3, "unlike text"), (7, None), (None, "other words")], key=str)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)]
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    stars = neardup.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT"))
    assert {r.a: r.b for r in stars.collect()} == {k: find(k) for k in root if find(k) != k}


def test_signature_estimates_similarity():
    signer = shingles.Circulant(150)
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.9):
        got = []
        for _ in range(60):
            x = rng.integers(0, 1 << 64, size=400, dtype=np.uint64)
            k = round(400 * 2 * share / (1 + share))
            y = np.concatenate([x[:k], rng.integers(0, 1 << 64, size=400 - k, dtype=np.uint64)])
            got.append((signer.sign(x) == signer.sign(y)).mean())
        assert abs(np.mean(got) - share) < 0.03


def test_a_template_in_many_unlinked_texts(spark, monkeypatch):
    """300 shared and 75 own words, no link at 85 percent: pairs grow with the rows, not with their square."""
    made, read = [], []
    sketched, verified = neardup.sketched, neardup.verified
    monkeypatch.setattr(neardup, "sketched", lambda pairs, *rest: made.append(pairs.count()) or sketched(pairs, *rest))
    monkeypatch.setattr(neardup, "verified", lambda pairs, *rest: read.append(pairs.count()) or verified(pairs, *rest))
    shared = " ".join(f"t{i}" for i in range(300))
    for n in (300, 1200):
        made.clear()
        read.clear()
        rows = spark.createDataFrame([(i, f"{shared} {' '.join(f'o{i}x{j}' for j in range(75))}") for i in range(n)], DOCS).repartition(8)
        assert neardup.near_duplicates(rows, percent=85).where("kept").count() == n
        assert sum(made) <= 8 * n and sum(read) <= 0.1 * n, (n, made, read)


def test_templates_with_links_across_buckets(spark, monkeypatch):
    """Groups around one template, linked within and not across, in lists that are cut into blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(9)
    shared = [f"t{i}" for i in range(120)]
    docs = {}
    for group in range(12):
        own = [f"g{group}x{j}" for j in range(40)]
        for _ in range(12):
            words = [*shared, *own]
            for _ in range(rng.randrange(3)):
                words[rng.randrange(160)] = f"v{rng.randrange(40)}"
            docs[len(docs)] = " ".join(words)
    rows = spark.createDataFrame(list(docs.items()), DOCS).repartition(5)
    for percent in (85, 80):
        check(neardup.near_duplicates(rows, percent=percent).collect(), docs, percent)


def test_long_words_and_sketches():
    a, b = "x" * 300, "x" * 299 + "y"
    sets = list(shingles.shingle_sets([f"{a} b c d e", f"{b} b c d e", f"{a} b c d e"]))
    assert sets[0] != sets[1] and sets[0] == sets[2]
    thue = ["a", "b"]
    for _ in range(11):
        thue = [thue[0] + thue[1], thue[1] + thue[0]]
    x, y = shingles.shingle_sets(thue)
    assert x != y
    rng = np.random.default_rng(1)
    for _ in range(200):
        x, y = (np.unique(rng.integers(0, 1 << 64, size=rng.integers(1, 3000), dtype=np.uint64)) for _ in range(2))
        y = np.unique(np.concatenate([x[: rng.integers(len(x) + 1)], y[: rng.integers(40)]]))
        unlike = sum(int(v).bit_count() for v in (neardup.odd_sketch(x) ^ neardup.odd_sketch(y)).view(np.uint64))
        assert unlike <= len(np.setxor1d(x, y))
