"""Decontamination against brute force."""

import random
import re

from tributary.llm import decontaminate
from tributary.llm.registry import QUERIES

DOCS, ITEMS = "doc_id BIGINT, text STRING, found STRING", "item_id BIGINT, text STRING"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, item_text in items:
        v = words(item_text)
        if item is None or not v:
            continue
        n = min(8, len(v))
        for i in range(len(v) - n + 1):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == v[i : i + n]:
                    found.add(item)
                    hit.update(range(j, j + n))
    return len(w), sorted(hit), sorted(found)


def case(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "b", "é", "É", "1", "x2", "ß"]
    text = lambda n: rng.choice([" ", "  ", "\n", ", "]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 8, 9, 20]) if i % 3 == 0 else 12)) for i in range(30)] + [(None, "a b"), (3, None), (4, "a b b"), (4, "a b b")]
    docs = [(i, text(rng.randrange(60))) for i in range(60)] + [(None, None), (7, ""), (7, items[1][1]), (7, items[1][1]), (8, f"x {items[2][1]} y {items[1][1]}")]
    return docs, items


def test_against_brute_force(spark):
    docs, items = case(1)
    benchmark = spark.createDataFrame(items, ITEMS)
    rows = spark.createDataFrame([(*d, "own") for d in docs], DOCS)
    for limit in (decontaminate.BLOCK_BYTES, 100):
        got = decontaminate.find(rows, benchmark, block_bytes=limit).collect()
        assert len(got) == len(docs)
        for r in got:
            n, hit, found = brute(r.text, items)
            assert r.found.n_words == n and list(r.found["items"]) == found, (limit, r.text)
            assert [x for s in r.found.hits for x in range(s.start, s.end)] == hit
        assert decontaminate.find(rows.limit(0), benchmark, block_bytes=limit).count() == 0
    assert all(not r.found["items"] for r in decontaminate.find(rows, benchmark.limit(0)).collect())


def test_cut(spark):
    items = [(1, "one two three four five six seven eight nine")]
    docs = [(1, "Start. ONE two, three four five six seven eight nine! End é."), (2, "clean  text\n"), (3, None), (4, items[0][1])]
    found = decontaminate.find(spark.createDataFrame([(*d, "") for d in docs], DOCS), spark.createDataFrame(items, ITEMS))
    expected = {1: "Start. ! End é.", 2: "clean  text\n", 3: None, 4: ""}
    assert {r.doc_id: r.text for r in decontaminate.without_hits(found).collect()} == expected
    items.append((2, "no such words here"))
    for limit in (decontaminate.BLOCK_BYTES, 30):
        trimmed = decontaminate.find(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), spark.createDataFrame(items, ITEMS), block_bytes=limit, trim=True)
        assert {r.doc_id: r.text for r in trimmed.collect()} == expected


def test_one_large_item(spark):
    rng = random.Random(4)
    item = " ".join(f"w{rng.randrange(400)}" for _ in range(3000))
    v = item.split()
    docs = [(i, " ".join([f"x{i}", *v[a : a + rng.randrange(5, 12)], "y"])) for i, a in enumerate(rng.sample(range(2980), 150))]
    parts = list(decontaminate.parts_of(item, 500, 8))
    assert all(len(x) < 700 for x in parts) and len(parts) > 20
    assert {tuple(v[i : i + 8]) for i in range(2993)} == {tuple(w[i : i + 8]) for w in map(str.split, parts) for i in range(len(w) - 7)}
    got = decontaminate.find(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), spark.createDataFrame([(1, item)], ITEMS), block_bytes=500).collect()
    for r in got:
        n, hit, found = brute(r.text, [(1, item)])
        assert list(r.found["items"]) == found and [x for s in r.found.hits for x in range(s.start, s.end)] == hit
    assert any(r.found["items"] for r in got)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(len(w) - 7):
            windows.setdefault(tuple(w[i : i + 8]), set()).add(item)
    rows = QUERIES["op8_decontamination"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        w = words(docs[r.doc_id])
        at = [j for j in range(len(w) - 7) if tuple(w[j : j + 8]) in windows]
        assert r.n_words == len(w) and r.n_hit == len({x for j in at for x in range(j, j + 8)})
        assert r.n_items == len({i for j in at for i in windows[tuple(w[j : j + 8])]})
    assert any(r.n_items for r in rows)
