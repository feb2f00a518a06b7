"""The pipeline against the stages' rules in plain Python."""

import base64
import hashlib
import random
import re

import public_tokenizers
import tiktoken
from test_decontaminate import words
from test_native import base
from test_neardup import brute

from tributary.llm import pipeline as corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def prose(rng, n):
    return " ".join(f"w{rng.randrange(100_000)}" + ("." if i % 9 == 8 else "") for i in range(n))


def corpus():
    rng = random.Random(8)
    items = [(i, prose(rng, 20)) for i in range(6)]
    texts = {}
    for i in range(60):
        texts[i] = prose(rng, rng.randrange(80, 300)) + "."
    texts[60] = texts[3]
    texts[61] = texts[4].replace("w", "W", 3) + " more words"
    texts[62] = "short"
    texts[63] = None
    texts[64] = "same " * 200
    texts[65] = " | ".join(prose(rng, 150).split()) + " |"
    texts[66] = f"{prose(rng, 90)} {items[0][1]} {prose(rng, 90)}"
    texts[67] = f"{prose(rng, 90)} {items[1][1]} {prose(rng, 90)} {items[2][1]}"
    texts[68] = f"{prose(rng, 90)} write to a.b@example.org or +49 30 1234567 now {prose(rng, 90)}"
    return texts, items


def test_planted_cases(spark, tmp_path):
    texts, items = corpus()
    rows = [(k, v, "en", "s", len(v) if v else None) for k, v in texts.items()]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = {r.doc_id: r for r in docs.collect()}
    assert set(seen["quality"]) == set(texts) - {62, 63, 64, 65}
    assert set(seen["near_duplicates"]) == set(seen["quality"]) - {60, 61}
    assert set(seen["benchmark"]) == set(seen["near_duplicates"]) - {67}
    left = seen["benchmark"][66]
    assert not set(words(items[0][1])) & set(words(left.text)) and left.n_chars == len(left.text) and len(words(left.text)) >= 180
    assert set(seen["personal_data"]) == set(seen["benchmark"])
    for k, r in seen["personal_data"].items():
        if k == 68:
            assert "write to [EMAIL] or [PHONE] now" in r.text and r.n_chars == len(r.text)
        elif k != 66:
            assert r.text == texts[k]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == set(seen["personal_data"])
    for r in out:
        text = seen["personal_data"][r.doc_id].text
        assert r.n_tokens == len(encoding.encode_ordinary(text)) and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_on_the_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = {r.doc_id for r in stages["quality"](spark, docs, sf).collect()}
    assert all(k not in good for k, v in texts.items() if base(v)[0] < 50 or 100 * base(v)[4] > 50 * base(v)[0])
    prosaic = {k for k, v in texts.items() if base(v)[0] >= 100 and not re.search(r"[#*$%&|<>!]", v) and 5 * base(v)[4] < base(v)[0]}
    assert prosaic <= good
    roots = brute(texts, corpus_pipeline.NEAR)
    assert {r.doc_id for r in stages["near_duplicates"](spark, docs, sf).collect()} == {k for k, v in roots.items() if v[1] == k}


def test_other_columns_stay(spark, tmp_path):
    text = prose(random.Random(1), 200)
    spark.createDataFrame([(1, text)], "item_id BIGINT, text STRING").where("item_id > 1").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(1, text + " a@b.org", "kept", 7, "p", "f", "o", None)], "doc_id BIGINT, text STRING, kept STRING, quality INT, pii STRING, found STRING, others STRING, n_chars BIGINT")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        row = out.first()
        assert (row.kept, row.quality, row.pii, row.found, row.others) == ("kept", 7, "p", "f", "o")
        assert row.n_chars == (len(text) + 8 if name == "personal_data" else None)


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id BIGINT, text STRING").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
