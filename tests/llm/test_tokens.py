"""Token counts and byte-level BPE against the libraries."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tributary.llm import bpe, token_counts
from tributary.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id BIGINT, text STRING"

rng = random.Random(5)
ODD = [None, "", " ", "a", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endof", "I'm we'll 'S 's'", " \n\n  x", "՘ᲉaꟋ\U0001e5d0 \U00016d40 \U0002ebf0x", "é" * 900, "汉字" * 200, "\x85\x1c\x1f  x　", "\U0001f600‍", "\x00"]
ODD += ["".join(chr(c) for c in range(a, a + 900) if not 0xD800 <= c < 0xE000) for a in (1, 0x500, 0x1C00, 0xA700, 0xD000, 0x10E00, 0x16D00, 0x1E500, 0x2EBF0, 0x1F000)]
ODD += ["".join(rng.choice([" ", "  ", "\n", "ab", "Zé", "'s", "'", "12", "!", "\t", "�"]) for _ in range(rng.randrange(400))) for _ in range(40)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_counts(spark, library):
    rows = spark.createDataFrame([(i, x, "own") for i, x in enumerate(ODD)], DOCS + ", n_tokens STRING")
    for r in token_counts.count_tokens(rows, JSON, keep_text=True).collect():
        text = ODD[r.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512), text
    assert token_counts.count_tokens(rows.limit(0), JSON).count() == 0


def test_counts_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in QUERIES["op3_token_counts"](spark, SF).collect()}
    assert got == {k: len(library.encode(v, add_special_tokens=False).ids) for k, v in texts.items()}


def test_counts_with_a_full_table(monkeypatch, library):
    monkeypatch.setattr(token_counts, "KNOWN", 5)
    monkeypatch.setattr(token_counts, "LONGEST", 3)
    counter = token_counts.Counts(JSON)
    for _ in range(2):
        for i in range(0, len(ODD), 3):
            texts = [x or "" for x in ODD[i : i + 3]]
            assert counter.count(texts) == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def expected(encoding, text):
    ids = encoding.encode_ordinary(text)
    return len(ids), sha(",".join(map(str, ids)).encode()), sha(encoding.decode_bytes(ids)), ids


def test_encode(spark, encoding):
    rows = spark.createDataFrame([(i, x, "own") for i, x in enumerate(ODD)], DOCS + ", n_tokens STRING")
    for chunk, overlap in ((bpe.CHUNK, bpe.OVERLAP), (100, 20)):
        got = bpe.encode(rows, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap, ids=True).collect()
        assert len(got) == len(ODD)
        for r in got:
            n, ids_sha, text_sha, ids = expected(encoding, ODD[r.doc_id] or "")
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) == (n, ids_sha, text_sha, ids), (chunk, ODD[r.doc_id])
    assert bpe.encode(rows.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_encode_query(spark, encoding):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op6_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(encoding, texts[r.doc_id])[:3]
        assert r.decoded_sha256 == sha(texts[r.doc_id].encode())


parts = st.sampled_from([" ", "   ", "\n", "a", "abcdefghijk", "'s", "'", "'ll", "l", "r", "e", "12", "!!", "é"])


@settings(max_examples=300, deadline=None)
@given(st.lists(parts, min_size=1, max_size=60).map("".join), st.integers(8, 24), st.integers(5, 7))
def test_stitching(text, chunk, overlap):
    coder = bpe.codec(RANKS, public_tokenizers.PATTERN)
    cut = [text[i : i + chunk + overlap] for i in range(0, len(text), chunk)]
    assert bpe.join_chunks(coder, cut, chunk, overlap) == regex.findall(public_tokenizers.PATTERN, text)
