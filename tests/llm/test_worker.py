"""What a Python worker holds, and that work in slices gives the rows of whole batches."""

import random
import weakref

import public_tokenizers
import pyarrow as pa
import pytest

from tributary.llm import bpe, decontaminate, neardup, shingles, worker

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_one_table_at_a_time():
    first = weakref.ref(shingles.circulant(150))
    assert first() is shingles.circulant(150)
    second = weakref.ref(bpe.codec(RANKS, public_tokenizers.PATTERN))
    assert first() is None and second() is bpe.codec(RANKS, public_tokenizers.PATTERN)
    worker.let_go()
    assert second() is None


def test_slices():
    texts = ["a" * 3_000_000, None, "", "b" * 9_000_000, "c", None]
    whole = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["id", "text"])
    got = list(worker.slices(iter([whole, whole.slice(0, 0), whole.slice(4, 2)]), 1))
    assert [x for b in got for x in b.column(0).to_pylist()] == [*range(6), 4, 5]
    assert [x for b in got for x in b.column(1).to_pylist()] == [*texts, *texts[4:]]
    assert [b.num_rows for b in got] == [1, 1, 1, 1, 1, 1, 2]


@pytest.mark.parametrize("operator", ["sign", "scanned", "encode"])
def test_rows_do_not_depend_on_slices(spark, monkeypatch, operator):
    rng = random.Random(3)
    item = " ".join(f"w{i}" for i in range(12))
    texts = [None, "", "one", *[" ".join(f"w{rng.randrange(50_000)}" for _ in range(rng.randrange(300))) for _ in range(40)]]
    texts += [f"{texts[5]} {item} {texts[6]}", "long text " * 5_000, texts[7]]
    docs = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    made = []

    class Caught(Exception):
        pass

    def catch(self, run, schema):
        made.append(run)
        raise Caught

    monkeypatch.setattr(type(docs), "mapInArrow", catch)
    with pytest.raises(Caught):
        if operator == "sign":
            neardup.sign(docs, "doc_id", "text")
        elif operator == "scanned":
            decontaminate.scanned(docs, spark.sparkContext.broadcast(decontaminate.Windows([(1, item)])), "text", True)
        else:
            bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    ids = pa.array(range(len(texts)), pa.int64())
    own = pa.array(texts) if operator != "encode" else pa.array([x or "" for x in texts])
    arrays = {"doc_id": ids, "seal": ids, "text": own} if operator == "sign" else {"doc_id": ids, "text": own}
    batch = pa.RecordBatch.from_pydict(arrays)

    def rows(limit):
        monkeypatch.setattr(worker, "SLICE_BYTES", limit)
        out = list(made[0](iter([batch])))
        names = [x for x in out[0].schema.names if x != "__row"]  # a name made anew each time
        got = sorted((repr([r[x] for x in names]) for b in out for r in b.to_pylist()))
        return got, max(b.num_rows for b in out)

    whole, most = rows(1 << 40)
    sliced, fewer = rows(2_000)
    assert sliced == whole and len(whole) >= len(texts)
    assert fewer < 5 < most
