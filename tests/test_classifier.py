import json
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary import Classifier
from tributary.functions.prompt import Template, prompt_column
from tributary.functions.response import clean, clean_text, strip
from tributary.operators.infer import infer
from tributary.operators.parse import FALLBACK, parse_json, results
from tributary.sources import taxonomy as tx

GOOD = '{"prediction_class": "A", "attribution": "b", "priority": "Low", "reason": "r"}'
ESCAPED = '{"prediction_class": "A\\nB", "reason": "r"}'
TWO = '{"a": "x\\n5\\ny"}'
INDEX = "list index out of range"

#: reply, JSON value or None, class of error
SHAPES = [
    (GOOD, json.loads(GOOD), None),
    (f"　\x1c  {GOOD}\n\t", json.loads(GOOD), None),
    (f"```json\n{GOOD}\n```", None, "IndexError"),
    (f"```json\\n{GOOD}\\n```", json.loads(GOOD), None),
    (f"```json\\n{GOOD}", json.loads(GOOD), None),
    (f"{GOOD}\n```", None, "JSONDecodeError"),
    (f"{ESCAPED}\n```", None, "JSONDecodeError"),
    (f"{GOOD}\\n```", json.loads(GOOD), None),
    ("```", None, "IndexError"),
    (f"```\n{ESCAPED}\n```", None, "JSONDecodeError"),
    (f"```\n{TWO}\n```", 5, None),
    ("", None, "JSONDecodeError"),
    (" \n ", None, "JSONDecodeError"),
    (GOOD[:30], None, "JSONDecodeError"),
    (GOOD + " trailing", None, "JSONDecodeError"),
    ("{'a': 1}", None, "JSONDecodeError"),
    ("[1, 2]", [1, 2], None),
    ("7", 7, None),
    ("null", "null", None),
    ('{"reason": "x"}', {"reason": "x"}, None),
    ('{"reason": "x", "extra": 1}', {"reason": "x", "extra": 1}, None),
    ('{"reason": "x", "reason": "y"}', {"reason": "y"}, None),
    ('{"a": NaN}', "NaN", None),
    ('{"a": 1,}', None, "JSONDecodeError"),
    (None, None, "AttributeError"),
]


def frame(spark, replies):
    return spark.createDataFrame([(i, r, None, None) for i, r in enumerate(replies)], "feedback_id BIGINT, response STRING, error_class STRING, error_text STRING")


def test_reply_shapes(spark):
    got = {r.feedback_id: r for r in results(frame(spark, [x[0] for x in SHAPES])).collect()}
    for i, (reply, value, error) in enumerate(SHAPES):
        row = got[i]
        assert row.error_class == error, reply
        if error:
            assert (row.status, row.prediction_class, row.attribution, row.priority) == ("fallback", *FALLBACK.values())
            assert row.reason.startswith("System Error: ")
        elif value not in ("null", "NaN"):
            assert json.loads(row.raw_json) == value
    assert got[2].reason == f"System Error: {INDEX}"
    assert got[24].reason == "System Error: 'NoneType' object has no attribute 'strip'"
    assert got[11].error_text == "Expecting value: line 1 column 1 (char 0)"


def test_white_space_is_pythons(spark):
    points = [c for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(c, chr(c) + "x" + chr(c)) for c in points], "c INT, t STRING")
    stripped = {r.c for r in rows.where(strip(F.col("t")) == "x").collect()}
    assert stripped == {c for c in points if chr(c).isspace()}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["`", "```", "\\n", "\n", " ", "{", "a", "\u3000", "\\", "n"]), max_size=12).map("".join), min_size=20, max_size=60))
def test_expression_equals_python(spark, replies):
    got = frame(spark, replies).select("feedback_id", clean(F.col("response")).alias("c")).collect()
    for row in got:
        try:
            assert row.c.cleaned == clean_text(replies[row.feedback_id])
            assert row.c.error is None
        except IndexError as error:
            assert (row.c.cleaned, row.c.error) == (None, str(error))


def test_strict_fence_takes_real_line_breaks(spark):
    replies = [f"```json\n{GOOD}\n```", f"{GOOD}\n```", GOOD, f"```json\\n{GOOD}\\n```"]
    got = results(frame(spark, replies), mode="strict_fence").collect()
    assert [r.status for r in got] == ["ok"] * 4
    assert all(json.loads(clean_text(r, "strict_fence")) == json.loads(GOOD) for r in replies)
    with pytest.raises(ValueError):
        clean(F.lit(""), "other")


def test_prompt_takes_feedback_as_it_is(spark):
    texts = ["plain", "", None, "grün", '"q" {x} {{y}}', "$1 \\ %s %", "a\nb", "```"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i INT, feedback STRING")
    template = Template()
    for row in rows.select("i", prompt_column(template, tx.SAMPLE, F.col("feedback")).alias("p")).collect():
        assert row.p == template.render(tx.SAMPLE, texts[row.i])
        assert row.p.startswith("\n") and row.p.endswith("\n")
    assert 'Message: "None"' in template.render(tx.SAMPLE, None)


class Client:
    def __init__(self, calls):
        self.calls = calls

    def chat(self, prompt):
        self.calls.add(1)
        prompt = prompt.rpartition('Message: "')[2]
        if "raise" in prompt:
            raise ValueError("no model")
        if "none" in prompt:
            return None
        if "bytes" in prompt:
            return b"{}"
        return GOOD


def test_one_call_a_row_and_faults_stay_in_their_row(spark):
    calls = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(["fine", "raise", "none", "bytes", None] * 20)], "feedback_id BIGINT, feedback STRING")
    engine = Classifier(lambda: Client(calls), {"any": 1}, taxonomy=tx.SAMPLE)
    out = engine.classify(rows)
    assert out.count() == 100
    got = {r.feedback_id: r for r in out.collect()}
    assert calls.value == 100
    assert got[0].status == "ok" and got[0].prediction_class == "A"
    assert got[1].reason == "System Error: no model" and got[1].error_class == "ValueError"
    assert got[2].error_class == "AttributeError" and got[3].error_class == "TypeError"
    assert got[4].status == "ok"
    assert engine.classify_one("fine") == json.loads(GOOD)
    assert engine.classify_one("raise")["reason"] == "System Error: no model"


def test_dedup_calls_once_a_text(spark):
    calls = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(i, ["same", "other", None][i % 3]) for i in range(60)], "feedback_id BIGINT, feedback STRING")
    out = Classifier(lambda: Client(calls), taxonomy=tx.SAMPLE).classify(rows, dedup=True)
    assert out.where("status = 'ok'").count() == 60
    assert calls.value == 3


def test_rate(spark):
    import time

    rows = spark.range(5).selectExpr("id AS feedback_id", "'x' AS prompt").coalesce(1)
    began = time.monotonic()
    assert infer(rows, Quiet, per_second=10).count() == 5
    assert time.monotonic() - began >= 0.4


class Quiet:
    def chat(self, prompt):
        return GOOD


def test_empty_input(spark):
    rows = spark.createDataFrame([], "feedback_id BIGINT, feedback STRING")
    assert Classifier(lambda: sys.exit(1), taxonomy=tx.SAMPLE).classify(rows).count() == 0


def test_lone_surrogate_and_fields(spark):
    rows = spark.createDataFrame([('{"reason": "\\ud800", "priority": 7}',), (None,)], "t STRING")
    good, none = parse_json(rows, "t").collect()
    assert good.raw_json == '{"reason": "\\ud800", "priority": 7}' and good.priority == "7" and good.reason == "?"
    assert none.raw_json is None and none.parse_class is None


def test_taxonomy(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text(json.dumps(tx.SAMPLE), encoding="utf-8")
    assert tx.load(str(path)) == tx.load(str(path), spark) == tx.SAMPLE
    assert tx.table(spark, tx.SAMPLE).count() == 11
    for bad in ([], {"a": "b"}, {"a": [1]}):
        with pytest.raises(TypeError):
            tx.validated(bad)


def test_stream_gives_the_batch_rows(spark, tmp_path):
    from tributary.plans.queries import Echo
    from tributary.sources.feedback import user_turns
    from tributary.streaming.feedback import classify_stream, read

    rows = user_turns(spark, "/root/testdata/sf0.001")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    query = classify_stream(Classifier(Echo, taxonomy=tx.SAMPLE), read(spark, str(tmp_path / "in"), schema="feedback_id STRING, feedback STRING"), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count()


def test_ids_go_through_untouched(spark):
    big = (1 << 60) + 1
    rows = spark.createDataFrame([(big, "fine"), (None, "fine"), (None, "raise"), (3, None)], "feedback_id BIGINT, feedback STRING")
    for options in ({}, {"dedup": True}):
        got = Classifier(lambda: Client(Adder()), taxonomy=tx.SAMPLE).classify(rows, **options).collect()
        assert sorted(((r.feedback_id, r.status) for r in got), key=str) == sorted([(big, "ok"), (None, "ok"), (None, "fallback"), (3, "ok")], key=str)
    replies = spark.createDataFrame([(big, GOOD, None, None), (None, "x", None, None)], "feedback_id BIGINT, response STRING, error_class STRING, error_text STRING")
    assert {(r.feedback_id, r.status) for r in results(replies).collect()} == {(big, "ok"), (None, "fallback")}
    odd = replies.selectExpr("struct(feedback_id, date'2024-01-31' AS d) AS feedback_id", "response", "error_class", "error_text")
    assert {r.feedback_id.feedback_id for r in results(odd).collect()} == {big, None}


def test_columns_named_like_parsed_ones(spark):
    row = parse_json(spark.createDataFrame([(GOOD, "own", 7)], "t STRING, reason STRING, n INT"), "t").first()
    assert (row.reason, row.n, row.t) == ("r", 7, GOOD)
    row = parse_json(spark.createDataFrame([(GOOD,)], "reason STRING"), "reason").first()
    assert row.reason == "r"


class Adder:
    def add(self, n):
        pass


class Slow:
    def __init__(self):
        self.calls = 0

    def chat(self, prompt):
        import time

        self.calls += 1
        if "hang" in prompt:
            time.sleep(60)
        if "again" in prompt and self.calls < 3:
            raise OSError("busy")
        return GOOD


def test_hanging_and_failing_calls(spark):
    rows = spark.createDataFrame([(1, "again"), (2, "hang"), (3, "fine")], "feedback_id BIGINT, prompt STRING").coalesce(1)
    got = {r.feedback_id: r.error_class for r in infer(rows, Slow, timeout=0.5, retries=2).collect()}
    assert got == {1: None, 2: "TimeoutError", 3: None}
    assert {r.error_text for r in infer(rows.where("feedback_id = 2"), Slow, timeout=0.1).collect()} == {"no reply within 0.1 s"}


def test_lookup_of_a_key_in_most_rows(spark):
    from tributary.operators.joins import lookup

    rows = spark.createDataFrame([(i, "hot" if i % 3 else None if i % 2 else f"k{i}", i % 2) for i in range(3000)], "id BIGINT, k STRING, b INT")
    facts = spark.createDataFrame([("hot", 0, 1), ("hot", 1, 2), (None, 1, 3), ("k6", 0, 4)], "k STRING, b INT, v INT")
    got = lookup(rows, facts, ["k", "b"], parts=16)
    assert got.columns == ["id", "k", "b", "v"] and got.count() == 3000
    known = {(r.k, r.b): r.v for r in facts.collect()}
    assert all(r.v == known.get((r.k, r.b)) for r in got.collect())
    assert lookup(rows.limit(0), facts, ["k", "b"]).count() == 0


def test_shared_folder(spark, monkeypatch):
    from tributary.operators import materialize

    made = materialize.materialize(spark.range(3))
    assert made.count() == 3
    materialize.clear()
    with pytest.raises(Exception):
        made.count()

    class Elsewhere:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(ValueError):
        materialize.shared_root(Elsewhere)
