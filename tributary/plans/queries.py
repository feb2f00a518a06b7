"""The registered queries of the classifier, and the same in DuckDB's SQL.

The tables hold feedback but no model replies, so ``reply`` makes one per document from its id, by an
expression that both engines have: eight shapes, good and bad.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.prompt import Template, prompt_column
from tributary.functions.response import BREAK, FENCE, INDEX_ERROR, clean
from tributary.operators.checks import lint, membership, outcomes
from tributary.operators.parse import ERROR_PREFIX, FALLBACK, FIELDS, results
from tributary.sources import taxonomy as tx
from tributary.sources.feedback import documents

SPACE = "".join(chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
ENTRIES = sum(map(len, tx.SAMPLE.values()))


class Echo:
    """A client without a network: answers with a class that depends on the prompt's length only."""

    def chat(self, prompt: str) -> str:
        names = list(tx.SAMPLE)
        return json.dumps({"prediction_class": names[len(prompt) % len(names)], "attribution": "other", "priority": "Low", "reason": f"{len(prompt)} characters"})


def body(key: Column) -> Column:
    """A good reply: class and leaf by the id, now and then outside the taxonomy."""
    pick = F.element_at(F.array(*map(F.lit, [*tx.SAMPLE, "Elsewhere"])), (key % 5 + 1).cast("int"))
    leaf = F.element_at(F.array(*map(F.lit, ["charged twice", "sign-in fails", "free text"])), (key % 3 + 1).cast("int"))
    level = F.element_at(F.array(*map(F.lit, ["High", "Medium", "Low", "Urgent"])), (F.floor(key / 8) % 4 + 1).cast("int"))
    return F.concat(F.lit('{"prediction_class": "'), pick, F.lit('", "attribution": "'), leaf, F.lit('", "priority": "'), level, F.lit('", "reason": "case '), key.cast("string"), F.lit('"}'))


def reply(key: Column) -> Column:
    good, shape = body(key), key % 8
    shapes = [
        good,
        F.concat(F.lit("　 \x1c"), good, F.lit(" \n")),
        F.concat(F.lit(f"{FENCE}json\n"), good, F.lit(f"\n{FENCE}")),
        F.concat(F.lit(f"{FENCE}json{BREAK}"), good, F.lit(f"{BREAK}{FENCE}")),
        F.concat(good, F.lit(f"\n{FENCE}")),
        F.concat(good, F.lit(f"{BREAK}{FENCE}")),
        F.lit(" "),
        good.substr(F.lit(1), F.lit(40)),
    ]
    column = F.when(shape == 0, shapes[0])
    for i, x in enumerate(shapes[1:], 1):
        column = column.when(shape == i, x)
    return column


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``infer`` would have made, with the replies above."""
    none = F.lit(None).cast("string")
    return documents(spark, sf_dir).select("feedback_id", reply(F.col("feedback_id")).alias("response"), none.alias("error_class"), none.alias("error_text"))


def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.table(spark, tx.SAMPLE)


def q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lint(tx.table(spark, tx.SAMPLE))


def q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = prompt_column(Template(), tx.SAMPLE, F.col("feedback"))
    return documents(spark, sf_dir).select("feedback_id", F.md5(text).alias("prompt_md5"), F.length(text).cast("bigint").alias("prompt_chars"))


def q4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses(spark, sf_dir).withColumn("c", clean(F.col("response"))).select("feedback_id", F.col("c.error").alias("error"), F.col("c.cleaned").alias("cleaned"))


def q5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(responses(spark, sf_dir)).where("status = 'ok'").select("feedback_id", *FIELDS)


def q6(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [*FIELDS[:3], F.when(F.col("status") == "ok", F.col("reason")).when(F.col("error_class") == "IndexError", F.col("reason")).alias("reason")]
    return results(responses(spark, sf_dir)).select("feedback_id", "status", "error_class", *fields)


def q7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership(results(responses(spark, sf_dir)), tx.table(spark, tx.SAMPLE), ENTRIES)


def q8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes(results(responses(spark, sf_dir)))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole engine with a client that needs no network."""
    from tributary.plans.classifier import Classifier

    return Classifier(Echo, taxonomy=tx.SAMPLE).classify(documents(spark, sf_dir)).select("feedback_id", "status", *FIELDS)


class Faulty:
    """A client that raises, returns None, bytes or nothing, or answers well, by the number at the feedback's end."""

    def chat(self, prompt: str) -> object:
        n = int(prompt.rpartition(" case ")[2].partition('"')[0])
        if n % 5 == 0:
            raise ConnectionError(f"no way to the model in case {n}")
        return [None, b"{}", "", json.dumps({"prediction_class": "Display", "attribution": "", "priority": "Low", "reason": f"case {n}"})][n % 5 - 1]


def q10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of calls that fail, over the whole engine."""
    from tributary.plans.classifier import Classifier

    numbered = F.concat(F.coalesce("feedback", F.lit("")), F.lit(" case "), F.col("feedback_id").cast("string"))
    feedback = documents(spark, sf_dir).select("feedback_id", numbered.alias("feedback"))
    return Classifier(Faulty, taxonomy=tx.SAMPLE).classify(feedback).select("feedback_id", "status", "error_class", "error_text", *FIELDS)


QUERIES = {
    "q1_taxonomy_table": q1,
    "q2_taxonomy_lint": q2,
    "q3_prompt": q3,
    "q4_clean": q4,
    "q5_parse": q5,
    "q6_fallback": q6,
    "q7_membership": q7,
    "q8_outcomes": q8,
    "q9_classify": classified,
    "q10_faulty_calls": q10,
}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rows(values: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(quoted(x) if isinstance(x, str) else str(x) for x in row) + ")" for row in values)


TAXONOMY_SQL = "SELECT * FROM (VALUES " + rows([(i, name, j, leaf) for i, (name, leaves) in enumerate(tx.SAMPLE.items()) for j, leaf in enumerate(leaves)]) + ") t(class_ord, class, leaf_ord, leaf)"
LIST = lambda xs: "[" + ", ".join(map(quoted, xs)) + "]"
BODY_SQL = f"""'{{"prediction_class": "' || ({LIST([*tx.SAMPLE, "Elsewhere"])})[doc_id % 5 + 1] || '", "attribution": "' || ({LIST(["charged twice", "sign-in fails", "free text"])})[doc_id % 3 + 1]
    || '", "priority": "' || ({LIST(["High", "Medium", "Low", "Urgent"])})[(doc_id // 8) % 4 + 1] || '", "reason": "case ' || doc_id || '"}}'"""
BASE_SQL = f"""WITH good AS (SELECT doc_id AS feedback_id, {BODY_SQL} AS g FROM documents),
raw AS (SELECT feedback_id, CASE feedback_id % 8 WHEN 0 THEN g WHEN 1 THEN chr(12288) || ' ' || chr(28) || g || chr(160) || chr(10)
    WHEN 2 THEN '```json' || chr(10) || g || chr(10) || '```' WHEN 3 THEN '```json\\n' || g || '\\n```' WHEN 4 THEN g || chr(10) || '```'
    WHEN 5 THEN g || '\\n```' WHEN 6 THEN ' ' ELSE left(g, 40) END AS r FROM good),
t1 AS (SELECT feedback_id, trim(r, {" || ".join(f"chr({ord(c)})" for c in SPACE)}) AS t FROM raw),
t2 AS (SELECT feedback_id, CASE WHEN NOT starts_with(t, '```') THEN t WHEN instr(t, '\\n') > 0 THEN substr(t, instr(t, '\\n') + 2) END AS t FROM t1),
cleaned AS (SELECT feedback_id, CASE WHEN t IS NULL THEN {quoted(INDEX_ERROR)} END AS error,
    CASE WHEN ends_with(t, '```') AND instr(t, '\\n') > 0 THEN left(t, length(t) - 2 - length(string_split(t, '\\n')[-1])) ELSE t END AS cleaned FROM t2),
judged AS (SELECT *, error IS NULL AND json_valid(cleaned) AS good FROM cleaned),
res AS (SELECT feedback_id, CASE WHEN good THEN 'ok' ELSE 'fallback' END AS status, CASE WHEN good THEN NULL WHEN error IS NULL THEN 'JSONDecodeError' ELSE 'IndexError' END AS error_class,
    {", ".join(f"CASE WHEN good THEN json_extract_string(cleaned, '$.{x}') ELSE {quoted(FALLBACK[x])} END AS {x}" for x in FIELDS[:3])},
    CASE WHEN good THEN json_extract_string(cleaned, '$.reason') WHEN error IS NOT NULL THEN {quoted(ERROR_PREFIX)} || error END AS reason FROM judged)
"""


def text_sql(*parts: str) -> str:
    """Literals and expressions in turn, joined."""
    return " || ".join(quoted(x) if i % 2 == 0 else x for i, x in enumerate(parts))


def lines_sql(xs: list[str]) -> str:
    """A line for each element, after a mark."""
    return f"(SELECT string_agg('* ' || x || chr(10), '' ORDER BY i) FROM (SELECT unnest({LIST(xs)}) AS x, generate_subscripts({LIST(xs)}, 1) AS i))"


def prompt_sql() -> str:
    """The prompt from the template's fields and the taxonomy's rows, put together by SQL, JSON text included."""
    t = Template()
    leaves = f"SELECT class_ord, class, string_agg('    ' || to_json(leaf)::VARCHAR, ',' || chr(10) ORDER BY leaf_ord) AS leaves FROM ({TAXONOMY_SQL}) GROUP BY ALL"
    one = "'  ' || to_json(class)::VARCHAR || ': [' || chr(10) || leaves || chr(10) || '  ]'"
    tree = f"(SELECT '{{' || chr(10) || string_agg({one}, ',' || chr(10) ORDER BY class_ord) || chr(10) || '}}' FROM ({leaves}))"
    cases = " || chr(10) || ".join(text_sql(f'{t.message}: "', quoted(x.input), f'"\n{t.reply}:\n', quoted(x.output_json), "\n") for x in t.cases)
    rules = text_sql(f"\n\n{t.answer_heading}\n", lines_sql(list(t.answer)), f"\n{t.advice_heading}\n", lines_sql(list(t.advice)), f"\n{t.taxonomy_heading}\n", tree)
    return text_sql("\n", quoted(t.opening), "", rules, f"\n\n{t.cases_heading}\n", cases, f'\n{t.message}: "', "coalesce(text, 'None')", f'"\n{t.reply}:\n')


PROMPT_SQL = prompt_sql()
FAULTS_SQL = """SELECT feedback_id, CASE WHEN n = 4 THEN 'ok' ELSE 'fallback' END AS status, e AS error_class, m AS error_text,
    CASE WHEN n = 4 THEN 'Display' ELSE '未分类' END AS prediction_class, CASE WHEN n = 4 THEN '' ELSE '解析失败' END AS attribution, 'Low' AS priority,
    CASE WHEN n = 4 THEN 'case ' || feedback_id ELSE 'System Error: ' || m END AS reason
FROM (SELECT doc_id AS feedback_id, doc_id % 5 AS n, (['ConnectionError', 'AttributeError', 'TypeError', 'JSONDecodeError', NULL])[n + 1] AS e,
    (['no way to the model in case ' || doc_id, '''NoneType'' object has no attribute ''strip''', 'startswith first arg must be bytes or a tuple of bytes, not str',
      'Expecting value: line 1 column 1 (char 0)', NULL])[n + 1] AS m FROM documents)"""

ORACLE = {
    "q1_taxonomy_table": TAXONOMY_SQL,
    "q2_taxonomy_lint": f"SELECT leaf, count(DISTINCT class) AS n_classes, count(*) AS n_entries FROM ({TAXONOMY_SQL}) GROUP BY leaf HAVING count(DISTINCT class) > 1 OR leaf = ''",
    "q3_prompt": f"SELECT doc_id AS feedback_id, md5({PROMPT_SQL}) AS prompt_md5, length({PROMPT_SQL})::BIGINT AS prompt_chars FROM documents",
    "q4_clean": BASE_SQL + "SELECT feedback_id, error, cleaned FROM cleaned",
    "q5_parse": BASE_SQL + f"SELECT feedback_id, {', '.join(FIELDS)} FROM res WHERE status = 'ok'",
    "q6_fallback": BASE_SQL + f"SELECT feedback_id, status, error_class, {', '.join(FIELDS)} FROM res",
    "q7_membership": BASE_SQL
    + f""", tax AS ({TAXONOMY_SQL}) SELECT feedback_id, prediction_class IN (SELECT class FROM tax) AS class_ok,
    EXISTS (SELECT 1 FROM tax WHERE class = prediction_class AND leaf = attribution) AS leaf_ok, priority IN ('High', 'Medium', 'Low') AS priority_ok FROM res""",
    "q8_outcomes": BASE_SQL + "SELECT status, prediction_class, priority, error_class, count(*) AS n FROM res GROUP BY ALL",
    "q9_classify": f"""SELECT doc_id AS feedback_id, 'ok' AS status, ({LIST(list(tx.SAMPLE))})[n % {len(tx.SAMPLE)} + 1] AS prediction_class, 'other' AS attribution, 'Low' AS priority, n || ' characters' AS reason
    FROM (SELECT doc_id, length({PROMPT_SQL}) AS n FROM documents)""",
    "q10_faulty_calls": FAULTS_SQL,
}
