"""The operators' queries, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bpe, chat, decontaminate, extract, langid, neardup, pii, pipeline, quality, sharding, token_counts

SHARDS = [f"shard-{i:02d}" for i in range(16)]
SLOTS = 2039


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "source", F.octet_length("text").cast("bigint").alias("n_bytes"))
    return sharding.place(docs, "doc_id", SHARDS, SLOTS)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer("byte_bpe_50k.json"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "pii")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.BASE_KINDS]
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select("doc_id", *counts, sha256(listed(base)).alias("base_sha256"), listed(F.col("pii")).alias("spans"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(extra)
    made = chat.format_chats(rows).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        sha256(digest).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        sha256(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), percent=85).drop("seal")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = read(spark, sf_dir, "benchmark", "item_id", "text")
    found = decontaminate.find(read(spark, sf_dir, "documents", "doc_id", "text"), benchmark)
    items = F.array_sort(F.transform("found.items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "found.n_words",
        decontaminate.hit_words(F.col("found")).alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        sha256(F.array_join(items, ",")).alias("items_sha256"),
        (F.size("found.items") >= 2).alias("contaminated"),
    )


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read(spark, sf_dir, "documents", "doc_id", "text"), keep_text=False)
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "quality")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.fit(read(spark, sf_dir, "documents", "text", "lang"), "text", "lang")
    return langid.identify(read(spark, sf_dir, "pages", "page_id", "url", "html"), model)


QUERIES = {
    "op1_sharding": op1,
    "op2_html_text": op2,
    "op3_token_counts": op3,
    "op4_pii": op4,
    "op5_chat_formatting": op5,
    "op6_byte_bpe": op6,
    "op7_near_duplicates": op7,
    "op8_decontamination": op8,
    "op9_quality_rules": op9,
    "op10_language_id": op10,
    "pipeline": pipeline.run,
}

OP1_SQL = f"""WITH RECURSIVE names AS (SELECT i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS name FROM range({len(SHARDS)}) t(i)),
prefs AS (SELECT list(('0x' || substr(md5('offset:' || name), 1, 12))::BIGINT % {SLOTS} ORDER BY i) AS off,
    list(('0x' || substr(md5('skip:' || name), 1, 12))::BIGINT % {SLOTS - 1} + 1 ORDER BY i) AS skip FROM names),
turns(n, claimed) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
    SELECT n + 1, claimed || [(SELECT first(s ORDER BY j) FROM (SELECT j, (off[n % {len(SHARDS)} + 1] + j * skip[n % {len(SHARDS)} + 1]) % {SLOTS} AS s
        FROM prefs, range({SLOTS}) r(j)) WHERE NOT list_contains(claimed, s))] FROM turns WHERE n < {SLOTS}),
owner AS (SELECT unnest(claimed) AS slot, (generate_subscripts(claimed, 1) - 1) % {len(SHARDS)} AS shard FROM turns WHERE n = {SLOTS}),
keyed AS (SELECT doc_id, source, strlen(text)::BIGINT AS n_bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
SELECT doc_id, source, n_bytes, slot, shard::INTEGER AS shard FROM keyed JOIN owner USING (slot)"""

ESCAPED = r"""regexp_replace({}, '([<\[])(\\*)(\||/?s>|/?INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g')"""
OP5_SQL = rf"""WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]'))),
k AS (SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS same, row_number() OVER w AS place FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length({ESCAPED.format("text")}) + CASE WHEN same THEN {len(chat.SEP)}
        ELSE {len(chat.START) + 1 + len(chat.END)} + length(replace({ESCAPED.format("role")}, chr(10), '{chat.NEWLINE}')) END)::BIGINT AS formatted_chars
FROM k GROUP BY conv_id"""

WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP8_SQL = f"""WITH b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 8) AS n, array_to_string(w[i:i + least(len(w), 8) - 1], ' ') AS key
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS key FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
hits AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, key)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

OP7_SQL = r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
sym AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM sym UNION SELECT r.x, b.y FROM reach r JOIN sym b ON r.y = b.x),
low AS (SELECT x AS doc_id, min(y) AS y FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id, doc_id <= coalesce(y, doc_id) AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN low USING (doc_id)"""

ORACLE = {"op1_sharding": OP1_SQL, "op5_chat_formatting": OP5_SQL, "op7_near_duplicates": OP7_SQL, "op8_decontamination": OP8_SQL}
