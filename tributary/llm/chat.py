"""Chat formatting with Spark expressions only.

A conversation's rows are collected as structs and sorted by turn, then role, then text. Adjacent rows of one
role become one block; within it a separator keeps the rows apart, so that nothing is lost::

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

Control strings inside texts get a backslash after their first character (one more, if there are some), which
``unescape`` takes away: formatting is reversible. The loss mask covers the assistant's texts, without markers.

Nulls: a null text or role counts as empty, null turns come first, rows with a null conversation form one.
Repeated rows stay, each as a turn. An empty table gives an empty table. Other columns are left behind.
A conversation becomes one row, and so has to fit in a task; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's markers.
START, END, SEP, NEWLINE = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>", "<|im_nl|>"
#: What follows the opening character of a control string; those of other common templates are escaped too.
TAILS = r"(?=\||/?s>|/?INST\]|<SYS>>|</SYS>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){TAILS}", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){TAILS}", "$1$2")


def quoted(marker: str) -> str:
    return rf"\Q{marker}\E"


def runs(turns: Column) -> Column:
    """Adjacent structs of one role, merged: ``array<struct<role, texts>>``. Linear in the turns."""
    places = F.sequence(F.lit(0), F.size(turns) - 1)
    starts = F.filter(places, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(turns)))
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(F.get(turns, a)["role"].alias("role"), F.transform(F.slice(turns, a + 1, b - a), lambda x: x["text"]).alias("texts")),
    )


def segments(merged: Column, trained: str) -> Column:
    """The output in pieces, ``array<struct<text, loss>>``: their texts in a row are the formatted text."""

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def block(run: Column) -> Column:
        loss = run["role"] == trained
        role = F.replace(escape(run["role"]), F.lit("\n"), F.lit(NEWLINE))
        inner = F.transform(
            run["texts"],
            lambda text, i: F.array(piece(F.when(i == 0, F.concat(F.lit(START), role, F.lit("\n"))).otherwise(F.lit(SEP)), F.lit(False)), piece(escape(text), loss)),
        )
        return F.concat(F.flatten(inner), F.array(piece(F.lit(END), F.lit(False))))

    return F.flatten(F.transform(merged, block))


def format_chats(df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant") -> DataFrame:
    """``(conv_id, formatted STRING, segments ARRAY<STRUCT<text, loss>>)``, one row per conversation."""
    row = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    grouped = df.groupBy(F.col(conv).alias(conv)).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    cut = grouped.select(conv, runs(F.col("turns")).alias("merged")).select(conv, segments(F.col("merged"), trained).alias("segments"))
    return cut.select(conv, F.array_join(F.transform("segments", lambda x: x["text"]), "").alias("formatted"), "segments")


def read_back(formatted: Column) -> Column:
    """The turns as they were: ``array<struct<role, text>>``, from the formatted text alone."""
    blocks = F.slice(F.split(formatted, quoted(START), -1), 2, 2_000_000_000)

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = unescape(F.replace(head, F.lit(NEWLINE), F.lit("\n")))
        body = block.substr(F.length(head) + 2, F.length(block) - F.length(head) - F.lit(1 + len(END)))
        return F.transform(F.split(body, quoted(SEP), -1), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(pieces: Column) -> Column:
    """All text under the mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(pieces, lambda x: x["loss"]), lambda x: unescape(x["text"])), "")
