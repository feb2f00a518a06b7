"""Cleaning of raw replies: outer white space and Markdown fences, as expressions and in Python.

``compat`` looks for the two characters backslash and ``n`` beside a fence, so that a reply fenced by
real line breaks is an error. ``strict_fence`` (an extension) takes real line breaks as well.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fence, the two-character line break, Python's white space, the message of a missing part.
FENCE = "```"
BREAK = "\\n"
SPACE_CLASS = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
INDEX_ERROR = "list index out of range"

MODES = ("compat", "strict_fence")


def strip(text: Column) -> Column:
    """Removes all of Python's white space at both ends; ``trim`` would remove U+0020 only."""
    return F.regexp_replace(text, rf"\A{SPACE_CLASS}++|(?<!{SPACE_CLASS}){SPACE_CLASS}++\z", "")


def clean(response: Column, mode: str = "compat") -> Column:
    """``struct(error, cleaned)``: the message of the opening fence's error or null, and the text to parse.

    Null gives null in both fields.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    text = strip(response)
    if mode == "strict_fence":
        opened = F.regexp_replace(text, r"\A```[^\n\\]*+(?:\n|\\n)", "")
        return F.struct(F.lit(None).cast("string").alias("error"), strip(F.regexp_replace(opened, r"(?:\n|\\n)?```\z", "")).alias("cleaned"))
    at = F.instr(text, BREAK)
    opens = F.startswith(text, F.lit(FENCE))
    inner = F.when(opens, text.substr(at + F.lit(2), F.length(text))).otherwise(text)
    tail = F.length(F.substring_index(inner, BREAK, -1))
    closed = F.endswith(inner, F.lit(FENCE)) & (F.instr(inner, BREAK) > 0)
    cut = F.when(closed, inner.substr(F.lit(1), F.length(inner) - F.lit(2) - tail)).otherwise(inner)
    missing = opens & (at == 0)
    return F.struct(
        F.when(missing, F.lit(INDEX_ERROR)).alias("error"),
        F.when(~missing, cut).alias("cleaned"),
    )


def clean_text(response: str, mode: str = "compat") -> str:
    """The same for one reply in Python; raises what the expression reports."""
    text = response.strip()
    if mode == "strict_fence":
        text = re.sub(r"\A```[^\n\\]*(?:\n|\\n)", "", text)
        return re.sub(r"(?:\n|\\n)?```\Z", "", text).strip()
    if text.startswith(FENCE):
        _, found, text = text.partition(BREAK)
        if not found:
            raise IndexError(INDEX_ERROR)
    if text.endswith(FENCE):
        head, found, _ = text.rpartition(BREAK)
        text = head if found else text
    return text
