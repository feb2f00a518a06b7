"""Counts of a text's tokens, without their ids.

Within a task, each document's pre-tokens are counted; the distinct ones that are new are given to the library
once, which says into how many pieces each falls; these counts are joined to the documents' frequencies and
summed. Joined are two small tables in the worker's memory: the documents' pre-tokens, many times the input as
rows, never go through a shuffle. The table of known pre-tokens is bounded; when full, it begins anew, which
costs time and changes no result.

Nulls: a null text counts as empty, with 0 tokens. Repeated rows are counted alike. An empty table gives an
empty table. Other columns pass; those that are added replace any of the same name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm.pretoken import Splitter

#: Pre-tokens that a worker remembers, and their length in characters at most: some 100 MB.
KNOWN, LONGEST = 400_000, 64


class Counts:
    """Tokens per text, for a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        from tokenizers import Regex as Pattern

        self.library = Tokenizer.from_file(path)
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, int] = {}
        import public_tokenizers

        def keep(name: str):
            cut = pre_tokenizers.Split(Pattern(rf"[^{name}]+" if name != r"\s" else r"\S+"), "removed")
            return lambda text: "".join(x for x, _ in cut.pre_tokenize_str(text))

        self.split = Splitter(public_tokenizers.PATTERN, lambda: {k: keep(k) for k in (r"\p{L}", r"\p{N}", r"\s")})

    def pieces(self, texts: list[str]) -> list[int]:
        """The number of tokens of each pre-token."""
        return [len(x) for x in self.library.encode_batch(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        freqs, extra = [], []
        for text in texts:
            n = 0
            for word in self.special:  # the library takes these out first, each as one token
                if word in text:
                    n += text.count(word)
            parts = [text]
            if n:
                for word in self.special:
                    parts = [p for part in parts for p in part.split(word)]
            freq: Counter[str] = Counter()
            for part in parts:
                freq.update(self.split(part))
            freqs.append(freq)
            extra.append(n)
        known = self.known
        new = list({x for freq in freqs for x in freq if x not in known})
        if len(known) + len(new) > KNOWN:
            known.clear()
            new = list({x for freq in freqs for x in freq})
        known.update(zip(new, self.pieces(new), strict=True))
        counts = [n + sum(map(int.__mul__, freq.values(), map(known.__getitem__, freq))) for freq, n in zip(freqs, extra, strict=True)]
        for x in new:
            if len(x) > LONGEST:
                del known[x]
        return counts


@lru_cache(maxsize=1)
def counts(path: str) -> Counts:
    """One per worker; tasks that follow on the same worker find it warm."""
    return Counts(path)


#: Characters of text that are counted together.
TOGETHER = 4_000_000


def count_tokens(df: DataFrame, path: str, *, text: str = "text", limit: int = 512, keep_text: bool = False) -> DataFrame:
    """Adds ``n_bytes BIGINT``, ``n_tokens BIGINT`` and ``over_limit BOOLEAN``, for the tokenizer file at ``path``.

    The path must be there on every executor, as with an installed package.
    """
    made = ("n_bytes", "n_tokens", "over_limit")
    kept = [x for x in df.columns if x not in made and (keep_text or x != text)]
    rows = df.select(*kept, *([] if text in kept else [text]))
    schema = rows.select(*kept).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")
    place = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counts(path)
        for batch in batches:
            texts = [x or "" for x in batch.column(place).to_pylist()]
            tokens, group, size = [], [], 0
            for x in texts:
                group.append(x)
                size += len(x)
                if size > TOGETHER:
                    tokens += counter.count(group)
                    group, size = [], 0
            tokens += counter.count(group)
            added = [pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in kept] + added, [*kept, *made])

    return rows.mapInArrow(run, schema)
