"""Byte-level BPE, encoding and decoding, by a file of ranks.

Texts are dealt out as chunks of ``chunk`` characters that overlap; each is cut into pre-tokens on its own, in parallel.
A text of one chunk is done with where it lies, in the only scan of the rows; of others, the chunks are written
under a name of their own, made where they are written, so that what is sewn together later is one text's chunks even if
rows come in another order when a lost executor's work is done again. The start of a chunk may lie inside a pre-token, but how the
pattern goes on from a place depends on nothing before it: once two neighbours have a boundary in common inside
the overlap, they agree from there on, and there they are stitched. Boundaries within ``EDGE`` characters of a
chunk's end do not count, as what follows could still change them. A pair without a common boundary (one
pre-token as long as the overlap) is joined and cut again. Then the pieces are encoded, each distinct one once
per worker.

Decoding concatenates the bytes of the ids.

Nulls: a null text counts as empty, with no ids. Repeated rows are encoded alike. An empty table gives an empty
table. Texts of any length are encoded whole; the pieces of one text lie in a worker's memory. There are no ties. Other columns pass; those that are added replace any of the same name.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.pretoken import Splitter
from tributary.llm.scratch import saved
from tributary.llm.worker import held, slices, tidy

CHUNK, OVERLAP, EDGE = 32_768, 1_024, 4
#: Pre-tokens that a worker remembers, and their length in characters at most: some 60 MB.
KNOWN, LONGEST = 150_000, 48
MADE = ("ids", "n_tokens", "ids_sha256", "decoded_sha256")


class Codec:
    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes = {v: k for k, v in ranks.items()}
        self.known: dict[str, tuple[str, int, bytes]] = {}
        single = {bytes([i]): i for i in range(256)}

        def keep(name: str):
            only = tiktoken.Encoding("class", pat_str=f"{name}+", mergeable_ranks=single, special_tokens={})
            return lambda text: bytes(only.encode_ordinary(text)).decode()

        self.split = Splitter(pattern, lambda: {k: keep(k) for k in (r"\p{L}", r"\p{N}", r"\s")})

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def piece(self, text: str) -> tuple[str, int, bytes]:
        """A pre-token's ids as decimals joined by commas, their number, and the bytes they stand for."""
        got = self.known.get(text)
        if got is None:
            ids = self.library.encode_ordinary(text)
            got = (",".join(map(str, ids)), len(ids), self.decode(ids))
            if len(text) <= LONGEST:
                if len(self.known) >= KNOWN:
                    self.known.clear()
                self.known[text] = got
        return got

    def pieces(self, texts: list[str]) -> list[tuple[str, int, bytes]]:
        return list(map(self.piece, texts))


def codec(path: str, pattern: str) -> Codec:
    """One per worker; tasks that follow on the same worker find it warm."""
    return held(Codec, path, pattern)


def digests(parts: list[tuple[str, int, bytes]]) -> tuple[str, int, str]:
    """The ids as text, their number, and the digest of the decoded bytes."""
    return ",".join([x[0] for x in parts]), sum([x[1] for x in parts]), hashlib.sha256(b"".join([x[2] for x in parts])).hexdigest()


def stitch(left: list[int], right: list[int]) -> int | None:
    """The first place at which both sides have a boundary."""
    common = set(left).intersection(right)
    return min(common) if common else None


def offsets(pieces: list[str], base: int) -> np.ndarray:
    return base + np.concatenate([[0], np.cumsum([len(x) for x in pieces])])[:-1].astype(np.int64) if pieces else np.zeros(0, np.int64)


def join_chunks(coder: Codec, texts: list[str], chunk: int, overlap: int, cut: list[tuple[list[str], np.ndarray]] | None = None) -> list[str]:
    """The pre-tokens of the whole text, from its chunks in order."""
    cut = cut or [(p := coder.split(x), offsets(p, i * chunk)) for i, x in enumerate(texts)]
    out: list[str] = []
    pieces, starts = cut[0]
    end = len(texts[0])
    own = texts[0]
    for i in range(1, len(texts)):
        more, heads = cut[i]
        base = i * chunk
        fresh = base + len(texts[i])
        tail = starts[np.searchsorted(starts, base) :]
        place = stitch([int(x) for x in tail if x <= end - EDGE], [int(x) for x in heads[heads <= end - EDGE]])
        if place is None:  # one pre-token covers the overlap: the two become one
            first = int(starts[0])
            own = own[len(own) - (end - first) :] + texts[i][end - base :]
            pieces = coder.split(own)
            starts = offsets(pieces, first)
        else:
            k = int(np.searchsorted(starts, place))
            out += pieces[:k]
            j = int(np.searchsorted(heads, place))
            pieces, starts = more[j:], heads[j:]
            own = texts[i][place - base :]
        end = fresh
    return out + pieces


def encode(df: DataFrame, path: str, pattern: str, *, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP, ids: bool = False) -> DataFrame:
    """Adds ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if wanted, the ``ids`` as an array; the text is left behind.

    ``path`` must be there on every executor, as with an installed package. What the scan makes is written, once;
    what is made from it is made again from there when an executor is lost.
    """
    if overlap >= chunk or overlap <= EDGE:
        raise ValueError("the overlap must lie between the edge and the chunk")
    others = [x for x in df.columns if x != text and x not in MADE]
    rows = df.select(*others, F.coalesce(F.col(text), F.lit("")).alias(text))
    schema = T.StructType([rows.schema[x] for x in others])
    if ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    names = schema.fieldNames()

    def finished(kept: list[pa.Array], coded: list[tuple[str, int, str]]) -> pa.RecordBatch:
        arrays = list(kept)
        if ids:
            arrays.append(pa.array([[int(x) for x in c[0].split(",")] if c[0] else [] for c in coded], pa.list_(pa.int32())))
        arrays += [pa.array([c[1] for c in coded], pa.int64()), pa.array([hashlib.sha256(c[0].encode()).hexdigest() for c in coded], pa.string()), pa.array([c[2] for c in coded], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names)

    empty = [("", 0, "")]
    cut_schema = T.StructType([*schema]).add("__row", "string").add("__part", "integer").add("__piece", "string")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in slices(batches, len(others)):
            column = batch.column(len(others))
            at, coded, kept = [], [], []
            for i in range(batch.num_rows):
                whole = column[i].as_py()
                if len(whole) <= chunk:
                    coded.append(digests(coder.pieces(coder.split(whole))))
                    kept.append(i)
                else:
                    name = uuid.uuid4().hex
                    at += [(i, name, k, whole[k * chunk : (k + 1) * chunk + overlap]) for k in range(-(-len(whole) // chunk))]
            done = finished([x.take(pa.array(kept, pa.int64())) for x in batch.columns[: len(others)]], coded)
            none = [pa.nulls(len(kept), t) for t in (pa.string(), pa.int32(), pa.string())]
            yield pa.RecordBatch.from_arrays([*done.columns, *none], cut_schema.fieldNames())
            for i, name, k, piece in at:
                part = finished([x.slice(i, 1) for x in batch.columns[: len(others)]], empty)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([name]), pa.array([k], pa.int32()), pa.array([piece])], cut_schema.fieldNames())

    dealt = saved(rows.mapInArrow(tidy(cut), cut_schema), "chunks")
    kept = F.when(F.col("__part") == 0, F.struct(*others, F.lit(0).alias("__"))).alias("__kept")
    more = dealt.where(F.col("__row").isNotNull()).select("__row", "__part", kept, "__piece")
    return dealt.where(F.col("__row").isNull()).select(*names).unionByName(long_texts(more, path, pattern, chunk, overlap, others, schema, finished))


def long_texts(dealt: DataFrame, path: str, pattern: str, chunk: int, overlap: int, others: list[str], schema: T.StructType, finished) -> DataFrame:
    """Cuts the chunks, each in a task of its own, then stitches and encodes each document's.

    A chunk sends on its text and the lengths of its pre-tokens, a byte for each as a rule.
    """
    coded = T.StructType([dealt.schema["__row"], dealt.schema["__part"], dealt.schema["__kept"]]).add("__piece", "string").add("__sizes", "binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                sizes = np.array([len(x) for x in coder.split(row.column(3)[0].as_py())], np.uint32)
                small = sizes.astype(np.uint8) if not len(sizes) or sizes.max() < 256 else sizes
                packed = (b"\x01" if small.dtype == np.uint8 else b"\x04") + small.tobytes()
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([packed], pa.binary())], coded.fieldNames())

    def sew(table: pa.Table) -> pa.Table:
        coder = codec(path, pattern)
        table = table.sort_by("__part")
        texts = table.column("__piece").to_pylist()
        cuts = []
        for i, (piece, packed) in enumerate(zip(texts, table.column("__sizes").to_pylist(), strict=True)):
            ends = np.cumsum(np.frombuffer(packed, np.uint8 if packed[0] == 1 else np.uint32, offset=1).astype(np.int64))
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
            cuts.append(([piece[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], starts + i * chunk))
        parts = digests(coder.pieces(join_chunks(coder, texts, chunk, overlap, cuts)))
        kept = table.column("__kept").combine_chunks()
        first = kept.slice(0, 1)
        arrays = [pc.struct_field(first, [i]) for i in range(len(others))]
        return pa.Table.from_batches([finished(arrays, [parts])])

    return dealt.repartition("__row", "__part").mapInArrow(tidy(cut), coded).groupBy("__row").applyInArrow(sew, schema)

