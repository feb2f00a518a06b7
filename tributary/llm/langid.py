"""Language of web pages by Bayesian fusion: text, declared language, address suffix and host.

The text's likelihood comes from a naive Bayes model over hashed byte trigrams, fitted on a bounded sample of
labelled rows and their whole texts. Each page's likelihoods give soft counts of languages, which grouped aggregations over all pages
sum up by host, by domain, by address suffix, and by what the markup declares. A host's prior is smoothed towards
its domain's, that towards the suffix's, and that towards the whole's; how far a declaration speaks for a language
is counted in the same way. A page's own soft count is taken out of what it is judged by. The posterior multiplies
likelihood, prior and declaration.

Nulls: a null page or one without text has even likelihoods; a null or odd address belongs to the host named by
the empty string; a missing declaration counts as one of its own. Repeated rows are judged alike. Of languages that
are equally likely the first by name is taken. Pages of any length are read whole, in linear time, one at a time. An
empty table gives an empty table. Other columns pass; those that are added replace any of the same name.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import nsmallest
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.scratch import saved
from tributary.operators.joins import lookup

#: Labelled rows in the sample; their whole texts are used.
SAMPLE_ROWS = 2_000
BUCKETS = 1 << 16
#: Trigrams of a text are not independent: this much of their log-likelihood is believed, up to a bound.
TEMPER, BOUND = 0.05, 30.0
#: Soft pages that a level's parent counts for.
WEIGHT = 8.0

GONE = re.compile(r"<!--(?:[^-]|-(?!->))*+(?:-->|\Z)|<(script|style|noscript|template|title)\b[^>]*>(?:[^<]|<(?!/\1))*+(?:</\1[^>]*>|\Z)|<[a-zA-Z/!?][^>]*+>", re.IGNORECASE)
PLACES = re.compile(r"<!--|<(html|meta|script|style|title|textarea)\b", re.IGNORECASE)
LANG = r"\s*+=\s*+[\"']?\s*+([a-zA-Z]{2,8})(?![a-zA-Z])"
DECLARED = [re.compile(rf"\s{name}{LANG}", re.IGNORECASE) for name in ("lang", "xml:lang")]
META = re.compile(r"\shttp-equiv\s*+=\s*+[\"']?content-language\b", re.IGNORECASE)
CONTENT = re.compile(rf"\scontent{LANG}", re.IGNORECASE)
SIGNS = ("lang", "probability", "declared", "text_lang")


def plain(page: str | None) -> str:
    """The page's text, roughly: without markup, scripts and styles."""
    text = GONE.sub(" ", page or "")
    return unescape(text) if "&" in text else text


def declared(page: str | None) -> str | None:
    """What the first ``<html`` tag with a language says, by ``lang`` or else ``xml:lang``; without one, a ``content-language``.

    The whole page is searched, but for comments and raw text; each tag is read once, up to its ``>``.
    """
    page, at, meta = page or "", 0, None
    while tag := PLACES.search(page, at):
        name = (tag[1] or "").lower()
        if name in ("html", "meta"):
            at = page.find(">", tag.end())
            at = len(page) if at < 0 else at
            if name == "html":
                for pattern in DECLARED:
                    if m := pattern.search(page, tag.end(), at):
                        return m[1].lower()
            elif meta is None and META.search(page, tag.end(), at) and (m := CONTENT.search(page, tag.end(), at)):
                meta = m[1].lower()
        else:
            ended = re.compile(rf"</{name}" if name else "--!?>", re.IGNORECASE).search(page, tag.end() if name else tag.end() - 2)
            if ended is None:
                break
            at = ended.end()
    return meta


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-case text's bytes; digits and marks count as blanks, and blanks once."""
    raw = np.frombuffer((" " + re.sub(r"[\W\d_]+", " ", text.lower()) + " ").encode(), np.uint8).astype(np.uint32)
    if len(raw) < 5:
        return np.zeros(0, np.uint32)
    code = raw[:-2] | (raw[1:-1] << np.uint32(8)) | (raw[2:] << np.uint32(16))
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(16)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket, language: log of probability

    def scores(self, text: str) -> np.ndarray:
        """Tempered log-likelihoods, the best 0."""
        at = trigrams(text)
        if not len(at):
            return np.zeros(len(self.languages))
        counts = np.bincount(at, minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        total = counts[seen] @ self.weights[seen]
        return np.maximum((total - total.max()) * TEMPER, -BOUND)


def turns(pairs: Iterable[tuple[str, int]], rows: int) -> list[tuple[str, int]]:
    """The first ``rows`` different pairs of a language and a hash, where languages take turns from their least hash up.

    Of parts of a whole, the turns of their turns are those of the whole.
    """
    by: defaultdict[str, set[int]] = defaultdict(set)
    for language, h in pairs:
        by[language].add(h)
    ranked = sorted((i, h, language) for language, hs in by.items() for i, h in enumerate(nsmallest(rows, hs)))
    return [(language, h) for _, h, language in ranked[:rows]]


def fit(labelled: DataFrame, text: str, lang: str, rows: int = SAMPLE_ROWS) -> Model:
    """A model from ``rows`` different labelled rows at most, whatever their order and however often they are repeated.

    Languages take turns, so each is in it while there are no more than ``rows``. The hashes come first, by
    themselves, so that each task sends the driver ``rows`` numbers at most and not texts.
    """
    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("l"), F.xxhash64(lang, text).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, int]] = []
        for batch in batches:
            best = turns([*best, *zip(*(x.to_pylist() for x in batch.columns), strict=True)], rows)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in best], t) for i, t in enumerate((pa.string(), pa.int64()))], ["l", "h"])

    chosen = turns(((r.l, r.h) for r in known.select("l", "h").mapInArrow(run, "l string, h long").collect()), rows)
    least = labelled.sparkSession.createDataFrame([(h,) for _, h in chosen], "h long")
    sample = known.join(F.broadcast(least), "h").dropDuplicates(["h"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, name in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                place, n = np.unique(trigrams(t.as_py()), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(place), pa.string()), pa.array(place.astype(np.int32)), pa.array(n.astype(np.int64))], ["l", "place", "n"])

    summed = sample.select("t", "l").mapInArrow(count, "l string, place int, n long").groupBy("l", "place").agg(F.sum("n").alias("n"))
    languages = sorted({language for language, _ in chosen})
    counts = np.full((BUCKETS, max(1, len(languages))), 0.5)
    for r in summed.groupBy("l").agg(F.collect_list("place").alias("places"), F.collect_list("n").alias("ns")).collect():  # BUCKETS pairs a language at most
        counts[r.places, languages.index(r.l)] += r.ns
    return Model(languages or ["und"], np.log(counts / counts.sum(axis=0)).astype(np.float64))


def evidence(df: DataFrame, model: Model, html: str, url: str) -> DataFrame:
    """The columns but the page, with ``declared``, ``host``, ``domain``, ``suffix`` and ``scores``."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # 0.5 MB a language, bounded by the sample's languages
    kept = [x for x in df.columns if x != html and x not in SIGNS]
    rows = df.select(*kept, html)
    schema = rows.select(*kept).schema.add("declared", "string")
    schema = schema.add("__scores", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, scores = [], []
            for x in batch.column(len(kept)):
                page = x.as_py()
                said.append(declared(page))
                scores.append(sent.value.scores(plain(page)).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(said, pa.string()), pa.array(scores, pa.list_(pa.float64()))], schema.fieldNames())

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return (
        rows.mapInArrow(run, schema)
        .withColumn("__host", host)
        .withColumn("__domain", F.regexp_extract("__host", r"([^.]+\.[^.]+)$", 1))
        .withColumn("__suffix", F.regexp_extract("__host", r"([^.]+)$", 1))
    )


def shares(weights: Column) -> Column:
    """Logs to probabilities."""
    return F.transform(F.array(F.transform(weights, lambda x: F.exp(x - F.array_max(weights)))), lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, y: s + y)))[0]


def summed(column: str, n: int, name: str) -> Column:
    return F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(n)]).alias(name)


def smoothed(counts: Column, own: Column, parent: Column) -> Column:
    """The shares in the counts without the row's own part, drawn towards the parent's."""
    rest = F.zip_with(counts, own, lambda c, o: F.greatest(c - o, F.lit(0.0)))
    total = F.aggregate(rest, F.lit(0.0), lambda s, x: s + x)
    return F.zip_with(rest, parent, lambda c, p: (c + F.lit(WEIGHT) * p) / (total + F.lit(WEIGHT)))


def identify(pages: DataFrame, model: Model, *, html: str = "html", url: str = "url") -> DataFrame:
    """Adds ``lang``, its ``probability``, what the page ``declared`` and ``text_lang``, the likeliest by text alone.

    Pages are read once; what is counted and judged is the written evidence. Counts are added up before the
    shuffle, so a host with a third of all pages is one row per task there, and is dealt over tasks where pages meet
    their counts.
    """
    n = len(model.languages)
    languages = F.array(*map(F.lit, model.languages))
    seen = saved(evidence(pages, model, html, url).withColumn("__soft", shares(F.col("__scores"))), "evidence")

    hosts = saved(seen.groupBy("__host", "__domain", "__suffix").agg(summed("__soft", n, "__h")), "hosts")
    domains = hosts.groupBy("__domain", "__suffix").agg(summed("__h", n, "__d"))
    suffixes = domains.groupBy("__suffix").agg(summed("__d", n, "__s"))
    whole = suffixes.agg(summed("__s", n, "__all")).scalar()
    levels = lookup(lookup(hosts, domains, ["__domain", "__suffix"]), suffixes, ["__suffix"], counted=hosts).select("__host", "__h", "__d", "__s", whole.alias("__all"))
    said = seen.groupBy("declared").agg(summed("__soft", n, "__by"))

    # hosts and declarations are unbounded, and one may have a third of all pages
    joined = lookup(lookup(seen, levels, ["__host"]), said, ["declared"], counted=seen)
    even = F.array_repeat(F.lit(1.0 / n), n)
    prior = joined.withColumn("__p0", smoothed(F.col("__all"), F.col("__soft"), even))
    for counts, name, parent in (("__s", "__p1", "__p0"), ("__d", "__p2", "__p1"), ("__h", "__p3", "__p2")):
        prior = prior.withColumn(name, smoothed(F.col(counts), F.col("__soft"), F.col(parent)))
    # the chance of this declaration under a language, up to a factor: its share here over its share in all
    speaks = prior.withColumn("__q", smoothed(F.col("__by"), F.col("__soft"), F.col("__p0")))
    logs = F.zip_with(F.zip_with("__scores", "__p3", lambda s, p: s + F.log(p)), F.zip_with("__q", "__p0", lambda q, p: F.log(q) - F.log(p)), lambda a, b: a + b)
    fused = speaks.withColumn("__post", logs).withColumn("__post", shares(F.col("__post")))

    def best(column: str) -> Column:
        return F.element_at(languages, F.array_position(column, F.array_max(column)).cast("int"))

    kept = [x for x in pages.columns if x != html and x not in SIGNS]
    return fused.select(*kept, best("__post").alias("lang"), F.array_max("__post").alias("probability"), "declared", best("__scores").alias("text_lang"))
