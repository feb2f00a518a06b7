"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation weighs the votes.

Every rule looks at one aspect of a text and votes good, bad or not at all. The rows are counted by pattern
of votes; there are 3 to the number of rules patterns at most, whatever the number of rows, and only these
counts leave the executors. On them, a model with a class (good or bad) and, for each rule and class, the
chances of its votes is fitted by expectation-maximisation; so each rule's accuracy is estimated from
how it agrees with the others, over all rows. A row is kept if it is good with a probability of a half or more.

Base rules come on top: fewer than ``min_words`` words, or more than half the words in repeated three-word
windows, and the row fails. The model is fitted on the rows that pass these, so that what fails anyway does not
take its bad class.

Nulls: a null text has no words and fails. Repeated rows are judged alike. An empty table gives an empty table.
Other columns pass; those that are added replace any of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.scratch import saved

SPACE = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
ROUNDS = 60

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
AUX = ("n_lines", "n_upper", "n_shouts", "n_ends")

BAD, NONE, GOOD = 0, 1, 2

#: The chance of good before any vote. It is given and not fitted: where few rules vote bad, a fitted one would
#: drift to all good. And what a rule is expected to do on bad and on good rows, its chance to vote bad, with the
#: weight of one row.
BALANCE, EXPECTED = 0.8, (0.3, 0.01)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+", -1)).otherwise(F.array().cast("array<string>"))


def windows_of(words: Column) -> Column:
    """The three-word windows as structs of a 64-bit hash of their words and their place, sorted."""
    places = F.sequence(F.lit(0), F.size(words) - 3)
    made = F.transform(places, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.when(F.size(words) >= 4, F.sort_array(made))


def covered(ranked: Column) -> Column:
    """Words inside windows that occur twice or more: equal neighbours in the sorted windows are repeats.

    ``ranked`` must be a plain column; an expression would be worked out anew for each element.
    """
    twice = F.filter(ranked, lambda x, j: (F.get(ranked, j - 1)["h"] == x["h"]) | (F.get(ranked, j + 1)["h"] == x["h"]))
    words = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return F.coalesce(F.size(words), F.lit(0))


def kept_chars(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, ""))


def features(df: DataFrame, text: str) -> DataFrame:
    """Adds the columns BASE and AUX, all BIGINT, over whole texts."""
    whole = F.coalesce(F.col(text), F.lit(""))
    first = df.withColumn("__text", whole).withColumn("__words", words_of(F.col("__text"))).withColumn("__lines", F.filter(F.split(F.col("__text"), "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")).withColumn("__windows", windows_of(F.col("__words")))
    counts = {
        "n_words": F.size("__words"),
        "word_chars": F.length(F.array_join("__words", "")),
        "n_symbols": kept_chars(F.col("__text"), r"[^#*$%&|<>]+"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": covered(F.col("__windows")),
        "n_lines": F.size("__lines"),
        "n_upper": kept_chars(F.col("__text"), r"[^\p{Lu}]+"),
        "n_shouts": kept_chars(F.col("__text"), r"[^!]+"),
        "n_ends": F.size(F.filter("__lines", lambda x: F.rtrim(x).rlike(r"[.!?:;\"')\]…»”。]\z"))),
    }
    return first.withColumns({k: v.cast("bigint") for k, v in counts.items()}).drop("__text", "__words", "__lines", "__windows")


def share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def vote(bad: Column, good: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(NONE)


def votes() -> dict[str, Column]:
    """The rules, by name, over the columns of ``features``."""
    mean = share("word_chars", "n_words")
    return {
        "length": vote(F.col("n_words") < 5, F.col("n_words") >= 100),
        "symbols": vote(share("n_symbols", "n_words") > 0.2, share("n_symbols", "n_words") < 0.03),
        "same_lines": vote(share("n_dup_lines", "n_lines") > 0.3, (F.col("n_lines") >= 4) & (F.col("n_dup_lines") == 0)),
        "repeats": vote(share("n_repeat_words", "n_words") > 0.35, (F.col("n_words") >= 50) & (share("n_repeat_words", "n_words") < 0.2)),
        "word_length": vote((mean < 2) | (mean > 15), (mean >= 3) & (mean <= 10)),
        "upper": vote(share("n_upper", "word_chars") > 0.4, share("n_upper", "word_chars") < 0.1),
        "shouts": vote(share("n_shouts", "n_words") > 0.2, share("n_shouts", "n_words") < 0.02),
        "endings": vote((F.col("n_lines") >= 4) & (share("n_ends", "n_lines") < 0.1), share("n_ends", "n_lines") > 0.6),
    }


def pattern(rules: dict[str, Column]) -> Column:
    """The votes as one number in base three, the first rule's lowest."""
    total = F.lit(0)
    for i, x in enumerate(rules.values()):
        total = total + x * F.lit(3**i)
    return total.cast("int")


def fit(counts: dict[int, int], n_rules: int, rounds: int = ROUNDS) -> dict[int, float]:
    """Pattern -> probability of good, fitted on the counts of patterns.

    It begins from: bad where any rule votes bad. That a rule abstains is no evidence, and no rule's bad vote
    counts for good: where it would be likelier in good rows than in bad ones, the rule is left out.
    """
    ballots = {p: [p // 3**i % 3 for i in range(n_rules)] for p in sorted(counts)}
    good = {p: 0.02 if BAD in v else 0.98 for p, v in ballots.items()}
    for _ in range(rounds):
        chance = [[[x, 0.0, 1 - x] for _ in range(n_rules)] for x in EXPECTED]
        for p, v in ballots.items():
            for y, w in ((0, counts[p] * (1 - good[p])), (1, counts[p] * good[p])):
                for j, x in enumerate(v):
                    chance[y][j][x] += w
        for j in range(n_rules):
            for y in (0, 1):
                bad = chance[y][j][BAD] / (chance[y][j][BAD] + chance[y][j][GOOD])
                chance[y][j] = [bad, 1.0, 1 - bad]  # abstaining is no evidence
            if chance[1][j][BAD] > chance[0][j][BAD]:
                chance[0][j] = chance[1][j] = [(a + b) / 2 for a, b in zip(chance[0][j], chance[1][j], strict=True)]
        prior = math.log(BALANCE / (1 - BALANCE))
        for p, v in ballots.items():
            odds = prior + sum(math.log(chance[1][j][x] / chance[0][j][x]) for j, x in enumerate(v))
            good[p] = 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))
    return good


def lookup(spark: SparkSession, good: dict[int, float]) -> DataFrame:
    """The fitted probabilities as ``(vote_pattern, quality)``; a row for each pattern that occurs."""
    pairs = F.explode(F.split(F.lit(";".join(f"{p},{g!r}" for p, g in good.items())), ";")).alias("pair")
    cut = spark.range(1).select(pairs).where("pair != ''").select(F.split("pair", ",").alias("x"))
    return cut.select(F.get("x", F.lit(0)).cast("int").alias("vote_pattern"), F.get("x", F.lit(1)).cast("double").alias("quality"))


def judge(df: DataFrame, text: str = "text", *, min_words: int = MIN_WORDS, threshold: float = 0.5, rounds: int = ROUNDS, keep_text: bool = True) -> DataFrame:
    """Adds BASE, ``base_failed``, ``quality DOUBLE`` (the probability of good) and ``kept``.

    The features are computed once and written; the counts of patterns and the verdicts are read from there.
    ``keep_text=False`` leaves the text behind, for callers that want the verdicts only.
    """
    made = (*BASE, *AUX, "base_failed", "quality", "kept", "vote_pattern")
    kept = [x for x in df.columns if x not in made and (keep_text or x != text)]
    rules = votes()
    judged = features(df.select(*kept, *[text][keep_text:]), text).withColumn("vote_pattern", pattern(rules)).select(*kept, *BASE, "vote_pattern")
    table = saved(judged, "quality")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    counts = {r.vote_pattern: r.n for r in table.where(~failed).groupBy("vote_pattern").agg(F.count("*").alias("n")).collect()}  # 3**len(rules) rows at most
    good = fit(counts, len(rules), rounds)
    verdicts = F.broadcast(lookup(df.sparkSession, good))
    out = table.withColumn("base_failed", failed).join(verdicts, "vote_pattern", "left")
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("quality", F.lit(0.0)) >= threshold)).drop("vote_pattern")
