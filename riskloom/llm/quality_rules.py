"""Quality rules that vote or abstain, and the posterior probability that a document is good.

Each rule looks at one property of a text and votes good (1), bad (-1) or abstains (0). How often
a rule is right on good and on bad documents is not known; expectation-maximisation estimates it
from how the rules agree, over the counts of vote patterns, of which there are at most 3 to the
number of rules. A document is kept when its posterior reaches ``THRESHOLD`` and it passes the
base filter. Everything is Spark SQL expressions; the words of a text stay in one row, so nothing
but the pattern counts is shuffled.

Repeated windows are found by 64-bit hashes. Defined results: a null text has no words and fails
the base filter; repeated rows get the same result; an empty table has no rows; other columns are
passed over.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.session import fresh_folder

#: Separators of words.
SPACES = " \t\n\x0b\f\r"
WINDOW = 3
MIN_WORDS = 50
THRESHOLD = 0.5
ROUNDS = 25
#: Where estimation starts: the share of good documents, and of right and wrong votes.
PRIOR_GOOD = 0.7
PRIOR_RIGHT, PRIOR_WRONG = 8.0, 2.0


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Computes a value once for all its uses within a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _covered(places: Column) -> Column:
    """Words in windows that begin at sorted places."""
    start = F.struct(F.lit(-WINDOW).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        places,
        start,
        lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(WINDOW).cast("long"), p - s["last"])).alias("n")),
        lambda s: s["n"],
    )


def _repeated(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more."""

    def places(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda x, k: F.coalesce(x["h"] == F.get(ordered, k - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(ordered, k + 1)["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    ordered = F.sort_array(F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.cast("long").alias("p"))))
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(some, _covered(_let(ordered, places))).otherwise(F.lit(0).cast("long"))


def _windows(words: Column) -> Column:
    """Hashes of all windows of ``WINDOW`` words."""
    n = F.size(words)
    of = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    places = F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0)))
    empty = F.array().cast("array<bigint>")
    return F.when(n >= WINDOW, F.transform(places, of)).otherwise(empty)


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the properties that the rules look at."""
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    counted = _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _let(_windows(w), _repeated).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.length(x) <= 3)).cast("long").alias("n_short_words"),
        ),
    )
    lined = _let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    out = docs.select(
        F.col(doc_id).alias("doc_id"),
        _count(body, "[#*$%&|<>]").alias("n_symbols"),
        _count(body, "[A-Z]").alias("n_capitals"),
        _count(body, "!").alias("n_shouts"),
        _count(body, r"[#*$%&|<>!=+~^_@\[\]{}\\/]").alias("n_marks"),
        counted.alias("counted"),
        lined.alias("lined"),
    )
    return out.select(
        "doc_id", "counted.n_words", "counted.word_chars", "n_symbols", "lined.n_dup_lines",
        "counted.n_repeat_words", "lined.n_lines", "counted.n_short_words", "n_capitals", "n_shouts", "n_marks",
    )


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("tinyint")


def rules() -> dict[str, Column]:
    """Rules by name. The bounds are parameters of the rules, not estimated."""
    words, mean = F.col("n_words"), _share("word_chars", "n_words")
    symbols, capitals = _share("n_symbols", "n_words"), _share("n_capitals", "word_chars")
    lines, repeats = _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words")
    short, shouts = _share("n_short_words", "n_words"), _share("n_shouts", "n_words")
    marks = _share("n_marks", "word_chars")
    return {
        "length": _vote((words >= 80) & (words <= 100_000), words < 30),
        "word_length": _vote((mean >= 3) & (mean <= 8), (mean < 2.5) | (mean > 12)),
        "symbols": _vote(symbols < 0.02, symbols > 0.1),
        "capitals": _vote(capitals < 0.12, capitals > 0.3),
        "dup_lines": _vote(lines < 0.1, lines > 0.3),
        "repeats": _vote(repeats < 0.1, repeats > 0.3),
        "short_words": _vote((short >= 0.15) & (short <= 0.6), short < 0.08),
        "shouts": _vote(shouts < 0.05, shouts > 0.2),
        "marks": _vote(marks < 0.03, marks > 0.1),
    }


Params = tuple[float, list[dict[str, list[float]]]]


def _weights(params: Params) -> Column:
    """The prior's log odds, then for each rule those of a bad vote, of none and of a good one."""
    prior, chances = params
    out = [math.log(prior / (1 - prior))]
    for chance in chances:
        out += [math.log(g / b) for g, b in zip(chance["good"], chance["bad"])]
    return F.array(*[F.lit(x) for x in out])


def _posterior(params: Params, votes: Column) -> Column:
    """Probability that a document is good, from its votes."""
    weights = _weights(params)
    odds = F.transform(votes, lambda v, k: F.get(weights, 3 * k + v + 2))
    return 1 / (1 + F.exp(-F.aggregate(odds, F.get(weights, F.lit(0)), lambda total, x: total + x)))


def estimate(patterns: DataFrame, rules: int, rounds: int = ROUNDS) -> Params:
    """The prior, and for each rule the chance of each vote on a good and on a bad document, by
    expectation-maximisation over counts ``n`` of the patterns ``votes``.

    It starts from rules that are mostly right, so that good stays good.
    """
    right = PRIOR_RIGHT / (PRIOR_RIGHT + PRIOR_WRONG)
    # An abstention says nothing at first.
    chances = [{"good": [(1 - right) / 2, 0.5, right / 2], "bad": [right / 2, 0.5, (1 - right) / 2]} for _ in range(rules)]
    params: Params = (PRIOR_GOOD, chances)
    for _ in range(rounds):
        weighed = patterns.select("n", "votes", _posterior(params, F.col("votes")).alias("p"))
        counted = weighed.select("n", "p", F.posexplode("votes").alias("rule", "vote")).groupBy("rule", "vote")
        found = counted.agg(F.sum(F.col("n") * F.col("p")), F.sum(F.col("n") * (1 - F.col("p")))).collect()
        if not found:
            return params
        chances = [{"good": [0.0] * 3, "bad": [0.0] * 3} for _ in range(rules)]
        for rule, vote, good, bad in found:
            chances[rule]["good"][vote + 1] = good
            chances[rule]["bad"][vote + 1] = bad
        good, bad = sum(chances[0]["good"]), sum(chances[0]["bad"])
        for chance in chances:
            for side, total, seen in (("good", good, (1, 2, 7)), ("bad", bad, (7, 2, 1))):
                chance[side] = [(x + y) / (total + sum(seen)) for x, y in zip(chance[side], seen)]
        before, params = params, (min(max(good / (good + bad), 0.01), 0.99), chances)
        if _moved(before, params) < 1e-4:
            break
    return params


def _moved(a: Params, b: Params) -> float:
    sides = [(x, y) for p, q in zip(a[1], b[1]) for s in p for x, y in zip(p[s], q[s])]
    return max(abs(x - y) for x, y in [(a[0], b[0]), *sides])


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base properties, base_failed, kept, the posterior ``quality`` and the votes."""
    spark = docs.sparkSession
    voters = rules()
    names = list(voters)
    path = fresh_folder(spark, "quality-votes")
    statistics(docs, doc_id, text).select("*", *[v.alias(k) for k, v in voters.items()]).write.parquet(path)
    voted = spark.read.parquet(path).withColumn("votes", F.array(*names))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # The verdict is asked for those that pass the base filter, so they are learned from.
    passed = voted.where(~failed).groupBy("votes").agg(F.count("*").alias("n"))
    path = fresh_folder(spark, "quality-patterns")
    passed.coalesce(1).write.parquet(path)
    params = estimate(spark.read.parquet(path), len(names))
    quality = _posterior(params, F.col("votes"))
    judged = voted.withColumn("quality", quality)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("quality") >= threshold)).alias("kept"),
        "quality", *names,
    )
