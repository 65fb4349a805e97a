"""URL filtering by fixed host and path rules, and by association rules mined from labelled URLs.

A URL's tokens are its host's labels by place, the words of its path and the keys of its query.
FP-growth mines which combinations go with a label; rules are kept when they fit ``MIN_COUNT`` blocked
URLs, whatever the number of labels, are confident, beat the part of all labelled URLs that is blocked,
and no more general rule is as confident. They are matched through an inverted index from
token to rule, once for each distinct set of tokens. A fixed rule, where one fits, decides before
the mined ones; the mined rule with the highest confidence decides next; else a URL is allowed.

Everything is DataFrame functions and the library's FP-growth. Defined results: a null URL, or one
without ``://``, has an empty host and path, no token and no rule, and is allowed; repeated rows
get the same result; no labels give no mined rules; a token that every labelled URL holds tells
nothing and is in no rule, unless all are blocked. Other columns are passed over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.session import fresh_folder

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Blocked URLs that a rule fits at least; a number, so that it does not grow with the table.
MIN_COUNT = 5
MIN_CONFIDENCE = 0.6
BLOCK = "verdict:block"


@dataclass(frozen=True)
class Rule:
    """Fits a host with all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    at = F.locate("://", whole)
    rest = F.when(at > 0, F.substr(whole, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), CAPITALS, CAPITALS.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens; numbers say nothing about the next URL and are left out."""
    labels = F.transform(
        F.reverse(F.split(host, r"\.")), lambda x, k: F.concat(F.lit("host"), k.cast("string"), F.lit(":"), x)
    )
    word = F.translate(path, CAPITALS, CAPITALS.lower())
    parts = F.transform(
        F.filter(F.split(word, r"[/._-]+"), lambda x: x.rlike("[^0-9]")), lambda x: F.concat(F.lit("path:"), x)
    )
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(query, "&"), lambda x: x != ""),
        lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)),
    )
    found = F.sort_array(F.array_distinct(F.concat(labels, parts, keys)))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(found)


def fixed_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """Struct of size, rule and verdict of the longest rule that fits, else null."""
    fits = []
    for r in rules:
        inside = (host == r.host) | F.endswith(host, F.lit(f".{r.host}"))
        found = F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        fits.append(F.when(inside & F.startswith(path, F.lit(r.path)), found))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def mine(
    labelled: DataFrame, support: float | None = None, confidence: float = MIN_CONFIDENCE, count: int = MIN_COUNT
) -> DataFrame:
    """rule, tokens, confidence: what FP-growth finds in ``labelled`` (tokens, blocked).

    A rule fits at least ``count`` blocked URLs, or the fraction ``support`` of all where that is given.
    It is dropped when it is no more confident than the base rate or than one with fewer of its tokens.
    """
    spark = labelled.sparkSession
    path = fresh_folder(spark, "url-transactions")
    given = labelled.where("size(tokens) > 0").select("tokens", "blocked")
    given.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    given = spark.read.parquet(path)
    alike = _alike(given)
    alike.write.parquet(f"{path}-alike")
    alike = spark.read.parquet(f"{path}-alike")
    leading = given.select("row", F.explode("tokens").alias("token")).join(alike.select(F.explode("members").alias("token"), "leader"), "token")
    leaders = leading.groupBy("row").agg(F.collect_set("leader").alias("tokens"))
    marked = leaders.join(given.select("row", "blocked"), "row").select(
        F.when(F.col("blocked"), F.array_append("tokens", F.lit(BLOCK))).otherwise(F.col("tokens")).alias("items")
    )
    marked.write.parquet(f"{path}-leaders")
    marked = spark.read.parquet(f"{path}-leaders")
    empty = "rule long, tokens array<string>, confidence double"
    total = marked.count()
    if support is None and total < count or not total:
        return spark.createDataFrame([], empty)
    if support is None:
        support = (count - 0.5) / total  # FP-growth rounds up
    # Tokens of every URL double the sets that FP-growth finds and change no confidence.
    seen = marked.select(F.explode("items").alias("item")).groupBy("item").count().where(F.col("count") == total)
    general = [r["item"] for r in seen.collect()]
    if general and BLOCK not in general:
        marked = marked.select(F.array_except("items", F.array(*map(F.lit, general))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(marked)
    better = F.array_contains("consequent", BLOCK) & ((F.col("lift") > 1) | (F.col("confidence") == 1))
    found = model.associationRules.where(better).select(
        F.sort_array("antecedent").alias("tokens"), "confidence"
    )
    path = fresh_folder(spark, "url-rules")
    found.withColumn("rule", F.xxhash64("tokens")).write.parquet(path)
    rules = spark.read.parquet(path)
    # Through the inverted index: a rule whose tokens are all in another rule's is more general.
    index = _index(rules)
    inside = (
        rules.select(F.col("rule").alias("of"), F.size("tokens").alias("n"), F.col("confidence").alias("c"), F.explode("tokens").alias("token"))
        .join(index, "token")
        .where("size < n and confidence >= c")
        .groupBy("of", "rule", "size")
        .count()
        .where("count = size")
        .select(F.col("of").alias("rule"))
        .distinct()
    )
    return _spelled(rules.join(inside, "rule", "left_anti"), alike)


def _alike(given: DataFrame) -> DataFrame:
    """leader and members: tokens that the same labelled URLs hold, under the first of them.

    FP-growth finds every set of tokens that go together, two to the power of their number; tokens that
    always go together tell as much as one of them. They are known by two hashes over the rows that hold
    them, and by their count. There are at most as many in a group as tokens in a URL.
    """
    held = given.select("row", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count("*").alias("count"), *[F.bit_xor(F.xxhash64("row", F.lit(k))).alias(f"rows_{k}") for k in (0, 1)]
    )
    groups = held.groupBy("count", "rows_0", "rows_1").agg(F.sort_array(F.collect_list("token")).alias("members"))
    return groups.select(F.col("members")[0].alias("leader"), "members")


def _spelled(rules: DataFrame, alike: DataFrame) -> DataFrame:
    """Each rule over leaders once for every choice of members in their place."""
    members = (
        rules.select("rule", "confidence", F.explode("tokens").alias("leader"))
        .join(alike, "leader")
        .groupBy("rule", "confidence")
        .agg(F.collect_list("members").alias("choices"))
    )
    nothing = F.array(F.array().cast("array<string>"))
    each = F.reduce(
        "choices",
        nothing,
        lambda made, choice: F.flatten(F.transform(made, lambda x: F.transform(choice, lambda y: F.array_append(x, y)))),
    )
    made = members.select(F.explode(each).alias("tokens"), "confidence")
    made = made.select(F.sort_array("tokens").alias("tokens"), "confidence")
    return made.select(F.xxhash64("tokens").alias("rule"), "tokens", "confidence")


def _index(rules: DataFrame) -> DataFrame:
    """The inverted index: a row for each token of each rule."""
    return rules.select(F.explode("tokens").alias("token"), "rule", F.size("tokens").alias("size"), "confidence")


def matches(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """set, confidence, mined: for each set of tokens that holds a rule, the most confident one."""
    found = (
        sets.select("set", F.explode("tokens").alias("token"))
        .join(_index(rules), "token")
        .groupBy("set", "rule", "size", "confidence")
        .count()
        .where("count = size")
    )
    best = F.max(F.struct("confidence", "rule")).alias("best")
    return found.groupBy("set").agg(best).select("set", "best.confidence", F.col("best.rule").alias("mined"))


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    rules: list[Rule],
    page_id: str = "page_id",
    url: str = "url",
    support: float | None = None,
    confidence: float = MIN_CONFIDENCE,
    count: int = MIN_COUNT,
) -> DataFrame:
    """page_id, host, path, rule, verdict, and the confidence of the mined rule that fits.

    ``labelled`` has ``url`` and ``blocked``.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    parsed = labelled.select("url", "blocked", host.alias("host"), path.alias("path"))
    learned = mine(
        parsed.select(tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), "blocked"),
        support,
        confidence,
        count,
    )
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).select(
        "page_id", "url", host.alias("host"), path.alias("path")
    )
    marked = parsed.select(
        "page_id", "host", "path", tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")
    ).withColumn("set", F.xxhash64("tokens"))
    folder = fresh_folder(spark, "url-sets")
    marked.write.parquet(folder)
    marked = spark.read.parquet(folder)
    sets = marked.groupBy("set").agg(F.first("tokens").alias("tokens"))
    found = marked.drop("tokens").join(matches(sets, learned), "set", "left")
    fixed = fixed_rule(rules, F.col("host"), F.col("path"))
    blocked = F.when(F.col("confidence") >= confidence, "block").otherwise("allow")
    return found.withColumn("fixed", fixed).select(
        "page_id",
        "host",
        "path",
        "fixed.rule",
        F.coalesce("fixed.verdict", blocked).alias("verdict"),
        F.col("confidence"),
    )
