"""URL filters: pattern rules behind an index of their rarest literal tokens.

A rule is a regular expression over ``host + path`` together with the literal tokens that any URL it fits must have.
It is filed under the token that is rarest in the given URLs. A URL looks up its tokens, and only the rules that it
finds there run their expression on it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.llm.common import free_name, lookup, settle, with_results

TOKEN = "[0-9A-Za-z]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs on host + path; ``name`` is what a result shows; a longer name wins over a shorter one."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]


def host_path(name: str, verdict: str) -> Rule:
    """A rule like ``example.net/en/``: the host and all its subdomains, where the path starts like the rule's."""
    host, slash, path = name.partition("/")
    host = host.translate(str.maketrans(UPPER, LOWER))
    *whole, last = re.split("/", path)
    tokens = re.findall(TOKEN, host)
    for segment in whole:  # the last piece may go on in a URL, so its last token isn't literal
        tokens += re.findall(TOKEN, segment)
    tokens += re.findall(TOKEN + "(?=[^0-9A-Za-z])", last)
    pattern = r"^([^/]*\.)?" + _quoted(host) + (_quoted(slash + path) if slash else "(/|$)")
    return Rule(name, verdict, pattern, tuple(dict.fromkeys(tokens)))


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/_" else "\\" + c if c.isascii() else c for c in text)


#: The rules of the query, fixed by its contract.
RULES = (
    host_path("net/", "block"),
    host_path("example.net/en/", "allow"),
    host_path("example.com/de/", "block"),
    host_path("org/fr/", "allow"),
)


def split_url(pages: DataFrame, url_col: str) -> DataFrame:
    """Add host and path; both are empty without a ``://``."""
    rest = F.regexp_extract(F.coalesce(F.col(f"`{url_col}`"), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return with_results(pages, {"host": host, "path": path})


def rarest(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The index: one row per rule with its rarest token (null for a rule without one) and its expression.

    ``urls`` has a column tokens. Tokens of rules are counted over all URLs.
    """
    spark = urls.sparkSession
    table = spark.createDataFrame(
        [(i, r.name, r.verdict, r.pattern, list(r.tokens)) for i, r in enumerate(rules)],
        "number int, rule string, verdict string, pattern string, literals array<string>",
    )
    each = table.select("*", F.explode_outer("literals").alias("token")).drop("literals")
    wanted = each.select("token").filter(F.col("token").isNotNull()).distinct()
    seen = lookup(urls.select(F.explode("tokens").alias("token")), wanted, ["token"], "left_semi", rows=len(rules) * 8)
    seen = seen.groupBy("token").agg(F.count(F.lit(1)).alias("urls")).withColumnRenamed("token", "seen_token")
    counted = each.join(seen, F.col("token") == F.col("seen_token"), "left")
    best = F.min_by(F.struct("token", "rule", "verdict", "pattern"), F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token"))
    return counted.groupBy("number").agg(best.alias("r")).select("number", "r.*")


def filter_urls(
    pages: DataFrame, url_col: str = "url", rules: Sequence[Rule] = RULES, *, default: str = "allow"
) -> DataFrame:
    """Add host, path, rule and verdict to pages; without a rule that fits, rule is null and verdict the default.

    Of several rules that fit, the one with the longest name wins (then the smallest name). A null URL, and one
    without ``://``, has an empty host and path. Rows may repeat; columns with the names of results are replaced. An
    empty table gives an empty result, and an empty list of rules the default for all.
    """
    split = split_url(pages, url_col)
    if not rules:
        return with_results(split, {"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    place = F.concat("host", "path")
    tokens = F.array_distinct(F.regexp_extract_all("place", F.lit(f"({TOKEN})"), 1))
    # equal places are judged once, however many pages have them
    places, _ = settle(split.select(place.alias("place")).distinct().select("place", tokens.alias("tokens")))
    index, _ = settle(rarest(places, rules))
    rows = index.count()
    found = places.select("place", F.explode(F.array_append("tokens", F.lit(""))).alias("token"))
    filed = index.withColumn("token", F.coalesce("token", F.lit("")))  # a rule without a literal meets every URL
    found = _candidates(found, filed, rows).filter(F.expr("rlike(place, pattern)"))
    order = F.struct(F.length("rule").alias("length"), F.expr("-number").alias("number"))
    best = found.groupBy("place").agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    key, hit = free_name(split, "place"), free_name(split, "best")
    judged = split.withColumn(key, place).join(best.select(F.col("place").alias(key), F.col("best").alias(hit)), key, "left")
    results = {"rule": F.col(f"{hit}.rule"), "verdict": F.coalesce(F.col(f"{hit}.verdict"), F.lit(default))}
    return with_results(judged, results).drop(key, hit)


def _candidates(found: DataFrame, filed: DataFrame, rows: int) -> DataFrame:
    """URLs and the rules filed under their tokens. A token may have several rules: they travel as one list."""
    rules = F.collect_list(F.struct("number", "rule", "verdict", "pattern")).alias("rules")
    lists = filed.groupBy("token").agg(rules)
    return lookup(found, lists, ["token"], "inner", rows).select("place", F.inline("rules"))
