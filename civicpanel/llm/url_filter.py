"""URL verdicts by host rules and by association rules mined from labelled URLs.

Explicit rules come first: a rule fits its host and all subdomains where the path starts
with the rule's path, the longest one wins. Where none fits, mined rules decide. A URL is a
set of tokens (scheme, top domain, host words, path words, file type, query keys); Spark's
FP-growth mines the combinations of tokens that labelled URLs share, and those that lead to
"block" with enough support and confidence are kept. They are matched by an inverted index:
each mined rule is listed under the rarest of its tokens, so the tokens that most URLs have
lead nowhere, and only distinct token sets are looked up.

A NULL URL, or one without "://", has an empty host and path and no tokens; no rule fits it
and it is allowed. Every row gets a row, repeated ids and URLs too. Without labels nothing is
mined and URLs without an explicit rule are allowed.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A combination must be in this share of the labelled URLs, and in so many of them.
LEAST_SUPPORT, LEAST_URLS = 0.002, 10
LEAST_CONFIDENCE = 0.7
#: Tokens of a mined rule at most.
LONGEST_RULE = 3
BLOCK, ALLOW = "=block", "=allow"


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rest_of(url: Column) -> Column:
    """What follows the first "://"; empty without one."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest_of(url), r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1)


def fitting(host: Column, path: Column, rules: list[HostRule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; NULL where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL, sorted."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(rest_of(url), r"\?([^#]*)", 1)
    marked = lambda mark, found: F.transform(found, lambda x: F.concat(F.lit(mark), x))
    named = lambda column, pattern: F.regexp_extract_all(F.lower(column), F.lit(pattern), 0)
    every = F.concat(
        marked("scheme:", named(F.regexp_extract(url, r"^([A-Za-z]+)://", 1), r"[a-z]+")),
        marked("top:", named(host, r"[^.]+$")),
        marked("host:", named(F.regexp_replace(host, r"\.?[^.]+$", ""), r"[\p{L}\p{N}]+")),
        marked("path:", named(F.regexp_replace(path, r"\.\w+$", ""), r"[\p{L}]+")),
        marked("type:", named(path, r"\.\w+$")),
        marked("query:", named(F.regexp_replace(query, r"=[^&]*", ""), r"[^&]+")),
    )
    return F.sort_array(F.array_distinct(F.coalesce(every, F.array().cast("array<string>"))))


def mined_rules(labelled: DataFrame, support: float = LEAST_SUPPORT, confidence: float = LEAST_CONFIDENCE) -> DataFrame | None:
    """(token, antecedent, confidence): what leads to "block" in ``labelled`` (url, blocked).

    ``token`` is the rarest token of the antecedent. None if there is nothing to learn from.
    """
    label = F.when(F.col("blocked"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    sets = labelled.dropna().select(F.array_append(tokens(F.col("url")), label).alias("items"))
    n = sets.count()
    if not n:
        return None
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(support, LEAST_URLS / n)), minConfidence=confidence).fit(sets)
    rules = model.associationRules.where(
        (F.col("consequent") == F.array(F.lit(BLOCK)))
        & (F.size("antecedent") <= LONGEST_RULE)
        & ~F.array_contains("antecedent", ALLOW)
    ).select("antecedent", "confidence")
    rarity = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    each = rules.withColumn("token", F.explode("antecedent")).join(rarity, "token")
    return each.groupBy("antecedent", "confidence").agg(F.min_by("token", F.struct("freq", "token")).alias("token"))


def blocked_sets(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Those of the distinct token sets (``items``) that hold all tokens of a mined rule."""
    held = lambda a: F.array_contains("items", a)
    return (
        sets.withColumn("token", F.explode("items"))
        .join(rules, "token")
        .where(F.forall("antecedent", held))
        .groupBy("items")
        .agg(F.max("confidence").alias("confidence"))
    )


def judge(pages: DataFrame, rules: list[HostRule], labelled: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    url = F.col("url").cast("string")
    urls = pages.select("page_id", url.alias("url"))
    name, verdict = fitting(F.col("host"), F.col("path"), rules)
    split = urls.select(
        "page_id", F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"),
        tokens(F.col("url")).alias("items"),
    )
    mined = mined_rules(labelled)
    if mined is None:
        found = split.withColumn("confidence", F.lit(None).cast("double"))
    else:
        found = split.join(blocked_sets(split.select("items").distinct(), mined), "items", "left")
    method = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
