"""URL parts and rules against plain Python; mined rules against counting."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from civicpanel.llm import queries, url_filter as uf


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    stop = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in rest[:end]), path[:stop]


def rule_for(host, path):
    fits = [r for r in queries.HOST_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


URLS = [
    None, "", "no scheme", "http://", "HTTP://Example.NET/en/a?b#c", "https://a.example.net/enx", "x://y.net", "x://y.net/",
    "https://example.com/de/1", "https://notexample.com/de/1", "https://x.fr.org/fr/", "https://org/fr/x", "a://b://c/d",
    "http://ÄB.org/fr/é?x=1&y=2", "http://net/", "http://h.com#f/x", "http://h.com?q=/de/", "http://w.example.net/en", "h://a/b/" + "c/" * 20_000,
]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS[-1:])], "page_id long, url string")
    pages = pages.withColumns({"host": F.lit(1), "items": F.lit(2), "rule": F.lit("r"), "token": F.lit("t")})
    found = uf.judge(pages, queries.HOST_RULES, spark.createDataFrame([], "url string, blocked boolean")).collect()
    assert len(found) == len(URLS) + 1
    for r in found:
        host, path = parts((URLS + URLS[-1:])[r.page_id])
        rule = rule_for(host, path)
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == ((rule.name, rule.verdict) if rule else (None, "allow"))


def test_mined_rules_equal_counting(spark):
    urls = [(f"https://{h}.example.com/{p}/{i}", h == "free-bets" and p == "en") for i in range(40) for h in ("free-bets", "good", "bad-bets") for p in ("en", "de")]
    labelled = spark.createDataFrame([*urls, (None, True)], "url string, blocked boolean")
    rules = uf.mined_rules(labelled).collect()
    sets = [(frozenset(r[0]), r[1]) for r in labelled.dropna().select(uf.tokens(F.col("url")), "blocked").collect()]
    expected = set()
    for antecedent in {frozenset(c) for s, _ in set(sets) for n in range(1, 4) for c in combinations(s, n)}:
        hits = [b for s, b in sets if antecedent <= s]
        if sum(hits) >= 10 and sum(hits) / len(hits) >= uf.LEAST_CONFIDENCE:
            expected.add((antecedent, round(sum(hits) / len(hits), 9)))
    assert {(frozenset(r.antecedent), round(r.confidence, 9)) for r in rules} == expected and expected
    pages = labelled.withColumn("page_id", F.lit(1))
    verdicts = {r.path.split("/")[1] + r.host: r.verdict for r in uf.judge(pages, [], labelled).collect() if r.host}
    assert {k for k, v in verdicts.items() if v == "block"} == {"enfree-bets.example.com"}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1"])
def test_query(spark, folder):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()}
    found = queries.op5_url_filter(spark, folder).collect()
    assert len(found) == len(pages)
    free = []
    for r in found:
        assert (r.host, r.path) == parts(pages[r.page_id])
        rule = rule_for(r.host, r.path)
        assert r.rule == (rule.name if rule else None)
        if rule:
            assert r.verdict == rule.verdict
        else:
            free.append((any(w in r.host for w in ("casino", "pills", "bets")), r.verdict))
    assert {v for spam, v in free if spam} == {"block"}
    assert sum(v == "block" for spam, v in free if not spam) < 0.02 * len(free)


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge(none, queries.HOST_RULES, spark.createDataFrame([("http://a.b/c", True)], "url string, blocked boolean")).collect() == []
