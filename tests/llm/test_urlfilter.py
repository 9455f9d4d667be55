"""URL rules against trying every rule on every url."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lanewatch.llm.urlfilter import RULES, Rule, index, judge
from tests.llm.cases import LOWER, clashing

URLS = [None, "", "no scheme", "http://", "http:///en/x", "http://com/", "http://com", "HTTP://WWW.Example.COM/en/", "https://a.example.com/en/q?x=/no",
        "https://example.com/en", "https://example.com/EN/", "https://badexample.com/en/1", "https://x.net/es/#y", "https://net/fr/",
        "https://net.com/fr/", "a://b://c.com/d", "http://u:p@example.com:80/en/", "https://ÉX.com/ÀÉ/?q", "http://x.com\n/en/", "http://é.example.com/en/\n"]


def _plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
        host = rest.split("/", 1)[0]
        path = rest[len(host):]
        host = host.translate(LOWER)
    best = None
    for verdict, text in rules:
        h, slash, p = text.partition("/")
        if host and (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            if best is None or (len(text), len(h)) > (len(best[1]), len(best[1].partition("/")[0])):
                best = (verdict, text)
    return host, path, best and best[1], best[0] if best else "allow"


def _pages(spark, urls):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, html string").repartition(3)


def _check(got, urls, rules):
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {i: _plain(u, rules) for i, u in enumerate(urls)}


def test_rules_of_the_query(spark):
    _check(judge(clashing(_pages(spark, URLS + URLS[:8])), RULES).collect(), URLS + URLS[:8], RULES)


def test_many_rules_and_blocks(spark):
    rng = random.Random(2)
    parts = ["a", "bb", "ads", "track", "cdn", "x1"]
    rules = sorted({(rng.choice(["allow", "block"]),
                     ".".join(rng.choices(parts, k=rng.randint(1, 3))) + rng.choice(["", "/", "/ad", "/ads/", "/a/bb/", "/x1/tr"]))
                    for _ in range(60)})
    rules = list({t: (v, t) for v, t in rules}.values())
    urls = [f"http://{'.'.join(rng.choices(parts, k=rng.randint(1, 4)))}" + rng.choice(["", "/", "/ads", "/ads/q", "/a/bb/c", "/x1/track?y", "/adsense"])
            for _ in range(400)]
    for limit in (200_000, 7):
        got = judge(_pages(spark, urls), rules, max_rules=limit).collect()
        want = {i: _plain(u, rules) for i, u in enumerate(urls)}
        for r in got:
            host, path, rule, verdict = want[r.page_id]
            assert (r.host, r.path) == (host, path) and (r.rule is None) == (rule is None)
            if rule:
                assert len(r.rule) == len(rule) and len(r.rule.partition("/")[0]) == len(rule.partition("/")[0])
    assert sum(r.tried for r in judge(_pages(spark, urls), rules).collect()) < len(rules) * len(urls) / 2


def test_rarest_token_is_the_key():
    r = [Rule("ads.example.com/x/", "block"), Rule("example.com/", "allow"), Rule("/", "block"), Rule("com/adv", "block")]
    filed, rest = index(r, {"com": 100, "example": 50, "ads": 2, "x": 9})
    assert {k: [x.text for x in v] for k, v in filed.items()} == {
        "ads": ["ads.example.com/x/"], "example": ["example.com/"], "com": ["com/adv"]} and [x.text for x in rest] == ["/"]


def test_bad_verdict_and_empty(spark):
    with pytest.raises(ValueError):
        judge(_pages(spark, URLS), [("maybe", "com/")])
    assert judge(_pages(spark, URLS).limit(0), RULES).count() == 0
    assert judge(_pages(spark, URLS), []).filter(F.col("rule").isNotNull()).count() == 0
