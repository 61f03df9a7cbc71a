import math
from collections import Counter

import pytest
from helpers import rows, same_as_sql

from kinloom.llm import url_filter
from kinloom.llm.queries import URL_RULES
from kinloom.llm.sql import ORACLE_SQL

SCHEMA = "page_id long, url string, html string, host string, verdict string"
URLS = ["http://A.Example.COM/en/1?x#y", "https://www.example.com/en/2", "http://com/", "ftp://x.net/es/3", "http://net/fr/", "http://x.org/de/1#top", "nothing", None, "", "://", "http://a.com?q", "http://www.x.net/en/9?p=1", "http://é.org/ü/日", "http://xcom/", "http://a.example.com/en", "http://a.b.net/es/" + "z" * 5000]


def frame(spark, urls, ids=None):
    ids = range(len(urls)) if ids is None else ids
    return spark.createDataFrame([(i, u, "h", "clash", "clash") for i, u in zip(ids, urls)], SCHEMA)


def judged(df):
    return url_filter.judge(df, URL_RULES)


def test_against_sql(spark):
    more = [f"http://site{i % 7}.{z}/{l}/{i}" for i in range(60) for z, l in (("com", "en"), ("net", "es"), ("net", "de"), ("org", "fr"))]
    df = frame(spark, URLS + more)
    same_as_sql(spark, judged(df), ORACLE_SQL["op8_url_filter"], pages=df)


def test_rules(spark):
    got = {r.page_id: (r.host, r.path, r.rule) for r in judged(frame(spark, URLS)).collect()}
    assert got[0] == ("a.example.com", "/en/1", "example.com/en/")
    assert got[1] == ("www.example.com", "/en/2", "www.example.com/en/")
    assert got[2] == ("com", "/", "com/")
    assert got[3] == ("x.net", "/es/3", "net/es/")
    assert got[4] == ("net", "/fr/", "net/fr/")
    assert got[6] == got[7] == got[8] == got[9] == ("", "", None)
    assert got[10] == ("a.com", "", None)
    assert got[13] == ("xcom", "/", None)
    assert got[14] == ("a.example.com", "/en", "com/")


def test_model_against_brute_force(spark):
    urls = [f"http://{h}.{z}/{p}" for h in ("abc", "bcd", "xyz") for z, p in (("com", "good"), ("net", "es/bad"), ("org", "good/1"), ("org", "es/bad"))]
    got = {r.host + r.path: r.verdict for r in judged(frame(spark, urls)).collect()}

    def parts(s):
        t = "\x02" * 4 + s + "\x03"
        return [t[i : i + 5] for i in range(len(t) - 4)]

    counts = {"allow": Counter(), "block": Counter()}
    texts = {u.split("//")[1] for u in urls}
    for s in texts:
        said = "allow" if ".com/" in s else "block" if ".net/es/" in s else None
        if said:
            for g in parts(s):
                for k in range(1, 6):
                    counts[said][g[5 - k :]] += 1
                    counts[said][("c", g[5 - k : 4], k)] += 1

    def ln(c, g):
        p = 1 / 256
        for k in range(1, 6):
            p = (c[g[5 - k :]] + p) / (c[("c", g[5 - k : 4], k)] + 1)
        return math.log(p)

    mean = {s: sum(ln(counts["allow"], g) - ln(counts["block"], g) for g in parts(s)) / (len(s) + 1) for s in texts}
    side = lambda f: [m for s, m in mean.items() if f(s)]
    a, b = side(lambda s: ".com/" in s), side(lambda s: ".net/es/" in s)
    line = (sum(a) / len(a) + sum(b) / len(b)) / 2
    for s, m in mean.items():
        if ".org/" in s:
            assert got[s] == ("allow" if m > line else "block")
    assert {got[s] for s in texts if ".org/" in s} == {"allow", "block"}


@pytest.mark.parametrize("urls, want", [([], []), (["http://x.org/"], ["allow"]), ([None, None], ["allow", "allow"])])
def test_without_training(spark, urls, want):
    assert [r.verdict for r in judged(frame(spark, urls, [None] * len(urls))).collect()] == want


def test_very_long_url(spark):
    out = judged(frame(spark, ["http://a.com/x", "http://b.net/es/1", "http://x.org/" + "long/" * 60000])).collect()
    assert {r.page_id: len(r.path) for r in out}[2] == 300001 and len(out) == 3


def test_repeated_rows_stay(spark):
    df = frame(spark, ["http://a.com/x"] * 3, [1, 1, None])
    assert len(rows(judged(df))) == 3
