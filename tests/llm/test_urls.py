import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablecraft.llm import urls
from tablecraft.llm.queries import QUERIES, RULES

URLS = [
    None, "", "no scheme/de/", "http://", "http://example.com", "http://example.com/de/", "HTTP://WWW.Example.COM/de/x?y=1&z=2#f",
    "http://example.com/DE/", "http://badexample.com/de/1", "https://a.b.example.net/en/1", "https://example.net/en", "https://example.net",
    "https://example.net?x=/en/", "https://net/", "https://x.net#a", "http://u@x.org:80/fr/9.html", "http://x.org/fr", "http://org/fr/",
    "ftp://x://y.net/en/", "http://É.net/é?ü", "http://example.net/en/" + "a" * 5000, "http://x.com/a\nb?c", "http://example.net.evil.com/en/",
]


def host_and_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    best = None
    for r in RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            if best is None or len(r.text) > len(best.text):
                best = r
    return best


def pages(spark, texts):
    return spark.createDataFrame([(i, u, "<p>", 1, 2) for i, u in enumerate(texts)], "page_id long, url string, html string, host int, label int")


def test_odd_urls_and_rules(spark):
    got = urls.judged(pages(spark, URLS + URLS), RULES).collect()
    assert len(got) == 2 * len(URLS)
    judged = {}
    for r in got:
        url = (URLS + URLS)[r.id]
        host, path = host_and_path(url)
        rule = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert r.verdict == (rule.verdict if rule else "block" if r.block_score >= 0.5 else "allow")
        assert judged.setdefault(url, r.verdict) == r.verdict


def test_empty_table_and_no_labels(spark):
    assert urls.judged(pages(spark, URLS).limit(0), RULES).collect() == []
    assert {r.verdict for r in urls.judged(pages(spark, URLS), []).collect()} == {"allow"}


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    trees = urls.Trees(trees=60).fit(x[:3000], y[:3000])
    assert ((trees.predict(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_features_are_those_of_the_url():
    f = urls._features(pd.DataFrame({"url": ["http://a.b/c/d-1?x=1&y=2#z", None], "host": ["a.b", ""], "path": ["/c/d-1", ""],
                                     "tld_rate": [0.1, 0.2], "suffix_rate": [0.3, 0.4], "head_rate": [0.5, 0.6]}))
    assert f[0, :6].tolist() == [26, 3, 6, 2, 1, 3 / 26]
    assert f[0, 7:].tolist() == [2, 1, 1, 0.1, 0.3, 0.5]
    assert f[1, :10].tolist() == [0] * 10


def test_held_out_labels_are_learnt(spark):
    """Trees trained without a third of the labelled pages judge that third."""
    df = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    out = urls.judged(df, RULES, held_out=F.col("id") % 3 == 0).where("id % 3 = 0 and rule is not null")
    right = F.avg(((F.col("block_score") >= 0.5) == (F.col("verdict") == "block")).cast("int"))
    assert out.agg(right.alias("a")).first().a > 0.95


def test_query(spark, sf):
    out = QUERIES["op2_url_filter"](spark, sf)
    assert out.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    assert out.count() == spark.read.parquet(f"{sf}/pages.parquet").count()
