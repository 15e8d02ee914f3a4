from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import functions as F

from propensity.llm.urls import ALPHABET, ORDER, RULES, judged, op5_urls, scored, segments, trained

SF = "/root/testdata/sf0.01"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]


def rule_of(host, path):
    fits = [(d + p, v) for v, d, p in RULES if (host == d or host.endswith("." + d)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


def test_hosts_paths_and_rules(spark):
    urls = [
        "HTTP://WWW.Example.COM/en/a?x#y", "http://example.com/en", "http://example.com/en/", "https://a.b.example.com/en/1", "http://notexample.com/en/",
        "http://com/", "http://com", "x://y.net/es/q", "x://y.net/esq", "ftp://ÄÖ.Net/fr/ü", "no scheme.com/en/", "://", "a://b://c.com/d", "http://h.com?/en/#", "http://h.com:80/", "",
        "http://www.example.com/en/\nline", None, "http://.com/", "http://u@x.example.com/en/",
    ]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("verdict", F.lit(3))
    rows = sorted(judged(df).collect(), key=lambda r: r.page_id)
    assert len(rows) == len(urls)
    for r, url in zip(rows, urls, strict=True):
        assert (r.host, r.path) == split(url)
        rule, verdict = rule_of(r.host, r.path)
        assert r.rule == rule and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def parts(url):
    text = url.split("://", 1)[1] if "://" in url else url
    end = min([text.index(c) for c in "/?#" if c in text], default=len(text))
    return "^" + text[:end].lower(), "$" + text[end:]


def brute_scores(train, urls):
    count = [defaultdict(lambda: defaultdict(float)), defaultdict(lambda: defaultdict(float))]
    for url, accepted in train:
        for part in parts(url):
            for i, c in enumerate(part):
                for k in range(min(i, ORDER) + 1):
                    count[accepted][part[i - k : i]][c] += 1

    def chance(model, before, c):
        p = 1 / ALPHABET
        for k in range(len(before) + 1):
            seen = model.get(before[len(before) - k :])
            if seen:
                n, kinds = sum(seen.values()), len(seen)
                p = (seen.get(c, 0) + kinds * p) / (n + kinds)
        return p

    out = []
    for url in urls:
        total = n = 0
        for part in parts(url):
            for i, c in enumerate(part):
                before = part[max(0, i - ORDER) : i]
                total += math.log(chance(count[1], before, c) / chance(count[0], before, c))
                n += 1
        out.append(total / max(n - 2, 1))
    return out


def test_scores_equal_a_plain_model(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    urls = [r.url for r in pages.orderBy("page_id").collect()] + ["", "x", "http://ü.de/ñ"]
    train = [(u, rule_of(*split(u))[1] == "allow") for u in urls if rule_of(*split(u))[0]]
    frame = segments(spark.createDataFrame(train, "url string, accepted boolean"))
    everything = segments(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    got = sorted(scored(everything, trained(frame)).collect(), key=lambda r: r.page_id)
    assert all(abs(r.score - w) < 1e-9 for r, w in zip(got, brute_scores(train, urls), strict=True))


def test_query_judges_every_page_and_agrees_with_rules_it_did_not_see(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = op5_urls(spark, SF).collect()
    assert len(rows) == pages.count()
    ruled = [(r.verdict == "allow") == (r.score >= -0.2) for r in rows if r.rule]
    assert sum(ruled) / len(ruled) > 0.9


def test_without_training_urls_all_are_accepted(spark):
    df = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (2, None)], "page_id long, url string")
    assert [(r.score, r.verdict) for r in judged(df).collect()] == [(0.0, "allow")] * 3
    assert judged(df.limit(0)).count() == 0


def test_plan_is_native(spark):
    plan = judged(spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_columns_of_any_name_come_back(spark):
    names = ["head", "tail", "fold", "ruled", "head_llr", "tail_n", "part", "of", "salt", "whole", "Score"]
    urls = ["http://a.com/x", "http://b.net/es/1", None, "http://a.com/x"]
    df = spark.createDataFrame([(i, u, *[f"{c}{i}" for c in names]) for i, u in enumerate(urls)], ["page_id", "url", *names])
    out = judged(df)
    assert out.columns == ["page_id", "url", *names[:-1], "host", "path", "rule", "score", "verdict"]
    rows = sorted(out.collect(), key=lambda r: r.page_id)
    assert [[r[c] for c in names[:-1]] for r in rows] == [[f"{c}{i}" for c in names[:-1]] for i in range(len(urls))]
    assert [r.url for r in rows] == urls


def test_a_long_url_is_scored_whole(spark):
    urls = ["http://a.com/" + "x" * 20_000, "http://b.net/es/" + "y" * 20_000, "http://c.com/" + "x" * 19_999 + "y"]
    rows = judged(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    assert sorted(r.path for r in rows) == sorted(split(u)[1] for u in urls)
