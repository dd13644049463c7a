import math
from collections import Counter

import pytest
from lateship.llm.queries import URL_RULES
from lateship.llm.url_filter import BEGIN, END, ORDER, calibrate, filter_urls, gram_scores, score_urls


def split(url):
    u = url or ""
    i = u.find("://")
    if i < 0:
        return "", ""
    rest = u[i + 3:]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def rule_of(host, path):
    best = None
    for h, p, v in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return best or (None, None)


URLS = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.NET/en/x?a#b", "https://a.example.net/en", "https://a.example.net/en/", "ftp://net/x", "x://net",
        "x://net?/", "s://sub.org/fr/a", "s://org/fr", "s://sub.example.com/de/", "s://badexample.com/de/", "a://b://net/", "s://É.NET/ü", "s://h\n.net/\n/x?q",
        "s://host#://net/", "s://user@x.net:80/en/", "s://shop.info/" + "long/" * 3000] + [f"http://good{i % 7}.org/fr/story/{i}" for i in range(60)] + \
       [f"http://spam{i % 7}.net/win/cash/{i}" for i in range(60)] + [f"http://site.info/fr/story/{i}" for i in range(20)] + \
       [f"http://site.info/win/cash/{i}" for i in range(20)]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)] + [(4, URLS[4], "old")], "page_id long, url string, verdict string").repartition(3)
    got = filter_urls(spark, df, URL_RULES).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = split(URLS[r.page_id])
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
        assert r.verdict == (verdict or ("allow" if r.score >= r.threshold else "block"))


def test_held_out_urls_are_told_apart(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r.url: r.verdict for r in filter_urls(spark, df, URL_RULES).collect()}
    story = [v for u, v in got.items() if u and u.startswith("http://site.info/fr")]
    cash = [v for u, v in got.items() if u and u.startswith("http://site.info/win")]
    assert story.count("allow") >= 18 and cash.count("block") >= 18


def brute_scores(counts):
    """Witten-Bell interpolation, written out: url -> score in millionths."""
    grams = lambda u: [(BEGIN * ORDER + u + END)[i:i + ORDER + 1] for i in range(len(u) + 1)]
    n, all_grams = {"a": Counter(), "r": Counter()}, set()
    for u, (a, r) in counts.items():
        for g in grams(u):
            all_grams.add(g)
            for k in range(ORDER + 1):
                n["a"][g[ORDER - k:]] += a
                n["r"][g[ORDER - k:]] += r
    chars = {g[-1] for g in all_grams}
    events = {c: {e for g in all_grams for e in (g[ORDER - k:] for k in range(ORDER + 1)) if n[c][e]} for c in n}
    total = {c: sum(n[c][x] for x in chars) for c in n}

    def p(c, g):
        out = (n[c][g[-1]] + 1) / (total[c] + len(chars) + 1)
        for k in range(1, ORDER + 1):
            e = g[ORDER - k:]
            followers = [x for x in events[c] if len(x) == k + 1 and x[:-1] == e[:-1]]
            seen, kinds = sum(n[c][x] for x in followers), len(followers)
            if seen:
                out = (n[c][e] + kinds * out) / (seen + kinds)
        return out

    score = {g: round(math.log(p("a", g) / p("r", g)) * 1e6) for g in all_grams}
    return {u: int(sum(score[g] for g in grams(u)) / (len(u) + 1)) for u in counts}


@pytest.mark.parametrize("bound", [400_000, 1])
def test_scores_match_brute_force(spark, bound):
    """With the model broadcast, and joined."""
    counts = {"": (1, 0), "abab": (3, 0), "abba": (0, 2), "baab": (1, 1), "zz": (0, 0), "aba": (0, 5), "ab" * 700: (1, 0),
              "b" * 511: (0, 1), "b" * 512: (0, 0), "é字a" * 513: (2, 1)}
    urls = spark.createDataFrame([(i, u, *c) for i, (u, c) in enumerate(counts.items())], "no long, url string, a long, r long")
    texts = list(counts)
    got = {texts[r.no]: r.score for r in score_urls(urls, gram_scores(spark, urls), broadcast_grams=bound).collect()}
    want = brute_scores(counts)
    assert set(got) == set(want) and all(abs(got[u] - want[u]) <= 1 for u in want)


def test_very_long_urls_take_little_time(spark):
    import time
    df = spark.createDataFrame([(1, "http://a.net/" + "é/" * 500_000), (2, "http://b.org/fr/x"), (3, "http://c.net/y")], "page_id long, url string")
    start = time.monotonic()
    assert {r.page_id: r.verdict for r in filter_urls(spark, df, URL_RULES).collect()} == {1: "block", 2: "allow", 3: "block"}
    assert time.monotonic() - start < 90


def test_calibration(spark):
    df = lambda rows: spark.createDataFrame(rows, "score long, a long, r long")
    assert calibrate(df([])) == 0.0 and calibrate(df([(5, 1, 0)])) == 0.0
    t = calibrate(df([(900_000, 5, 0), (300_000, 2, 0), (-100_000, 0, 9), (50_000, 0, 1)]))
    assert 50_000 < t <= 300_000


def test_empty_and_one_class(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(spark, empty, URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://x.info/"), (2, "http://a.org/fr/")], "page_id long, url string")
    assert {r.page_id: r.threshold for r in filter_urls(spark, one, URL_RULES).collect()} == {1: 0.0, 2: 0.0}


def test_no_python_in_the_plan(spark, sf_dir):
    df = filter_urls(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
