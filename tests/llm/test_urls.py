"""The URL filter against plain Python, and on URLs that its models have not seen."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagetally.llm import urls

SCHEMA = "page_id long, url string, host int, score string, block int"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[:min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    found = [(len(h + p), len(h), h + p, v) for h, p, v in urls.RULES
             if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(found)[2:] if found else (None, None)


def text_of(url):
    url = url or ""
    if "://" not in url:
        return url
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]) + rest[cut:]


def brute(rows, order):
    """(host, path, rule, verdict, score) of each URL, in the order of ``rows``."""
    parsed = []
    for url in rows:
        host, path = split(url)
        rule, verdict = rule_of(host, path)
        text = text_of(url)
        scores = verdict is None or zlib.crc32(text.encode()) % urls.FOLDS == 0
        parsed.append((host, path, rule, verdict, text, scores))
    counts = {"allow": Counter(), "block": Counter()}
    alphabet = set()
    for *_, verdict, text, scores in parsed:
        alphabet |= set(text) | {urls.END}
        if not scores:
            for gram in urls.ngrams(text, order):
                for k in range(order + 1):
                    counts[verdict][gram[order - k:]] += 1
    after = {v: {} for v in counts}
    for v, table in counts.items():
        for gram, n in table.items():
            total, kinds = after[v].get((len(gram), gram[:-1]), (0, 0))
            after[v][(len(gram), gram[:-1])] = (total + n, kinds + 1)

    def chance(v, gram):
        p = 1 / len(alphabet)
        for k in range(order + 1):
            tail = gram[order - k:]
            total, kinds = after[v].get((k + 1, tail[:-1]), (0, 0))
            if total:
                p = (counts[v][tail] + kinds * p) / (total + kinds)
        return p

    out = []
    for host, path, rule, verdict, text, scores in parsed:
        score = None
        if scores:
            grams = urls.ngrams(text, order)
            score = sum(math.log(chance("allow", g)) - math.log(chance("block", g))
                        for g in grams) / len(grams)
        out.append([host, path, rule, verdict, score])
    known = [(s, v) for *_, v, s in out if v and s is not None]
    totals = Counter(v for _, v in known)
    limit = 0.0
    if len(totals) == 2:
        steps = {max(min(math.floor(s * urls.STEPS), urls.REACH * urls.STEPS),
                     -urls.REACH * urls.STEPS) for s, _ in known}
        tries = range(min(0, *steps), max(0, *steps) + 2)
        limit = min((-sum((math.floor(s * urls.STEPS) >= t) == (v == "allow") and 1 / totals[v]
                          for s, v in known), abs(t), t) for t in tries)[2] / urls.STEPS
    for row in out:
        row[3] = row[3] or ("allow" if row[4] >= limit else "block")
    return out


def random_urls(seed, n):
    rng = random.Random(seed)
    hosts = ["a.com", "WWW.Example.com", "example.com", "m.example.com", "x.net", "net", "com",
             "b.org", "notexample.com", "www.example.com.org", "x.www.example.com", "ü.org", ""]
    paths = ["", "/", "/en/", "/en", "/en/1", "/es/2", "/fr/x.html", "/EN/", "/fr/é", "?/en/", "#/fr/"]
    rows = [rng.choice(["http://", "https://", "HTTP://"]) + rng.choice(hosts) + rng.choice(paths)
            + rng.choice(["", "?a=b", "#c", "?q=http://x.net/fr/", str(rng.randrange(99))])
            for _ in range(n)]
    return rows + [None, "", "no scheme", "://", "://x.net/fr/", "a://b://c.com/", rows[0], rows[0]]


def judged(spark, rows, **options):
    frame = spark.createDataFrame([(i, u, 1, "x", 1) for i, u in enumerate(rows)], SCHEMA)
    found = {r.page_id: r for r in urls.judged(frame, **options).collect()}
    return [found[i] for i in range(len(rows))]


@pytest.mark.parametrize("order", [0, 2, 5])
def test_equals_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(urls, "BLOCK_ROWS", 50)
    rows = random_urls(1, 260)
    wanted = brute(rows, order)
    for row, (host, path, rule, verdict, score) in zip(judged(spark, rows, order=order), wanted):
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)
        assert (row.score is None) == (score is None)
        assert score is None or abs(row.score - score) < 1e-9


def test_rules_alone(spark):
    cases = {"http://m.Example.COM/en/4": ("m.example.com", "/en/4", "example.com/en/", "block"),
             "https://www.example.com/en/?x": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
             "x://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
             "http://example.com/de/1#a": ("example.com", "/de/1", "com/", "allow"),
             "http://n.net/es/": ("n.net", "/es/", "net/es/", "block"),
             "http://com/": ("com", "/", "com/", "allow")}
    for row, wanted in zip(judged(spark, list(cases)), cases.values()):
        assert (row.host, row.path, row.rule, row.verdict) == wanted
    for row in judged(spark, ["http://a.com", "http://telecom/", "http://n.net/en/", None]):
        assert row.rule is None and row.verdict in ("allow", "block")


def test_no_urls_one_kind_and_a_long_one(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert urls.judged(frame).collect() == []
    rows = judged(spark, ["http://b.org/1", None])
    assert [(r.verdict, r.score) for r in rows] == [("allow", 0.0)] * 2
    long = "http://long.org/" + "ab/" * 200_000
    rows = judged(spark, [long, "http://a.com/", "http://a.net/fr/", long])
    assert rows[0].score == rows[3].score and len(rows[0].path) == 600_001


def test_models_tell_unseen_urls(spark):
    """Rules that depend on a word of the path: URLs that no rule fits follow the word."""
    rng = random.Random(8)
    good, bad = ["garden", "library", "museum"], ["casino", "poker", "pills"]
    rows = [f"http://s{rng.randrange(500)}.{'com' if i % 2 else 'net'}/"
            f"{'' if i % 2 else 'fr/'}{rng.choice(good if i % 2 else bad)}/{rng.randrange(10 ** 6)}"
            for i in range(3000)]
    fresh = [f"http://q{i}.org/{rng.choice(good if i % 2 else bad)}/{rng.randrange(10 ** 6)}"
             for i in range(400)]
    found = judged(spark, rows + fresh)[len(rows):]
    right = sum((r.verdict == "allow") == bool(i % 2) for i, r in enumerate(found))
    assert right >= 0.97 * len(fresh)


def test_one_url_of_many_rows(spark):
    frame = spark.range(30_000).select(F.col("id").alias("page_id"), F.when(
        F.col("id") % 3 == 0, F.lit("http://hot.org/a")).otherwise(F.concat(
            F.lit("http://h"), F.col("id") % 50, F.lit(".com/"), F.col("id"))).alias("url"))
    rows = urls.judged(frame)
    assert rows.count() == 30_000
    assert rows.filter("host = 'hot.org'").select("verdict", "score").distinct().count() == 1
