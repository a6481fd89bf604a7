import random

import numpy as np
import pytest

from pagelake.llm import url_filter as U

RULES = "host string, path string, verdict string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    return host.translate(str.maketrans(U.UPPER, U.LOWER)), rest[:end]


def brute(rows, rules, default="allow"):
    out = []
    for page_id, url in rows:
        host, path = parts(url)
        fits = []
        for h, p, v in rules:
            if None in (h, p) or v not in ("allow", "block") or not host:
                continue
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                fits.append((len(h) + len(p), len(h), v == "block", h + p, v))
        best = max(fits, default=None)
        out.append((page_id, host, path, best and best[3], best[4] if best else default))
    return sorted(out, key=repr)


def judged(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


def drawn(rng, n):
    hosts = ["a", "b.a", "c.b.a", "org", "x.org", "EXAMPLE.org", "www.example.org", "a..b", "", ".", "é.org", "b.a:80", "u@b.a"]
    paths = ["", "/", "/en/1", "/en/12", "/es/", "/es", "/fr/x.html", "//", "/é/é"]
    ends = ["", "?q=/x", "#top", "?a#b", "#a?b"]
    return [(i, rng.choice(["http", "HTTPS", "x://y"]) + "://" + rng.choice(hosts) + rng.choice(paths) + rng.choice(ends)) for i in range(n)]


ODD = [(None, None), (-1, ""), (-2, "no scheme/at/all"), (-3, "://"), (-4, "a://b\n.org/x\ny"), (-4, "a://b\n.org/x\ny"), (-5, "http://" + "a." * 3000 + "org/" + "x" * 30_000)]


@pytest.mark.parametrize("seed", range(2))
def test_by_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = drawn(rng, 400) + ODD
    hosts, paths = ["a", "b.a", "org", "example.org", "x.org", "b", "é.org", ".", "nowhere.net"], ["", "/", "/e", "/en/1", "/es/", "//", "/é"]
    rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(30)]
    rules += [*rules[:4], (None, "/", "block"), ("a", None, "block"), ("a", "/", None), ("a", "/", "Block")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = spark.createDataFrame(rules, RULES)
    assert judged(U.filter_urls(pages, listed)) == brute(rows, rules)
    assert judged(U.filter_urls(pages, listed, default="block")) == brute(rows, rules, "block")


def test_long_lists_in_shards_and_blocks(spark, monkeypatch):
    """Enough keys for several levels, cut into shards, and more filters than one broadcast may have."""
    monkeypatch.setattr(U, "BLOCK_BYTES", 500)
    rows = [(i, f"https://h{i % 700}.d{i % 90}.net/p{i % 40}/{i}") for i in range(6000)]
    rules = [(f"h{i}.d{i % 90}.net", f"/p{i % 40}", "block") for i in range(0, 700, 3)]
    rules += [(f"d{i}.net", "/p1", ["allow", "block"][i % 2]) for i in range(0, 90, 4)] + [(f"d{i}.org", "/", "allow") for i in range(900)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    built = U.UrlFilter.build(pages, spark.createDataFrame(rules, RULES), shard_keys=100)
    levels = built.levels.toPandas()
    assert levels["shard"].nunique() > 2 and levels["level"].max() > 1 and len(U._blocks(built.levels)) > 2
    assert judged(built.judge(pages)) == brute(rows, rules)
    plan = built.judge(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_levels_are_exact_where_single_filters_are_not():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (2, 60_000)).astype(np.uint64)
    mine, other = keys[:, :1000], keys[:, 1000:]
    first = U.Bits.of(*mine, 1, 0.1)
    passed = other[:, first.passes(*other)]
    assert passed.shape[1] > 3000
    levels, inside, outside = [first], passed, mine
    while inside.shape[1]:
        levels.append(U.Bits.of(*inside, len(levels) + 1, 0.5))
        inside, outside = outside[:, levels[-1].passes(*outside)], inside
    cascade = U.Cascade(levels[::-1])
    assert len(levels) > 3 and cascade.listed(*mine).all() and not cascade.listed(*other).any()


def test_nothing_listed_and_no_pages(spark):
    none = spark.createDataFrame([], RULES)
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert judged(U.filter_urls(pages, none)) == [(1, "a.b", "/c", None, "allow")]
    rules = spark.createDataFrame([("b", "/", "block")], RULES)
    assert judged(U.filter_urls(pages.limit(0), rules)) == []


def test_columns_of_the_pages_stay(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", "old", 2.0, "k")], "page_id long, url string, verdict string, size double, shard string")
    rules = spark.createDataFrame([("b", "/", "block")], RULES)
    got = U.filter_urls(pages, rules)
    assert got.columns == ["page_id", "url", "size", "shard", "host", "path", "rule", "verdict"]
    assert got.first()["verdict"] == "block" and got.first()["size"] == 2.0
