import os
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from millrace.operators import admission as A
from millrace.operators import sizing
from millrace.operators.robots import robots_allowed


def table(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def urls_of(df):
    return sorted(r.url for r in df.collect())


URLS = ["http://a.b/x", "http://s.a.b/", "http://xa.b/", "http://b/", "http:///none", "http://www.c.d/", "http://c.d:8/"]


@pytest.mark.parametrize("small", [True, False])
def test_allowlist_rules(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(sizing, "fits_broadcast", lambda *a, **k: False)
        monkeypatch.setattr(A, "fits_broadcast", lambda *a, **k: False)
    urls = table(spark, URLS, "url")
    seeds, given = table(spark, ["a.b", "www.c.d", "a.b"], "domain"), table(spark, ["b", "c.d:8"], "domain")

    def allowed(**switches):
        return urls_of(A.allowed_links(urls, seeds, **switches))

    assert allowed() == ["http://a.b/x", "http://s.a.b/", "http://www.c.d/"]
    assert allowed(subdomains=False) == ["http://a.b/x", "http://www.c.d/"]
    assert allowed(allowed_domains=given) == ["http://a.b/x", "http://b/", "http://c.d:8/", "http://s.a.b/", "http://xa.b/"]
    assert allowed(allowed_domains=given, subdomains=False) == ["http://b/", "http://c.d:8/"]
    assert allowed(same_domain_only=False) == sorted(u for u in URLS if u != "http:///none")
    assert allowed(same_domain_only=False, allowed_domains=given) == ["http://b/", "http://c.d:8/"]


def test_names_are_normalized_and_an_empty_list_is_unset(spark):
    urls = spark.createDataFrame([("http://a.b/x",), ("http://c.d/",)], "url string")
    names = spark.createDataFrame([(" A.B ",), ("",), (None,)], "domain string")
    assert A.allow_exact(urls, names).count() == A.allow_subdomains(urls, names).count() == 1
    rule = A.link_rule(spark.createDataFrame([("c.d",)], "domain string"), names.where("trim(domain) = ''"))
    assert [r.url for r in rule(urls).collect()] == ["http://c.d/"]


def test_several_robots_rows_of_one_host(spark):
    urls = spark.createDataFrame([("http://h/x",), ("http://h/y",)], "url string")
    rows = [("http://h", 200, "User-agent: *\nDisallow: /x", 1), ("http://h", 200, "User-agent: *\nDisallow: /y", 2)]
    robots = spark.createDataFrame(rows, "base string, status int, body string, fetched_at bigint")
    assert [r.url for r in robots_allowed(urls, robots, "m").collect()] == ["http://h/x"]


def test_copies_are_kept(spark):
    urls = table(spark, ["http://s.a.b/", "http://s.a.b/"], "url")
    allow = table(spark, ["a.b", "b", "s.a.b"], "domain")
    assert A.allow_subdomains(urls, allow).count() == 2


def test_revisit_and_queue(spark):
    urls = table(spark, ["a", "b", "c", "d"], "url")
    visited = spark.createDataFrame([("a", 100), ("b", 41), ("c", 40)], "url string, last_visited bigint")
    assert urls_of(A.revisit_due(urls, visited, 100, 60)) == ["c", "d"]
    assert urls_of(A.not_queued(urls, table(spark, ["a", "a", "z"], "url"))) == ["b", "c", "d"]


BODIES = {
    "plain": "User-agent: *\nDisallow: /private/\nAllow: /private/open\n",
    "first": "User-agent: *\nAllow: /private/open\nDisallow: /private/\n",
    "named": "User-agent: *\nDisallow: /\n\nUser-agent: MillBot\nDisallow: /x\n",
    "shared": "User-agent: other\nUser-agent: mill\nDisallow: /x # why\n\n\nUser-agent: *\nDisallow: /y\n",
    "empty rule": "User-agent: *\nDisallow:\n",
    "no agent": "Disallow: /x\n",
    "blank splits": "User-agent: *\n\nDisallow: /x\n",
    "two stars": "User-agent: *\nDisallow: /x\n\nUser-agent: *\nDisallow: /y\n",
    "no blank": "User-agent: a\nDisallow: /x\nUser-agent: *\nDisallow: /y\n",
    "delay": "User-agent: millbot\nCrawl-delay: 3\nUser-agent: *\nDisallow: /\n",
    "sitemap": "Sitemap: http://h/s\nUser-agent: *\nSitemap: http://h/t\nDisallow: /x\n",
    "escapes": "User-agent: *\r\nDisallow: /a%20b\r\nDisallow: /c+d\r\nDisallow: /q?x=1\r\nDisallow: /%e1%88%80\r\nDisallow: /t~*\r\n",
    "case": "USER-AGENT: MILLBOT\nDISALLOW: /x\n",
    "late rule": "User-agent: *\nDisallow: /x\n\nDisallow: /y\n",
    "nothing": "",
    "agent only": "User-agent: *\n",
    "star path": "User-agent: *\nDisallow: *\n",
}
PATHS = ["", "/", "/x", "/xy", "/y/z", "/private/", "/private/open/1", "/a b", "/a%20b/c", "/c+d", "/q?x=1&y=2", "/q", "/ሀ/1", "/t~*"]


def test_robots_match_the_standard_library(spark):
    agent = "MillBot/2.0"
    robots, urls, want = [], [], set()
    for n, body in enumerate(BODIES.values()):
        base = f"http://h{n}"
        robots.append((base, 200, body))
        parser = RobotFileParser()
        parser.parse(body.splitlines())
        for path in PATHS:
            urls.append((base + path,))
            if parser.can_fetch(agent, base + path):
                want.add(base + path)
    table = spark.createDataFrame(robots, "base string, status int, body string")
    got = robots_allowed(spark.createDataFrame(urls, "url string"), table, agent)
    assert {r.url for r in got.collect()} == want


def test_robots_status(spark):
    deny = "User-agent: *\nDisallow: /"
    rows = [("http://a", 401, None), ("http://b", 403, deny), ("http://c", 404, deny), ("http://d", 503, None),
            ("http://e", None, None), ("http://f", 200, deny)]
    table = spark.createDataFrame(rows, "base string, status int, body string")
    urls = spark.createDataFrame([(f"http://{h}/x",) for h in "abcdefg"], "url string")
    assert urls_of(robots_allowed(urls, table, "m")) == ["http://c/x", "http://e/x", "http://g/x"]


def test_broadcast_needs_a_measured_size(spark):
    small, large = spark.range(10), spark.range(1000)
    assert sizing.fits_broadcast(small, rows=10) and not sizing.fits_broadcast(large, rows=10)
    wide = small.select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert not sizing.fits_broadcast(wide, size=5000)
    plan = sizing.broadcast_if_small(large, rows=10)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan


def test_visits_of_few_urls_need_no_shuffle_of_the_history(spark, folder):
    spark.createDataFrame([("a", 1), ("a", 5), ("b", 2)], "url string, t bigint").write.parquet(f"{folder}/v")
    history = spark.read.parquet(f"{folder}/v")
    visited = history.groupBy("url").agg(F.max("t").alias("last_visited"))
    got = A.visits_of(table(spark, ["a", "c"], "url"), visited)
    assert [tuple(r) for r in got.collect()] == [("a", 5)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")  # the join is below the aggregate


def test_scratch_removes_its_tables(spark):
    with sizing.scratch(spark):
        stored = sizing.store(spark.range(3))
        place = stored.inputFiles()[0].removeprefix("file:").removeprefix("//")
        assert stored.count() == 3 and os.path.exists(place)
    assert not os.path.exists(place)
