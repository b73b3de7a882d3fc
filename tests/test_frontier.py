import hashlib
from collections import deque
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from millrace.operators.admission import distinct_domains
from millrace.plans.frontier import CycleOptions, reseed, run, run_cycle
from millrace.sources.output import CrawlState

NOW = 1_000_000


def page(links, words):
    anchors = "".join(f"<a href='{l}'>x</a> " for l in links)
    return f"<body>{anchors}{words}</body>"


GRAPH = {
    # three levels, a cycle, a foreign domain, a subdomain, a link found twice, a missing page
    "http://h/a": (["/b", "/c", "http://other/x", "/b", "/a"], "First shared sentence here. Only on a ሀ here."),
    "http://h/b": (["/a", "/d", "http://s.h/e", "/bad"], "First shared sentence here. Only on b ሀ here."),
    "http://h/c": (["/d", "/missing", "/secret/1"], "Only on c here, twice. Only on c here, twice."),
    "http://h/d": (["/f"], "Deep words of page d."),
    "http://s.h/e": (["/g"], "Words of the subdomain e."),
    "http://h/f": ([], "Too deep to be read."),
    "http://h/bad": ([], "Error page, never read."),
    "http://h/secret/1": ([], "Forbidden words never read."),
}
ROBOTS = [("http://h", 200, "User-agent: *\nDisallow: /secret/\n")]


def brute_crawl(seeds, visited, limit, max_depth=2, revisit=100):
    """One cycle with a plain queue."""
    robots = RobotFileParser()
    robots.parse(ROBOTS[0][2].splitlines())
    queue, queued, visited = deque((s, 0) for s in seeds), set(seeds), dict(visited)
    order, written, seen = [], [], set()
    while queue and (limit is None or len(order) < limit):
        url, depth = queue.popleft()
        queued.discard(url)
        host = url.split("/")[2]
        inside = host == "h" or host.endswith(".h")
        recent = url in visited and NOW - visited[url] < revisit
        if depth > max_depth or not inside or recent or not (host != "h" or robots.can_fetch("m", url)):
            continue
        visited[url] = NOW
        order.append(url)
        if url not in GRAPH or url.endswith("/bad"):
            continue
        links, words = GRAPH[url]
        text = " ".join(["x"] * len(links) + [words])
        for sentence in text.replace(". ", ".\n").split("\n"):
            if len(sentence) >= 20 and sentence not in seen:
                seen.add(sentence)
                written.append((sentence, url))
        if depth < max_depth:
            for link in links:
                link = link if link.startswith("http") else f"http://{host}{link}"
                inside = link.split("/")[2] == "h" or link.split("/")[2].endswith(".h")
                if link not in queued and inside:
                    queue.append((link, depth + 1))
                    queued.add(link)
    waiting = [q for q in queue if not (q[0] in visited and NOW - visited[q[0]] < revisit)]
    return order, sorted(written), waiting


@pytest.fixture
def pages(spark):
    rows = [(u, 500 if u.endswith("/bad") else 200, "text/html", page(*v)) for u, v in GRAPH.items()]
    df = spark.createDataFrame(rows, "url string, status int, content_type string, html string")
    return df.withColumn("fetched_at", F.timestamp_seconds(F.lit(NOW)))


def cycle(spark, pages, frontier, visited, limit, **more):
    options = CycleOptions(
        target=None, script=r"A-Za-z\x{1200}-\x{137f}", max_pages=limit, max_queue=None, revisit_after=100,
        user_agent="m", **more,
    )
    robots = spark.createDataFrame(ROBOTS, "base string, status int, body string")
    domains = spark.createDataFrame([("h",)], "domain string")
    return run_cycle(
        pages,
        spark.createDataFrame(frontier, "url string, depth int, ord bigint"),
        spark.createDataFrame(visited, "url string, last_visited bigint"),
        domains, NOW, options, robots=robots,
    )


@pytest.mark.parametrize("limit", [None, 1, 3, 5])
def test_cycle_equals_a_plain_queue(spark, pages, folder, limit):
    visited = [("http://h/c", NOW - 100), ("http://s.h/e", NOW - 99)]
    seeds = ["http://h/a", "http://h/c", "http://h/a"]
    order, written, waiting = brute_crawl(seeds, visited, limit)
    got = cycle(spark, pages, [(u, 0, n) for n, u in enumerate(seeds)], visited, limit)
    assert sorted(r.url for r in got.visits.collect()) == sorted(order)
    report = got.write(f"{folder}/out", NOW, clock=lambda: NOW + 2.5)
    assert sorted((r.text, r.url) for r in spark.read.schema("text string, url string").json(f"{folder}/out").collect()) == written
    queue = [(r.url, r.depth) for r in got.frontier.orderBy("ord").collect()]
    known = {u for u, _ in waiting}
    assert [q for q in queue if q[0] in known] == list(dict.fromkeys(waiting))
    assert [r.ord for r in got.frontier.orderBy("ord").collect()] == list(range(len(queue)))
    assert report.as_dict() == {"pages": len(order), "sentences_written": len(written), "queue": len(queue), "elapsed": 2.5}


def test_queue_limit_keeps_the_first_links(spark, pages):
    options = CycleOptions(target=None, script="A-Za-z", max_pages=None, max_queue=1, max_depth=1)
    frontier = spark.createDataFrame([("http://h/a", 0, 0)], "url string, depth int, ord bigint")
    empty = spark.createDataFrame([], "url string, last_visited bigint")
    got = run_cycle(pages, frontier, empty, distinct_domains(frontier), NOW, options)
    assert sorted(r.url for r in got.visits.collect()) == ["http://h/a", "http://h/b"]


def test_queue_cap_counts_what_is_still_queued(spark, pages):
    seeds = ["http://h/a", *(f"http://h/x{i}" for i in range(9))]
    options = CycleOptions(target=None, script="A-Za-z", max_pages=1, max_queue=10)
    frontier = spark.createDataFrame([(u, 0, n) for n, u in enumerate(seeds)], "url string, depth int, ord bigint")
    empty = spark.createDataFrame([], "url string, last_visited bigint")
    got = run_cycle(pages, frontier, empty, distinct_domains(frontier), NOW, options)
    assert got.frontier.count() == 10


def test_reseed(spark):
    seeds = spark.createDataFrame([("a", 0, 0), ("b", 0, 1), ("a", 0, 2)], "url string, depth int, ord bigint")
    queue = spark.createDataFrame([("q", 1, 5)], "url string, depth int, ord bigint")
    assert [r.url for r in reseed(queue, seeds).collect()] == ["q"]
    again = reseed(queue.where("false"), seeds).orderBy("ord").collect()
    assert [(r.url, r.ord) for r in again] == [("a", 0), ("b", 1)]


def test_cycles_continue_from_state(spark, pages, folder):
    seeds = spark.createDataFrame([("http://h/a", 0), ("mailto:x", 1)], "seed string, ord bigint")
    options = CycleOptions(target=None, script="A-Za-z", max_pages=2, max_queue=None, revisit_after=10**9)
    state = CrawlState(spark, f"{folder}/state")
    first = run(spark, pages, seeds, f"{folder}/out", state, options, once=True, clock=lambda: NOW)
    again = CrawlState(spark, f"{folder}/state")  # as after a restart
    more = run(spark, pages, seeds, f"{folder}/out", again, options, cycles=4, pause_seconds=0, clock=lambda: NOW)
    assert [r["cycle"] for r in first + more] == [0, 1, 2, 3, 4]
    assert first[0]["pages"] == 2 and first[0]["queue"] > 0
    assert more[-1]["pages"] == 0  # everything visited; seeds queued again but not due
    rows = spark.read.json(f"{folder}/out").collect()
    texts = [r.text for r in rows]
    assert len(texts) == len(set(texts)) == again.hashes().count()
    assert {hashlib.sha256(t.encode()).hexdigest() for t in texts} == {r.hash for r in again.hashes().collect()}
    visited = {r.url for r in again.visited().collect()}
    assert {"http://h/a", "http://h/d", "http://s.h/e", "http://h/missing"} <= visited and "http://h/f" not in visited
