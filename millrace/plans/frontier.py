"""Crawl cycles over stored pages: the queue is a table, one pass per link level.

Passes equal a first-in-first-out queue: every URL found in one pass stands
behind the whole of that pass. With ``max_queue`` the two can differ in which
links are left out, because a queue that is being emptied has more room later.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.functions import text as T
from millrace.operators.admission import (
    REVISIT_AFTER_SECONDS,
    distinct_domains,
    link_rule,
    not_queued,
    revisit_due,
    visits_of,
)
from millrace.operators.dedup import first_by_key, first_sentences, with_hash
from millrace.operators.filters import in_language, target_sentences
from millrace.operators.ordering import index_by_key
from millrace.operators.pages import explode_links, explode_sentences, extract
from millrace.operators.robots import robots_rule
from millrace.operators.history import History
from millrace.operators.report import CycleReport, counted, rows_seen
from millrace.operators.sizing import BROADCAST_BYTES, BROADCAST_ROWS, first_rows, measure, scratch, store
from millrace.operators.visits import upsert_visits
from millrace.sources.output import CrawlState, write_sentences
from millrace.sources.pages import accepted_pages, seed_frontier

MAX_DEPTH = 2
MAX_PAGES = 200
MAX_QUEUE = 3000


@dataclass(frozen=True)
class CycleOptions:
    """Limits and filters of a cycle; ``None`` for a limit means none."""

    target: str | None
    script: str = T.ETHIOPIC
    min_chars: int = T.MIN_CHARS
    min_ratio: float = T.MIN_SCRIPT_RATIO
    max_depth: int = MAX_DEPTH
    max_pages: int | None = MAX_PAGES
    max_queue: int | None = MAX_QUEUE
    revisit_after: int = REVISIT_AFTER_SECONDS
    same_domain_only: bool = True
    subdomains: bool = True
    user_agent: str = "millrace/1.0"
    drop_tags: Sequence[str] = H.DROP_TAGS


@dataclass(frozen=True)
class Cycle:
    """What a cycle produced: stored tables except for ``sentences``."""

    sentences: DataFrame  # text, url, timestamp, hash
    visits: DataFrame  # url, last_visited: this cycle only
    frontier: DataFrame  # url, depth, ord: what is still queued
    admitted: DataFrame  # url, depth: the visits and their levels
    passes: int

    def write(self, folder: str, began: float, clock=time.time) -> CycleReport:
        """Write the sentences; the report counts them on the way."""
        sentences, written = counted(self.sentences)
        write_sentences(sentences, folder, mode="overwrite")
        pages, queue = self.visits.count(), self.frontier.count()  # stored tables: from their metadata
        return CycleReport(pages, rows_seen(written), queue, clock() - began)


def run_cycle(
    pages: DataFrame,
    frontier: DataFrame,
    visited: DataFrame,
    seed_domains: DataFrame,
    now: int,
    options: CycleOptions,
    model: DataFrame | None = None,
    seen: DataFrame | History | None = None,
    robots: DataFrame | None = None,
    allowed_domains: DataFrame | None = None,
) -> Cycle:
    """One cycle. ``pages`` is keyed by canonical ``url``; a queued URL without a page
    counts as a failed fetch.

    The loop runs at most ``max_depth`` + 1 times, since links of one pass are
    a level deeper. Each pass stores what it admitted and parsed, so no page is
    parsed twice.
    """
    allowed = link_rule(seed_domains, allowed_domains, options.same_domain_only, options.subdomains)
    permitted = None if robots is None else robots_rule(robots, options.user_agent)
    spark = pages.sparkSession
    empty = spark.createDataFrame([], "url string, depth int, ord array<bigint>")
    waiting = frontier.select("url", "depth", F.array(F.col("ord")).alias("ord"))
    left = options.max_pages
    admitted_in, parsed_in, remainder, passes = [], [], empty, 0

    while passes <= options.max_depth and (left is None or left > 0):
        done = visits_of(waiting, visited)
        if admitted_in:
            done = upsert_visits(done, _union([_visits(a, now) for a in admitted_in]))
        due = revisit_due(
            allowed(waiting.where(F.col("depth") <= options.max_depth)), done, now, options.revisit_after
        )
        if permitted is not None:
            due = permitted(due)
        if not admitted_in:  # seeds may repeat; links found are distinct
            due = first_by_key(due, ["url"], ["ord"])
        admitted = store(due if left is None else first_rows(store(due), left, F.col("ord")))
        taken, size = measure(admitted)
        if taken == 0:
            break
        admitted_in.append(admitted)
        small = taken <= BROADCAST_ROWS and size <= BROADCAST_BYTES
        # HTML is shuffled only when too many URLs are admitted to send them to the pages.
        parsed = store(_parse(pages, F.broadcast(admitted) if small else admitted, options.drop_tags))
        parsed_in.append(parsed.withColumn("pass", F.lit(passes)))
        passes += 1

        if left is not None:
            left -= taken
            if left == 0:  # the rest of this pass stays ahead of the links found
                last = F.broadcast(admitted.agg(F.max("ord").alias("_last")))  # one row
                remainder = waiting.crossJoin(last).where("ord > _last").drop("_last")
        if passes > options.max_depth:  # every page of this pass was at the last level
            waiting = empty
            break
        links = explode_links(parsed.where(F.col("depth") < options.max_depth)).select(
            F.col("link").alias("url"),
            (F.col("depth") + 1).alias("depth"),
            F.array_append("ord", F.col("pos").cast("bigint")).alias("ord"),
        )
        fresh = not_queued(first_by_key(allowed(links), ["url"], ["ord"]), waiting)
        if options.max_queue is not None:
            queued = remainder.count() if left == 0 else 0
            fresh = first_rows(store(fresh), max(0, options.max_queue - queued), F.col("ord"))
        waiting = store(fresh)

    if left == 0:
        queue = remainder.withColumn("pass", F.lit(0)).unionByName(waiting.withColumn("pass", F.lit(1)))
        # Level by level, so that the number of array elements never decides.
        ordered = index_by_key(queue, "pass", F.size("ord"), "ord", name="_n")
        queue = ordered.select("url", "depth", F.col("_n").cast("bigint").alias("ord"))
    else:
        queue = spark.createDataFrame([], "url string, depth int, ord bigint")
    visits = _union([_visits(a, now) for a in admitted_in or [empty]])
    return Cycle(
        sentences=_sentences(parsed_in, options, model, seen, spark),
        visits=visits,
        frontier=queue,
        admitted=_union([a.select("url", "depth") for a in admitted_in or [empty]]),
        passes=passes,
    )


def _visits(admitted: DataFrame, now: int) -> DataFrame:
    return admitted.select("url", F.lit(now).cast("bigint").alias("last_visited"))


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _parse(pages: DataFrame, admitted: DataFrame, drop_tags: Sequence[str]) -> DataFrame:
    """Admitted URLs with the text and hrefs of their pages."""
    timestamp = F.col("fetched_at") if "fetched_at" in pages.columns else F.current_timestamp()
    usable = accepted_pages(pages).select("url", timestamp.alias("timestamp"), "html")
    return extract(usable.join(admitted, "url"), drop_tags)


def _sentences(parsed: list[DataFrame], options: CycleOptions, model, seen, spark: SparkSession) -> DataFrame:
    if not parsed:
        return spark.createDataFrame([], "text string, url string, timestamp timestamp, hash string")
    found = explode_sentences(_union(parsed).drop("depth"))
    kept = target_sentences(
        found, ["url", "pos"], None, min_chars=options.min_chars, script=options.script, min_ratio=options.min_ratio
    ).withColumnRenamed("sentence", "text")
    # The language is looked up once a text.
    first = first_sentences(kept, ["pass", "ord", "pos"], seen)
    return in_language(first, ["hash"], options.target, model, "text").select("text", "url", "timestamp", "hash")


def reseed(frontier: DataFrame, seeds: DataFrame) -> DataFrame:
    """``frontier``, or the seeds again when nothing is queued."""
    return first_by_key(seeds, ["url"], ["ord"]) if frontier.isEmpty() else frontier


def run(
    spark: SparkSession,
    pages: DataFrame,
    seeds: DataFrame,
    output: str,
    state: CrawlState,
    options: CycleOptions,
    model: DataFrame | None = None,
    robots: DataFrame | None = None,
    allowed_domains: DataFrame | None = None,
    once: bool = False,
    cycles: int | None = None,
    pause_seconds: float = 20,
    clock=time.time,
) -> list[dict]:
    """Cycle after cycle: load state, run, write, commit. Returns the reports.

    ``seeds(seed, ord)``. A cycle writes to its own folder under ``output`` and
    commits last, so a run that was cut short is repeated without copies.
    """
    start = seed_frontier(seeds)
    domains = distinct_domains(start)
    reports = []
    while True:
        cycle = state.last_cycle() + 1
        folder = f"{output.rstrip('/')}/cycle={cycle}"
        began = clock()
        with scratch(spark):
            result = run_cycle(
                pages, reseed(state.frontier(), start), state.visited(), domains, int(began), options,
                model, state.history(), robots, allowed_domains,
            )
            report = result.write(folder, began, clock)
            written = with_hash(spark.read.schema("text string").json(folder))
            state.commit(cycle, result.visits, written.select("hash"), result.frontier)
        reports.append({"cycle": cycle, **report.as_dict()})
        if once or (cycles is not None and len(reports) >= cycles):
            return reports
        time.sleep(pause_seconds)
