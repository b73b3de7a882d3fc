"""Sentence output, and the crawl state kept between cycles."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import history as H

# Fixed value: ISO 8601 with microseconds and a numeric offset.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def sentence_records(sentences: DataFrame) -> DataFrame:
    """``(text, url, timestamp)``, the columns of the sentence output."""
    return sentences.select("text", "url", "timestamp")


def write_sentences(sentences: DataFrame, path: str, fmt: str = "json", mode: str = "append") -> None:
    """Append sentence records as JSON lines (UTF-8, not escaped) or another format."""
    writer = sentence_records(sentences).write.mode(mode).format(fmt)
    if fmt == "json":
        writer = writer.option("timestampFormat", TIMESTAMP_FORMAT).option("timeZone", "UTC")
    writer.save(path)


def _absent(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


class CrawlState:
    """Visit times, sentence hashes (and their filter) and the queue, as one table folder each.

    A cycle writes its changes to ``<table>/cycle=N`` and then one row to
    ``commits``. Readers take committed cycles only, so a cycle that failed
    half-way leaves nothing behind and can be run again under its number. ``commits``
    is there before any table, so tables without it are a damaged state and raise.

    A stream commits its query's id and batch number too: a batch is known by these
    and gets the next cycle number, whatever else used the state before.
    """

    TABLES = ("visited", "hashes", "filters", "frontier")

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            stored = self.spark.read.schema(f"{schema}, cycle BIGINT").parquet(f"{self.root}/{table}")
        except AnalysisException as e:
            if not _absent(e):
                raise
            return self.spark.createDataFrame([], f"{schema}, cycle BIGINT")
        return stored

    def _exists(self, table: str) -> bool:
        try:
            self.spark.read.schema("cycle BIGINT").parquet(f"{self.root}/{table}")
        except AnalysisException as e:
            if not _absent(e):
                raise
            return False
        return True

    def _commits(self) -> DataFrame | None:
        if not self._exists("commits"):
            if any(map(self._exists, self.TABLES)):
                raise ValueError(f"crawl state without its commits: {self.root}")
            return None
        return self.spark.read.schema("cycle BIGINT, run STRING, batch BIGINT").parquet(f"{self.root}/commits")

    def _mark(self, cycle: int, run: str | None, batch: int | None) -> None:
        marker = self.spark.createDataFrame([(cycle, run, batch)], "cycle BIGINT, run STRING, batch BIGINT")
        marker.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def last_cycle(self) -> int:
        """Number of the last committed cycle, -1 before the first."""
        commits = self._commits()
        last = None if commits is None else commits.agg(F.max("cycle").alias("last")).head().last
        return -1 if last is None else last

    def has_batch(self, run: str, batch: int) -> bool:
        """Whether that batch of that stream has been committed."""
        commits = self._commits()
        return commits is not None and not commits.where((F.col("run") == run) & (F.col("batch") == batch)).isEmpty()

    def visited(self) -> DataFrame:
        """``(url, last_visited)`` over all committed cycles."""
        stored = self._read("visited", "url STRING, last_visited BIGINT")
        kept = stored.where(F.col("cycle") <= self.last_cycle())
        return kept.groupBy("url").agg(F.max_by("last_visited", "cycle").alias("last_visited"))

    def hashes(self) -> DataFrame:
        """``(hash)`` over all committed cycles; each is stored once."""
        stored = self._read("hashes", "hash STRING")
        return stored.where(F.col("cycle") <= self.last_cycle()).select("hash")

    def history(self) -> H.History:
        """The hashes over all committed cycles, with their filter: what new sentences are compared with.

        Filters of all cycles are made for one number of blocks. The cycle in which the history
        outgrows it brings a filter of the whole history, of more blocks, and earlier ones lapse.
        """
        hashes, last = self.hashes(), self.last_cycle()
        size = hashes.count()  # from the metadata of its files
        if size <= H.SLICE_ROWS:
            return H.History(hashes, size)
        words = ", ".join(f"{w} BIGINT" for w in H.WORDS)
        filters = self._read("filters", f"blocks BIGINT, block BIGINT, {words}").where(F.col("cycle") <= last)
        blocks = filters.agg(F.max("blocks").alias("most")).head().most
        if blocks is None:
            return H.history(hashes)
        return H.History(hashes, size, H.merged(filters.where(F.col("blocks") == blocks)), blocks)

    def _commit_hashes(self, cycle: int, hashes: DataFrame) -> None:
        folder = f"{self.root}/hashes/cycle={cycle}"
        hashes.select("hash").sortWithinPartitions("hash").write.mode("overwrite").parquet(folder)
        new, old = self.spark.read.schema("hash STRING").parquet(folder), self.hashes()
        total = old.count() + new.count()
        if total <= H.SLICE_ROWS:
            return
        filters = self._read("filters", "blocks BIGINT").where(F.col("cycle") <= self.last_cycle())
        blocks = filters.agg(F.max("blocks").alias("most")).head().most
        if blocks is None or total > blocks * H.FULL:
            blocks, new = H.blocks_for(total), new.unionByName(old)
        H.bloom(new, blocks).write.mode("overwrite").parquet(f"{self.root}/filters/cycle={cycle}")

    def frontier(self) -> DataFrame:
        """``(url, depth, ord)`` left by the last committed cycle."""
        stored = self._read("frontier", "url STRING, depth INT, ord BIGINT")
        return stored.where(F.col("cycle") == self.last_cycle()).select("url", "depth", "ord")

    def commit(
        self,
        cycle: int,
        visited: DataFrame | None = None,
        hashes: DataFrame | None = None,
        frontier: DataFrame | None = None,
        run: str | None = None,
        batch: int | None = None,
    ) -> None:
        """Store what a cycle changed and make it visible. A committed cycle is left alone."""
        if cycle <= self.last_cycle():
            return
        if self._commits() is None:
            self._mark(-1, None, None)
        if hashes is not None:
            self._commit_hashes(cycle, hashes)
        changes = {"visited": visited, "frontier": frontier}
        for table, df in changes.items():
            if df is not None:
                df.write.mode("overwrite").parquet(f"{self.root}/{table}/cycle={cycle}")
        self._mark(cycle, run, batch)

    def compact(self, root: str) -> CrawlState:
        """The same state in a new folder with one file set per table."""
        merged = CrawlState(self.spark, root)
        merged.commit(max(self.last_cycle(), 0), self.visited(), self.hashes(), self.frontier())
        return merged
