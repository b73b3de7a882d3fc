"""Streaming queries: continuous or one pass over what is there."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.dedup import first_sentences, with_hash
from millrace.operators.filters import in_language
from millrace.operators.visits import revisit_gate, upsert_visits
from millrace.plans.gather import page_sentences
from millrace.sources.output import TIMESTAMP_FORMAT, CrawlState, sentence_records, write_sentences

INTERVAL = "20 seconds"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Files of a shuffle go once the job that made them ends, not when the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on disk beside the heap, and write only its
    changes to the checkpoint. A stream keeps the choice of its first start in its checkpoint."""
    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _trigger(writer, once: bool, interval: str):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)


def start_files(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", once: bool = False, interval: str = INTERVAL
) -> StreamingQuery:
    """Write a stream to files, each row exactly once; ``once`` stops after what is there. State is
    kept in RocksDB."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    if fmt == "json":
        writer = writer.option("timestampFormat", TIMESTAMP_FORMAT).option("timeZone", "UTC")
    with state_in_rocksdb(df.sparkSession):
        return _trigger(writer.outputMode("append"), once, interval).start()


def start_batches(
    df: DataFrame,
    step: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool = False,
    interval: str = INTERVAL,
) -> StreamingQuery:
    """Call ``step(batch, batch_id)`` on each micro-batch. A batch may be repeated under
    its number after a failure, so ``step`` has to overwrite by it."""
    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return _trigger(writer, once, interval).start()


def _query_id(batch: DataFrame, checkpoint: str) -> str:
    """The stream's id, which it keeps in its checkpoint: a new checkpoint is another stream."""
    written = batch.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").head()
    return json.loads(written.value)["id"]


def distinct_stream(
    sentences: DataFrame, text: str = "text", time: str | None = None, forget_after: str | None = None
) -> DataFrame:
    """Each sentence once, with its ``hash``, which is all the state holds.

    Without an end the state grows with the hashes. With ``forget_after`` (such as ``"30 days"``, by
    the event time ``time``) a hash expires once the stream has seen times that much later than its
    first occurrence, and the state is what such a time brings; a later copy is then a new sentence. Which copy of one micro-batch is
    kept is not fixed; see :func:`start_gather`.
    """
    hashed = with_hash(sentences, text)
    if forget_after is None:
        return hashed.dropDuplicates(["hash"])
    if time is None:
        raise ValueError("forget_after needs the column of the event time")
    return hashed.withWatermark(time, forget_after).dropDuplicatesWithinWatermark(["hash"])


def start_distinct(
    pages: DataFrame, order: Sequence[str], path: str, checkpoint: str, target: str | None,
    model: DataFrame | None = None, fmt: str = "json", once: bool = False, interval: str = INTERVAL,
    forget_after: str | None = None, **options,
) -> StreamingQuery:
    """Pages to distinct sentences with the state kept by Spark, in RocksDB; ``forget_after`` bounds it
    by the time pages were fetched."""
    sentences = page_sentences(pages, order, target, model, **options)
    found = distinct_stream(sentences, time="timestamp", forget_after=forget_after)
    return start_files(sentence_records(found), path, checkpoint, fmt, once, interval)


def start_gather(
    pages: DataFrame, order: Sequence[str], path: str, state: CrawlState, checkpoint: str, target: str | None,
    model: DataFrame | None = None, once: bool = False, interval: str = INTERVAL, **options,
) -> StreamingQuery:
    """Pages to new sentences, the first in crawl order winning inside a micro-batch.

    Hashes of earlier batches are a table with a filter beside it, not operator state, so history
    may outgrow the executors: a batch meets the filter, and the history only with what the filter
    lets through. Output goes to ``path/cycle=<number>``, numbered on by
    whatever shares the state; a repeated batch overwrites its own folder. The texts shuffled for a
    batch are off the disk before its hashes are written.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        run = _query_id(batch, checkpoint)
        if state.has_batch(run, batch_id):
            return  # committed before the checkpoint was
        batch.sparkSession.conf.set(FREE_SHUFFLES, "true")  # the stream's own session
        cycle = state.last_cycle() + 1
        found = page_sentences(batch, order, None, None, **options)
        # With every column in the order, a row carries its place once through the shuffle.
        places = [*order, "pos", "url", "timestamp"]
        new = in_language(first_sentences(found, places, state.history()), ["hash"], target, model, "text")
        folder = f"{path.rstrip('/')}/cycle={cycle}"
        write_sentences(new, folder, mode="overwrite")
        written = batch.sparkSession.read.schema("text string").json(folder)
        state.commit(cycle, hashes=with_hash(written).select("hash"), run=run, batch=batch_id)

    return start_batches(pages, step, checkpoint, once, interval)


def start_revisit_gate(
    events: DataFrame, key: str, time: str, order: Sequence[str], every: int, path: str, state: CrawlState,
    checkpoint: str, once: bool = False, interval: str = INTERVAL,
) -> StreamingQuery:
    """Admit events at least ``every`` seconds after the last admitted one of their key.

    The times last admitted are the visit table of ``state``; a micro-batch is
    gated against it with the batch operator, so a hot key is reduced to one
    event per second before it meets one task.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        run = _query_id(batch, checkpoint)
        if state.has_batch(run, batch_id):
            return
        cycle = state.last_cycle() + 1
        last = state.visited()
        keyed = last.withColumn("url", last.url.cast(batch.schema[key].dataType))
        folder = f"{path.rstrip('/')}/cycle={cycle}"
        revisit_gate(batch, key, time, order, every, keyed).write.mode("overwrite").parquet(folder)
        admitted = batch.sparkSession.read.schema(batch.schema).parquet(folder)
        visits = admitted.selectExpr(f"cast(`{key}` as string) as url", f"cast(`{time}` as bigint) as last_visited")
        state.commit(cycle, visited=upsert_visits(visits.where("false"), visits), run=run, batch=batch_id)

    return start_batches(events, step, checkpoint, once, interval)
