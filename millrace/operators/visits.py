"""Visit times per key: upsert, and the greedy revisit gate."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dedup import first_by_key
from millrace.operators.sizing import store


def upsert_visits(visited: DataFrame, new: DataFrame, seq: str | None = None) -> DataFrame:
    """``(url, last_visited)`` with ``new`` written over ``visited``.

    The last write wins: by ``seq`` where ``new`` has such a column, else the
    latest time, the clock only moving forward.
    """
    if seq is None:
        both = visited.select("url", "last_visited").unionByName(new.select("url", "last_visited"))
        return both.groupBy("url").agg(F.max("last_visited").alias("last_visited"))
    old = visited.select("url", "last_visited", F.lit(None).cast("bigint").alias("_seq"))
    both = old.unionByName(new.select("url", "last_visited", F.col(seq).cast("bigint").alias("_seq")))
    # Rows stored earlier come before every new write.
    at = F.coalesce("_seq", F.lit(-(2**63)))
    return both.groupBy("url").agg(F.max_by("last_visited", at).alias("last_visited"))


class VisitTable:
    """``(url, last_visited)`` in buckets of the URL's hash, each a folder of its own.

    An upsert reads and rewrites the buckets that new visits fall into and no other, and a lookup
    reads those its URLs fall into. Only bucket numbers come to the driver. A bucket is replaced as a
    whole, and an upsert that is repeated changes nothing, so one that was cut short is run again.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _bucket(self, url: str = "url") -> Column:
        return F.pmod(F.xxhash64(url), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame:
        schema = "url STRING, last_visited BIGINT, bucket INT"
        try:
            return self.spark.read.schema(schema).parquet(self.root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        return self._stored().select("url", "last_visited")

    def of(self, urls: DataFrame) -> DataFrame:
        """The visits of the buckets that ``urls(url)``, a stored table, fall into."""
        wanted = [r.bucket for r in urls.select(self._bucket().alias("bucket")).distinct().collect()]
        return self._stored().where(F.col("bucket").isin(wanted)).select("url", "last_visited")

    def upsert(self, new: DataFrame) -> None:
        """Write ``new(url, last_visited)`` over what is stored; the latest time stays."""
        new = store(new.groupBy("url").agg(F.max("last_visited").alias("last_visited")))
        merged = store(upsert_visits(self.of(new), new))  # read before its buckets are replaced
        dealt = merged.withColumn("bucket", self._bucket()).repartition("bucket")
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("bucket").parquet(self.root)


def admit_run(times: np.ndarray, every: int, last: int | None) -> tuple[list[int], int | None]:
    """Positions admitted from sorted ``times`` of one key, and the time last admitted."""
    picked, at = [], 0 if last is None else int(np.searchsorted(times, last + every))
    while at < len(times):
        picked.append(at)
        last = int(times[at])
        at = int(np.searchsorted(times, last + every))
    return picked, last


def admit_runs(times: np.ndarray, starts: np.ndarray, every: int, lasts: list[int | None]) -> list[int]:
    """:func:`admit_run` over many keys, one run of sorted ``times`` each.

    The row that follows each row is looked up for all rows at once; what is
    left is to walk from one admitted row to the next.
    """
    ends = np.append(starts[1:], len(times))
    low = int(times.min())
    width = int(times.max()) - low + every + 1  # runs lie further apart than the interval
    run = np.repeat(np.arange(len(starts)), ends - starts)
    place = run * width + (times - low)
    follows = np.searchsorted(place, place + every).tolist()
    picked: list[int] = []
    for begin, end, last in zip(starts.tolist(), ends.tolist(), lasts):
        at = begin if last is None else begin + int(np.searchsorted(times[begin:end], last + every))
        while at < end:
            picked.append(at)
            at = follows[at]
    return picked


def revisit_gate(
    df: DataFrame,
    key: str,
    time: str,
    order: Sequence[str],
    every: int,
    visited: DataFrame | None = None,
) -> DataFrame:
    """Rows at least ``every`` seconds after the last *admitted* row of their key.

    ``time`` is in whole seconds; ``order`` ranks rows of one second and has to
    be total. A rejected row does not reset the clock. ``visited(url,
    last_visited)`` gives times admitted earlier. Rows without a key never pass.

    At most one row per second of a key can pass, so each second is first
    reduced to its earliest row. What remains of a key is bounded by the time
    it spans, not by how many rows it has, and passes through its task as a
    sorted stream of Arrow batches.
    """
    if every <= 0:
        return df.where(F.col(key).isNotNull())
    firsts = first_by_key(df, [key, time], order)
    if visited is None:
        seeded = firsts.withColumn("_last", F.lit(None).cast("bigint"))
    else:
        last = visited.select(F.col("url").alias(key), F.col("last_visited").cast("bigint").alias("_last"))
        seeded = firsts.join(last, key, "left").select(*firsts.columns, "_last")

    def gate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, last = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([batch])
            keys, times = rows.column(key).combine_chunks(), rows.column(time).to_numpy()
            changes = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))
            starts = np.append(0, np.flatnonzero(changes.to_numpy(zero_copy_only=False)) + 1)
            first_keys, earlier = keys.take(pa.array(starts)), rows.column("_last").take(pa.array(starts))
            if first_keys[0].as_py() != current:
                last = earlier[0].as_py()
            lasts = [last, *earlier.to_pylist()[1:]]
            picked = admit_runs(times, starts, every, lasts)
            current = first_keys[-1].as_py()
            in_last_run = len(picked) and picked[-1] >= starts[-1]
            last = int(times[picked[-1]]) if in_last_run else lasts[-1]
            yield from rows.take(pa.array(picked, pa.int64())).drop_columns("_last").to_batches()

    sorted_runs = seeded.where(F.col(key).isNotNull()).repartition(key).sortWithinPartitions(key, time)
    return sorted_runs.mapInArrow(gate, firsts.schema)
