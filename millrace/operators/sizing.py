"""Helpers that look at sizes before choosing a physical strategy."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# Keys that one task may sort to find the n-th, and keys sampled to get there.
SLICE_ROWS = 50_000
SAMPLE_ROWS = 4_000


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and the length of their JSON form."""
    seen = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"),
    ).head()
    return seen.n, seen.bytes


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` against both bounds, by counts summed in its own tasks."""
    n, length = measure(df)
    return n <= rows and length <= size


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when it is measured to be small, else unchanged.

    Unchanged, the join is left to adaptive execution: a shuffle join that
    splits skewed partitions. ``df`` is evaluated once more, so pass a table or
    something cheap.
    """
    return F.broadcast(df) if fits_broadcast(df, rows, size) else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Re-split a scan that arrives in fewer tasks than half the cores.

    Large inputs come in more splits than that and pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if 2 * df.rdd.getNumPartitions() > cores:
        return df
    return df.repartition(cores, *keys)


_scratch: ContextVar[str | None] = ContextVar("_scratch", default=None)


def workspace(spark: SparkSession) -> str:
    """A new folder path for an intermediate table: under ``spark.checkpoint.dir``, and
    inside the folder of :func:`scratch` where that is open."""
    return f"{_scratch.get() or _shared_root(spark)}/millrace-{uuid.uuid4().hex}"


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_folder()
    return root.rstrip("/")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are removed at the end, so nothing that still
    reads them may leave the block."""
    folder = workspace(spark)
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@cache
def _local_folder() -> str:
    """Stand-in for local mode, where driver and tasks share one machine."""
    return tempfile.mkdtemp(prefix="millrace-")


def store(df: DataFrame, path: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared workspace and read it back: a cut in the lineage
    that outlives executors. ``codec`` compresses texts better than the session's choice."""
    path = path or workspace(df.sparkSession)
    df.write.options(**({"compression": codec} if codec else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in ascending ``order`` (a total order), as a comparison with the n-th.

    The n-th key is selected, not ranked: a sample of the keys that are still in question gives two
    keys around it, rows up to both are counted exactly, and only keys between them stay in
    question, until those are few enough for one task. ``df`` is evaluated several times for its
    order columns, so pass a table or something cheap.
    """
    if n <= 0:
        return df.limit(0)
    key = F.struct(*((F.col(c) if isinstance(c, str) else c).alias(f"_{i}") for i, c in enumerate(order)))
    cut = _nth_key(df.select(key.alias("key")), n)
    return df if cut is None else df.where(key <= cut)


def _literal(value, kind: DataType) -> Column:
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, StructType):
        return F.struct(*(_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields, strict=True)))
    if isinstance(kind, ArrayType):
        return F.array(*(_literal(v, kind.elementType) for v in value)).cast(kind)
    return F.lit(value).cast(kind)


def _nth_key(keys: DataFrame, n: int) -> Column | None:
    """The ``n``-th smallest ``key`` as a literal; ``None`` if there are not more than ``n``."""
    kind, key = keys.schema["key"].dataType, F.col("key")
    size = keys.count()
    if size <= n:
        return None
    left, seed = n, 0  # the key wanted is the ``left``-th of the ``size`` still in question
    while size > SLICE_ROWS:
        seed += 1
        sample = keys.sample(min(1.0, SAMPLE_ROWS / size), seed).limit(4 * SAMPLE_ROWS).orderBy("key").collect()
        if not sample:
            continue
        middle, margin = left / size * len(sample), 2 * len(sample) ** 0.5
        edges = [_literal(sample[min(max(int(at), 0), len(sample) - 1)].key, kind) for at in (middle - margin, middle + margin)]
        upto = [F.count_if(key <= e).alias(f"n{i}") for i, e in enumerate(edges)]
        low, high = keys.agg(*upto).head()
        before = size
        if left <= low:
            keys, size = keys.where(key <= edges[0]), low
        elif left <= high:
            keys, size, left = keys.where((key > edges[0]) & (key <= edges[1])), high - low, left - low
        else:
            keys, size, left = keys.where(key > edges[1]), size - high, left - high
        if size == before:  # equal keys only
            break
    return _literal(keys.orderBy("key").limit(left).agg(F.max("key").alias("key")).head().key, kind)
