"""A growing history of hashes that is never shuffled.

Beside the hashes lies a Bloom filter in blocks: each hash belongs to one block of 512 bits (eight
numbers) and sets a few of them. New rows meet their block, some forty times smaller than the hashes
it stands for, and most are told at once to be new. Only the hashes of the others go to the
history, as broadcast slices of bounded size, each to the range of hashes it covers; files are
sorted by hash, so other row groups are skipped by their statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.sizing import BROADCAST_ROWS, broadcast_if_small, store

WORDS = [f"w{n}" for n in range(8)]
BITS = 64 * len(WORDS)
PROBES = 4
#: Hashes a block holds at two or three false alarms in a hundred.
FULL = 53
LEAST_BLOCKS = 4_096
#: Hashes of 64 characters that one broadcast carries.
SLICE_ROWS = 200_000


def blocks_for(hashes: int) -> int:
    """How many blocks a history of that size needs, with room to grow."""
    blocks = LEAST_BLOCKS
    while blocks * FULL < 4 * hashes:
        blocks *= 4
    return blocks


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _positions(key: str) -> list[Column]:
    second = F.xxhash64(key, F.lit(1))
    return [F.shiftright(second, 9 * probe).bitwiseAND(F.lit(BITS - 1)).cast("int") for probe in range(PROBES)]


def _or(word: str) -> Column:
    return F.bit_or(word).alias(word)


def bloom(hashes: DataFrame, blocks: int, key: str = "hash") -> DataFrame:
    """``(blocks, block, w0, ..., w7)``: the blocks that hold a hash, of a filter of ``blocks``."""
    placed = hashes.select(_block(key, blocks).alias("block"), F.explode(F.array(*_positions(key))).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at") % 64)
    split = placed.select(
        "block", *(F.when(F.shiftright("at", 6) == n, bit).otherwise(F.lit(0).cast("bigint")).alias(w) for n, w in enumerate(WORDS))
    )
    return split.groupBy("block").agg(*map(_or, WORDS)).select(F.lit(blocks).cast("bigint").alias("blocks"), "block", *WORDS)


def merged(filters: DataFrame) -> DataFrame:
    """Each block once, from the filters of several cycles."""
    return filters.groupBy("blocks", "block").agg(*map(_or, WORDS))


def perhaps_seen(df: DataFrame, filters: DataFrame, blocks: int, key: str = "hash") -> DataFrame:
    """``df`` with ``_perhaps``: false only where the key is surely not in the history."""
    known = filters.select(F.col("block").alias("_block"), F.array(*WORDS).alias("_words"))
    # A filter has at most ``blocks`` rows of 72 bytes: its size is known without a count.
    known = F.broadcast(known) if blocks <= BROADCAST_ROWS else known
    hit = F.col("_words").isNotNull()
    for at in _positions(key):
        word = F.get("_words", F.shiftright(at, 6))
        hit = hit & (F.call_function("shiftright", word, at % 64).bitwiseAND(F.lit(1)) == 1)
    joined = df.join(known, _block(key, blocks) == F.col("_block"), "left")
    return joined.select(*df.columns, F.coalesce(hit, F.lit(False)).alias("_perhaps"))


@dataclass(frozen=True)
class History:
    """Stored hashes (hexadecimal digests, as :func:`sentence_hash` makes them) and their filter."""

    hashes: DataFrame  # hash
    size: int  # how many, as counted
    filters: DataFrame | None = None  # block, w0, ..., w7; none needed up to SLICE_ROWS hashes
    blocks: int = 0

    def known(self, wanted: DataFrame, n: int) -> DataFrame:
        """Which of ``wanted(hash)``, a stored table of ``n`` rows, the history holds. The history is
        read where it lies: by ranges of the first four digits, each with its slice broadcast."""
        slices = -(-n // SLICE_ROWS)
        edges = [f"{0x10000 * i // slices:04x}" for i in range(slices)]
        found = None
        for low, high in zip(edges, [*edges[1:], "g"], strict=True):
            inside = (F.col("hash") >= low) & (F.col("hash") < high)
            part = self.hashes.where(inside).join(F.broadcast(wanted.where(inside)), "hash", "left_semi")
            found = part if found is None else found.unionByName(part)
        return found

    def unseen(self, df: DataFrame, key: str = "hash") -> DataFrame:
        """Rows of ``df`` whose hash is not in the history. ``df`` is evaluated once, and stored; a
        history counted to fit one broadcast is sent to ``df`` instead."""
        if self.filters is None:
            seen = self.hashes.select(F.col("hash").alias("_known"))
            seen = F.broadcast(seen) if self.size <= SLICE_ROWS else seen
            return df.join(seen, F.col(key) == F.col("_known"), "left_anti")
        told = store(perhaps_seen(df, self.filters, self.blocks, key))
        doubtful = told.where("_perhaps").select(F.col(key).alias("hash")).distinct()
        n = doubtful.count()
        rows = told.drop("_perhaps")
        if n == 0:
            return rows
        known = store(self.known(doubtful, n)).withColumnRenamed("hash", "_known")
        # Those in doubt are few unless they are known: the join carries only them.
        new = told.where("NOT _perhaps").drop("_perhaps")
        left = told.where("_perhaps").drop("_perhaps").join(broadcast_if_small(known), F.col(key) == F.col("_known"), "left_anti")
        return new.unionByName(left)


def history(hashes: DataFrame) -> History:
    """The history of a stored table of hashes; where it is large, with a filter made now and stored."""
    hashes, size = hashes.select("hash"), hashes.count()
    if size <= SLICE_ROWS:
        return History(hashes, size)
    blocks = blocks_for(size)
    return History(hashes, size, store(bloom(hashes, blocks)), blocks)


def in_ranges(hashes: DataFrame) -> DataFrame:
    """Hashes sorted in ranges, as files of the history should hold them."""
    return hashes.select("hash").repartitionByRange("hash").sortWithinPartitions("hash")
