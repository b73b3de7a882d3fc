"""Exact deduplication: the first occurrence wins, within and across runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import sentence_hash
from millrace.operators.history import History
from millrace.operators.packed import can_pack, pack, unpack


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that comes first in ``order``, which has to be total.

    An aggregate rather than ``dropDuplicates``, whose survivor is arbitrary;
    its partial step leaves one row per key and task before the shuffle, so a
    key that fills a third of the table is no hot partition.

    Where keys and whole-number order columns are all there is, the order is packed into one
    number and the aggregate hashes. With other columns the first row's values have to be carried,
    which sorts; pass narrow rows and join those columns back on the order where that is cheaper.
    Columns that ``order`` names are carried once, others beside it.
    """
    rest = [c for c in df.columns if c not in keys]
    places = [c for c in dict.fromkeys(order) if c not in keys]
    if rest and set(rest) == set(places):
        if can_pack(df, places):
            firsts = df.groupBy(*keys).agg(F.min(pack(df, places)).alias("_first"))
            return firsts.select(*keys, *unpack("_first", df, places)).select(df.columns)
        first = F.min(F.struct(*places))
    else:
        first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*").select(df.columns)


def not_seen(df: DataFrame, seen: DataFrame | History, key: str = "hash") -> DataFrame:
    """Rows whose key is not in ``seen`` yet: a table, which a join shuffles, or a
    :class:`History`, which is read where it lies."""
    if isinstance(seen, History):
        return seen.unseen(df, key)
    return df.join(seen.select(key), key, "left_anti")


def save_hashes(hashes: DataFrame, table: str, buckets: int) -> None:
    """Append ``hash`` to a bucketed table.

    With as many buckets as shuffle partitions, :func:`not_seen` reads the
    table where it lies: the history is never shuffled, only what is new.
    """
    writer = hashes.select("hash").write.bucketBy(buckets, "hash").sortBy("hash")
    writer.mode("append").saveAsTable(table)


def with_hash(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the ``hash`` of its sentences."""
    return df.withColumn("hash", sentence_hash(F.col(text)))


def first_sentences(
    df: DataFrame, order: Sequence[str], seen: DataFrame | History | None = None, text: str = "text"
) -> DataFrame:
    """First occurrence of each sentence with its ``hash``, less those in ``seen(hash)``.

    Equal text is equal hash, so without a table ``seen`` the text itself is the key
    and only what is kept gets hashed. With a table the hash is the key, and
    the anti join reuses the partitions the aggregate made.
    """
    if seen is None or isinstance(seen, History):
        firsts = with_hash(first_by_key(df, [text], order), text)
        return firsts if seen is None else not_seen(firsts, seen)
    return not_seen(first_by_key(with_hash(df, text), ["hash"], order), seen)
