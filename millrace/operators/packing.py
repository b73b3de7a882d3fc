"""Token rows to training input: fixed-length blocks, padded batches, training order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from millrace.functions.tokens import attention_mask
from millrace.operators.permute import permuted

BATCH_ROWS = 1000
IGNORED_LABEL = -100


def _div(value: Column, by: int) -> Column:
    """Whole-number division."""
    return F.call_function("div", value, F.lit(by))


def _shard(row: Column, shards: int, total: int | None) -> tuple[Column, Column]:
    """Shard of a row, and its place inside, for contiguous shards of nearly equal size."""
    if shards == 1:
        return F.lit(0), row
    if total is None:
        raise ValueError("more than one shard needs the total number of rows")
    size, longer = divmod(total, min(shards, max(total, 1)))
    split = longer * (size + 1)  # the first ``longer`` shards hold one row more
    in_long = row < split
    shard = F.when(in_long, _div(row, size + 1)).otherwise(
        longer + _div(row - split, max(size, 1))
    )
    place = F.when(in_long, row % (size + 1)).otherwise((row - split) % max(size, 1))
    return shard.cast("int"), place


def pack_blocks(
    df: DataFrame,
    seq_len: int,
    batch_rows: int = BATCH_ROWS,
    shards: int = 1,
    total: int | None = None,
    row_idx: str = "row_idx",
) -> DataFrame:
    """Blocks of exactly ``seq_len`` ids from ``(row_idx, input_ids)``, or of bytes if those are binary.

    Rows are joined end to end inside each batch of ``batch_rows`` (counted
    from the start of the shard) with nothing between them, and what is left
    over at the end of a batch is dropped. Rows without ids still count.

    The rows are shuffled once, by batch. A row is cut into one piece per block
    it touches; tokens are never exploded.
    """
    shard, place = _shard(F.col(row_idx), shards, total)
    batch = _div(place, batch_rows)
    binary = isinstance(df.schema["input_ids"].dataType, BinaryType)
    size = F.octet_length if binary else F.size
    placed = df.select(
        F.col(row_idx).alias("_row"),
        shard.alias("shard"),
        batch.alias("batch_id"),
        F.col("input_ids").alias("_ids"),
        size(F.col("input_ids")).cast("bigint").alias("_n"),
    )
    before = Window.partitionBy("shard", "batch_id").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).where("_n > 0")
    start, end = F.col("_start"), F.col("_start") + F.col("_n")

    def piece(block: Column) -> Column:
        begin = F.greatest(start, block * seq_len)
        length = F.least(end, (block + 1) * seq_len) - begin
        first, many = (begin - start + 1).cast("int"), length.cast("int")
        ids = F.col("_ids").substr(first, many) if binary else F.slice("_ids", first, many)
        return F.struct(block.alias("block_id"), ids.alias("ids"))

    touched = F.sequence(_div(start, seq_len), _div(end - 1, seq_len))
    pieces = offset.select(
        "shard", "batch_id", "_row", F.explode(F.transform(touched, piece)).alias("_piece")
    )
    blocks = pieces.groupBy("shard", "batch_id", F.col("_piece.block_id").alias("block_id")).agg(
        F.array_sort(F.collect_list(F.struct("_row", "_piece.ids"))).alias("_pieces"),
        F.sum(size(F.col("_piece.ids"))).alias("_length"),
    )
    parts = F.col("_pieces.ids")
    joined = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part)) if binary else F.flatten(parts)
    return blocks.where(F.col("_length") == seq_len).select(
        "shard",
        "batch_id",
        "block_id",
        joined.alias("input_ids"),
        F.array_repeat(F.lit(1).cast("tinyint"), seq_len).alias("attention_mask"),
    )


def collate(df: DataFrame, batch_size: int, pad_id: int, row_idx: str = "row_idx") -> DataFrame:
    """Rows padded to the longest of their batch, with mask and labels.

    Labels repeat the ids with every ``pad_id`` ignored, also one that is a
    real token (as when padding falls back to the end-of-text token).
    """
    batch = _div(F.col(row_idx), batch_size)
    sized = df.select(F.col(row_idx), batch.alias("batch_id"), F.col("input_ids").alias("_ids"))
    widest = F.max(F.size("_ids")).over(Window.partitionBy("batch_id"))
    padded = sized.withColumn("_pad", widest - F.size("_ids")).select(
        "batch_id",
        row_idx,
        F.concat("_ids", F.array_repeat(F.lit(pad_id), F.col("_pad"))).alias("input_ids"),
        F.concat(
            attention_mask(F.col("_ids")),
            F.array_repeat(F.lit(0).cast("tinyint"), F.col("_pad")),
        ).alias("attention_mask"),
    )
    labels = F.transform(
        "input_ids", lambda i: F.when(i == pad_id, F.lit(IGNORED_LABEL)).otherwise(i)
    )
    return padded.withColumn("labels", labels)


def training_order(
    df: DataFrame, row_idx: str, seed: int, examples: int, rows: int | None = None
) -> DataFrame:
    """The first ``examples`` rows in an order set by ``seed``, epoch after epoch.

    Each epoch holds every row once, in an order of its own: a permutation of the dense row numbers
    ``row_idx`` (from 0). A row's place follows from its number alone, so the last epoch is cut by
    a comparison; nothing is sorted, ranked or shuffled. ``rows`` is the row count, if known.
    Returned columns: those of ``df``, ``epoch`` and ``feed_key``, the place in the epoch.
    """
    rows = df.count() if rows is None else rows
    epochs = -(-examples // rows) if rows else 0
    if epochs == 0:
        return df.limit(0).withColumns({"epoch": F.lit(0), "feed_key": F.lit(0).cast("bigint")})
    repeated = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    keyed = repeated.withColumn("feed_key", permuted(F.col(row_idx), rows, seed, F.col("epoch")))
    left = examples - rows * (epochs - 1)
    return keyed if left == rows else keyed.where((F.col("epoch") < epochs - 1) | (F.col("feed_key") < left))
