"""Text files to token rows or packed blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.tokens import (
    BYTE_TOKENIZERS,
    Tokenizer,
    attention_mask,
    byte_tokens,
    ids_of_bytes,
    truncate_tokens,
)
from millrace.operators.ordering import index_by_file, index_lines, index_read
from millrace.operators.packing import BATCH_ROWS, pack_blocks
from millrace.sources.files import read_dataset, read_text_column, reader_options, text_column

MIN_SEQ_LEN = 16


def _check(df: DataFrame, seq_len: int, pack: bool) -> None:
    if df.isStreaming and pack:
        raise ValueError("packing needs all rows of a batch; it is not available on a stream")
    if seq_len < MIN_SEQ_LEN:
        raise ValueError(f"seq_len must be at least {MIN_SEQ_LEN}")


def tokenize(df: DataFrame, tokenizer: Tokenizer = byte_tokens, on_null: str = "error") -> DataFrame:
    """``text`` replaced by ``input_ids``, whole texts, no padding. Works on streams.

    A null text is an error; ``on_null="drop"`` leaves such rows out.
    """
    if on_null not in ("error", "drop"):
        raise ValueError("on_null is 'error' or 'drop'")
    rest = [c for c in df.columns if c != "text"]
    text = F.col("text")
    if on_null == "drop":
        df = df.where(text.isNotNull())
    else:
        text = F.coalesce(text, F.raise_error(F.lit("null text")).cast("string"))
    return df.select(*rest, tokenizer(text).alias("input_ids"))


def truncated(
    df: DataFrame, seq_len: int, tokenizer: Tokenizer = byte_tokens, on_null: str = "error"
) -> DataFrame:
    """Token rows of at most ``seq_len`` ids with their mask. Works on streams.

    A tokenizer that adds special tokens has to be built with ``max_length``,
    so that it can make room for them. For byte tokens a text is cut before it is turned to ids.
    """
    if tokenizer in BYTE_TOKENIZERS:
        df = df.withColumn("text", F.substring("text", 1, seq_len))
    ids = tokenize(df, tokenizer, on_null)
    rest = [c for c in ids.columns if c != "input_ids"]
    return ids.select(*rest, truncate_tokens(F.col("input_ids"), seq_len).alias("input_ids")).withColumn(
        "attention_mask", attention_mask(F.col("input_ids"))
    )


def tokenize_dataset(
    df: DataFrame,
    seq_len: int,
    pack: bool,
    tokenizer: Tokenizer = byte_tokens,
    on_null: str = "error",
    batch_rows: int = BATCH_ROWS,
    shards: int = 1,
    total: int | None = None,
) -> DataFrame:
    """Packed blocks of ``(row_idx, text)`` or truncated rows of ``(text)``."""
    _check(df, seq_len, pack)
    if not pack:
        return truncated(df, seq_len, tokenizer, on_null)
    if shards > 1 and total is None:
        total = df.count()
    if tokenizer is not byte_tokens:
        return pack_blocks(tokenize(df, tokenizer, on_null), seq_len, batch_rows, shards, total)
    # Bytes are shuffled as they are, a quarter of what their ids take, and become ids in the blocks.
    octets = tokenize(df, lambda text: F.encode(text, "UTF-8"), on_null)
    blocks = pack_blocks(octets, seq_len, batch_rows, shards, total)
    return blocks.withColumn("input_ids", ids_of_bytes(F.col("input_ids")))


def build_corpus(
    spark: SparkSession,
    path: str,
    file_type: str = "jsonl",
    column: str = "text",
    seq_len: int = 512,
    pack: bool = True,
    tokenizer: Tokenizer = byte_tokens,
    on_null: str = "error",
    batch_rows: int = BATCH_ROWS,
    shards: int = 1,
) -> DataFrame:
    """Load, reduce to the text column, tokenize, then pack or truncate.

    Rows are numbered in file order, where they lie: Parquet knows the place of a row in its file;
    for other types the rows of each split are counted first.
    """
    if not pack:
        rows = read_text_column(spark, path, file_type, column)
        return tokenize_dataset(rows, seq_len, False, tokenizer, on_null)
    if file_type == "parquet" and on_null == "error":
        options = reader_options(spark, path, file_type)
        indexed = index_by_file(spark, path, **options)
        rows = text_column(indexed, column, keep=("row_idx",))
    else:
        rows = read_text_column(spark, path, file_type, column, order="_order", drop_null=on_null == "drop")
        rows = index_lines(rows, "_order")
    return tokenize_dataset(rows, seq_len, True, tokenizer, on_null, batch_rows, shards)


def build_from_dataset(
    spark: SparkSession,
    root: str,
    dataset: str,
    subset: str | None = None,
    split: str = "train",
    column: str = "text",
    seq_len: int = 512,
    pack: bool = True,
    streaming: bool = False,
    keep: tuple[str, ...] = (),
    tokenizer: Tokenizer = byte_tokens,
    on_null: str = "error",
    batch_rows: int = BATCH_ROWS,
    shards: int = 1,
) -> DataFrame:
    """:func:`build_corpus` from a named dataset (see :func:`read_dataset`), or on its stream.

    A stream cannot be packed. ``keep`` names columns that truncated rows carry along.
    """
    rows = read_dataset(spark, root, dataset, subset, split, streaming)
    _check(rows, seq_len, pack)
    if not pack:
        return tokenize_dataset(text_column(rows, column, keep), seq_len, False, tokenizer, on_null)
    if on_null == "drop":
        rows = rows.where(F.col(f"`{column}`").isNotNull())
    rows = text_column(index_read(rows), column, keep=("row_idx",))
    return tokenize_dataset(rows, seq_len, True, tokenizer, on_null, batch_rows, shards)
