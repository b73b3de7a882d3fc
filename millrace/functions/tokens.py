"""Token columns: UTF-8 bytes as ids, or ids from a tokenizer file."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

# A tokenizer file is shipped to every executor, so its size is checked first.
MAX_TOKENIZER_BYTES = 256 << 20

Tokenizer = Callable[[Column], Column]


def _byte_ids(texts: pa.Array) -> pa.Array:
    """The bytes of an Arrow string column, seen as lists of ids."""
    binary = texts.cast(pa.large_binary())
    count, start = len(binary), binary.offset
    _, offsets, data = binary.buffers()
    ends = pa.Array.from_buffers(pa.int64(), count + 1, [None, offsets], offset=start)
    first, last = ends[0].as_py(), ends[count].as_py()
    if last == first:
        ids = pa.array([], pa.int32())
    else:
        octets = pa.Array.from_buffers(pa.uint8(), last - first, [None, data], offset=first)
        ids = octets.cast(pa.int32())
    relative = pc.subtract(ends, first).cast(pa.int32())
    return pa.ListArray.from_arrays(relative, ids, mask=binary.is_null())


@F.arrow_udf(ArrayType(IntegerType()))
def _byte_tokens(texts: pa.Array) -> pa.Array:
    return _byte_ids(texts)


def byte_tokens(text: Column) -> Column:
    """Ids 0-255, one per UTF-8 byte, cut from the Arrow buffer without a loop."""
    return _byte_tokens(text)


def ids_of_bytes(octets: Column) -> Column:
    """The ids of a binary column."""
    return _byte_tokens(octets)


def byte_tokens_native(text: Column) -> Column:
    """The same ids with built-in functions only."""
    octets = F.split(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), "")
    return F.when(text == "", F.array().cast("array<int>")).otherwise(
        F.transform(octets, lambda c: F.ascii(c))
    )


#: Tokenizers of which every character gives an id at least: the first n ids lie in the first n characters.
BYTE_TOKENIZERS = (byte_tokens, byte_tokens_native)


def file_tokens(spark: SparkSession, tokenizer_json: str, max_length: int | None = None) -> Tokenizer:
    """Tokenizer from the JSON text of a ``tokenizers`` file.

    With ``max_length`` the tokenizer itself truncates, so that special tokens
    it adds are kept within the limit.
    """
    size = len(tokenizer_json.encode("utf-8"))
    if size > MAX_TOKENIZER_BYTES:
        raise ValueError(f"tokenizer file has {size} bytes, limit {MAX_TOKENIZER_BYTES}")
    shared = spark.sparkContext.broadcast(tokenizer_json)

    @F.pandas_udf("array<int>")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer as Model

        model = Model.from_str(shared.value)
        model.no_padding()
        if max_length is None:
            model.no_truncation()
        else:
            model.enable_truncation(max_length)
        for texts in batches:
            present = texts.dropna()
            ids = [e.ids for e in model.encode_batch(present.tolist())]
            yield pd.Series(ids, index=present.index, dtype=object).reindex(texts.index)

    return tokens


def read_tokenizer_file(spark: SparkSession, path: str) -> str:
    """Text of a tokenizer file on any file system Spark reads."""
    found = spark.read.format("binaryFile").load(path).select("length", "content")
    too_large = found.where(F.col("length") > MAX_TOKENIZER_BYTES).select("length").head()
    if too_large:
        raise ValueError(f"tokenizer file has {too_large.length} bytes, limit {MAX_TOKENIZER_BYTES}")
    return bytes(found.head().content).decode("utf-8")


def attention_mask(ids: Column) -> Column:
    """Ones, as many as there are ids."""
    return F.array_repeat(F.lit(1).cast("tinyint"), F.size(ids))


def truncate_tokens(ids: Column, seq_len: int) -> Column:
    """The first ``seq_len`` ids."""
    return F.slice(ids, 1, seq_len)


def full_length(ids: Column, seq_len: int) -> Column:
    """True where there are exactly ``seq_len`` ids."""
    return F.size(ids) == seq_len
