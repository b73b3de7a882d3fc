"""Small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 1 << 18
BLOCK_ROWS = 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row.

    A column that a lambda uses is otherwise inlined and evaluated for each element.
    """
    return F.transform(F.array(value), body)[0]


def give_back() -> None:
    """Return to the system what a worker holds after a task and no longer uses: workers are kept
    for further tasks, several beside each executor, and their allocators would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_blocks(
    frames: Iterator[pd.DataFrame], column: str, chars: int = BLOCK_CHARS, rows: int = BLOCK_ROWS
) -> Iterator[tuple[pd.DataFrame, list[str]]]:
    """Frames cut into runs of at most ``rows`` rows and about ``chars`` characters, each with its texts.

    A null text is empty. A longer text is a run of its own, never cut.
    """
    for frame in frames:
        texts = ["" if t is None else t for t in frame[column]]
        start = size = 0
        for at, text in enumerate(texts):
            if at > start and (size + len(text) > chars or at - start >= rows):
                yield frame.iloc[start:at], texts[start:at]
                start, size = at, 0
            size += len(text)
        if len(texts) > start:
            yield frame.iloc[start:], texts[start:]
    give_back()


def held_out(doc_id: str, of: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``part``; false without an id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(of)) == part, F.lit(False))


def in_ascii_lower(text: Column) -> Column:
    """A-Z to lower case and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())
