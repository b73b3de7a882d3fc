"""Order columns packed into one number.

An aggregate whose buffer has a fixed width runs as a hash aggregate; one that holds a struct of
order columns has to sort its rows first, texts and all. Whole numbers of any width become codes
(0 for null, which sorts first), and the codes digits of one ``decimal(38, 0)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def _bits(df: DataFrame, order: Sequence[str]) -> list[int | None]:
    return [_BITS.get(df.schema[c].dataType.simpleString()) for c in order]


def can_pack(df: DataFrame, order: Sequence[str]) -> bool:
    """Whether the columns are whole numbers that fit one decimal, as a bigint and an int do."""
    codes = 1
    for bits in _bits(df, order):
        if bits is None:
            return False
        codes *= 2**bits + 1
    return codes < 10**38


def _number(value: int, digits: int) -> Column:
    return F.lit(str(value)).cast(f"decimal({digits},0)")


def pack(df: DataFrame, order: Sequence[str]) -> Column:
    """One number that sorts as the columns do, ascending, nulls first."""
    whole = None
    for name, bits in zip(order, _bits(df, order), strict=True):
        code = F.coalesce(F.col(name).cast("decimal(20,0)") + _number(2 ** (bits - 1) + 1, 20), _number(0, 20))
        whole = code if whole is None else whole * _number(2**bits + 1, len(str(2**bits + 1))) + code
    return whole.cast("decimal(38,0)")


def unpack(packed: str, df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The columns that :func:`pack` made into column ``packed``."""
    rest, columns = F.col(packed), []
    for name, bits in reversed(list(zip(order, _bits(df, order), strict=True))):
        size = _number(2**bits + 1, len(str(2**bits + 1)))
        code = F.pmod(rest, size).cast("decimal(20,0)")
        value = F.when(code > 0, (code - _number(2 ** (bits - 1) + 1, 20)).cast(df.schema[name].dataType))
        columns.append(value.alias(name))
        rest = ((rest - code) / size).cast("decimal(38,0)")
    return columns[::-1]
