"""What a cycle did, in one row. Rows are counted by the job that writes them."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

COUNT = "n"


@dataclass(frozen=True)
class CycleReport:
    """Pages processed (rejected ones too), sentences written, URLs still queued, seconds taken."""

    pages: int
    sentences_written: int
    queue: int
    elapsed: float

    as_dict = asdict


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a counter that holds its rows once an action has run: no pass of its own."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias(COUNT)), observation


def rows_seen(observation: Observation) -> int:
    """The rows a counter saw; waits for its action."""
    return observation.get[COUNT]
