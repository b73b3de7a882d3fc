"""Revisit gate as a stateful operator: one number of state per key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from millrace.operators.visits import admit_run


def earliest_a_second(
    key: str, time: str, order: str
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow batches reduced to the earliest row of each key and second. At most one can pass the
    gate, so a key with a third of all events sends on one row a second from each batch."""
    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows.take(pc.sort_indices(rows, [(key, "ascending"), (time, "ascending"), (order, "ascending")]))
            n, first = rows.num_rows, np.ones(rows.num_rows, bool)
            if n > 1:
                same = [pc.equal(rows.column(c).slice(1), rows.column(c).slice(0, n - 1)) for c in (key, time)]
                first[1:] = ~pc.fill_null(pc.and_(*same), False).to_numpy()
            yield from rows.filter(pa.array(first)).combine_chunks().to_batches()

    return reduced


class _Gate(StatefulProcessor):
    """The time last admitted of each key, in a value state."""

    def __init__(self, columns: list[str], time: str, order: str, every: int) -> None:
        self.columns, self.time, self.order, self.every = columns, time, order, every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_admitted", StructType([StructField("sec", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        firsts = None
        for chunk in rows:
            both = chunk if firsts is None else pd.concat([firsts, chunk])
            firsts = both.sort_values([self.time, self.order]).drop_duplicates(self.time)
        before = self.last.get()
        times = firsts[self.time].to_numpy()
        picked, last = admit_run(times, self.every, None if before is None else before[0])
        if picked:
            self.last.update((last,))
        yield firsts.iloc[picked][self.columns]

    def close(self) -> None:
        pass


def revisit_gate_stream(events: DataFrame, key: str, time: str, order: str, every: int) -> DataFrame:
    """Admitted events of a stream, ``time`` in whole seconds and rising from one
    micro-batch to the next; ``order`` ranks events of one second. Events without a key never pass.

    Tasks reduce a key to one event a second before the shuffle; the group of a key then holds no
    more than the seconds it spans, times the batches it came in. The state is one number a key, in
    RocksDB, which :func:`millrace.streaming.runs.start_files` sets.
    """
    known = events.where(events[key].isNotNull())
    if every <= 0:
        return known
    firsts = known.mapInArrow(earliest_a_second(key, time, order), events.schema)
    return firsts.groupBy(key).transformWithStateInPandas(
        _Gate(events.columns, time, order, every), events.schema, "append", "none"
    )
