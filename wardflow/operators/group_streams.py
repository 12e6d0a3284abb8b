"""Own functions of whole groups, which come as a stream of ordered batches.

The module is sent to executors by value.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GroupFunction = Callable[[tuple, Iterator[pd.DataFrame]], "Iterator[pd.DataFrame] | pd.DataFrame"]


class _Stream:
    """Batches of one task, cut where a group begins."""

    def __init__(self, batches: Iterator[pa.RecordBatch], number: str):
        self.batches, self.number, self.ahead = iter(batches), number, None

    def _next(self) -> pa.RecordBatch | None:
        """What is left of the current batch, or the next one with rows."""
        while self.ahead is None or not self.ahead.num_rows:
            self.ahead = next(self.batches, None)
            if self.ahead is None:
                return None
        return self.ahead

    def group(self, first: bool = True) -> Iterator[pa.RecordBatch]:
        """The batches of the group that begins with the next row."""
        while (batch := self._next()) is not None:
            begins = np.flatnonzero(batch.column(batch.schema.get_field_index(self.number)).to_numpy() == 1)
            begins = begins[begins > 0] if first else begins
            stop = int(begins[0]) if len(begins) else batch.num_rows
            self.ahead = batch.slice(stop)
            if stop:
                yield batch.slice(0, stop).drop_columns([self.number])
            if len(begins):
                return
            first = False


def over_groups(fn: GroupFunction, by: list[str], number: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(batches, number)
        while (head := stream._next()) is not None:
            key = tuple(head.column(head.schema.get_field_index(c))[0].as_py() for c in by)
            rows = (b.drop_columns(by).to_pandas() for b in stream.group())
            made = fn(key, rows)
            for out in [made] if isinstance(made, pd.DataFrame) else made:
                table = pa.Table.from_pandas(out, schema=pa.schema([f for f in schema if f.name not in by]), preserve_index=False)
                for i, c in enumerate(by):
                    table = table.add_column(i, c, pa.array([key[i]] * len(out), schema.field(c).type))
                yield from table.to_batches()
            for _ in rows:  # what the function left unread
                pass

    return run
