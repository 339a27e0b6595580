"""Whole key groups inside tasks, without a Python call per small group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def map_groups(df: DataFrame, key: str, fn: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` of all rows of each value of ``key`` (a long); groups must fit in a task's memory."""
    at = df.columns.index(key)

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            keys = b.column(at).to_numpy()
            if not len(keys):
                continue
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for x, y in zip(cuts, cuts[1:]):
                part = b.slice(x, y - x)
                if held and held[0].column(at)[0].as_py() != keys[x]:
                    out = fn(pa.Table.from_batches(held))
                    held = []
                    if out is not None:
                        yield out
                held.append(part)
        if held:
            out = fn(pa.Table.from_batches(held))
            if out is not None:
                yield out

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)
