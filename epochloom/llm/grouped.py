"""Groups of rows that lie together in sorted batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches in which equal keys are neighbours; a batch's end cuts no group."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table.column(k).to_numpy() for k in keys]
        changes = np.zeros(len(table) - 1, dtype=bool)
        for c in columns:
            changes |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(changes) + 1).tolist(), len(table)]
        for low, high in zip(edges, edges[1:]):
            key = tuple(c[low] for c in columns)
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(low, high - low))
            last = key
    if held:
        yield pa.concat_tables(held)
