"""Whole groups out of sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(table, bounds) pieces of a stream sorted by ``keys`` (non-null longs): every group whole, ``bounds`` its limits.

    Only the group that a batch leaves open is held back, so memory is one
    batch and one group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        if len(held) > 1 and all(held[0].column(k)[0].equals(batch.column(k)[batch.num_rows - 1]) for k in keys):
            continue  # the open group goes on
        bounds = _bounds(table, keys)
        if len(bounds) > 2:
            yield table.slice(0, bounds[-2]).combine_chunks(), bounds[:-1]
            held = table.slice(bounds[-2]).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _bounds(table, keys)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.concatenate([np.flatnonzero(change), [table.num_rows]])
