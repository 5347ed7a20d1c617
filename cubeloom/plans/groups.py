"""Groups of a sorted stream of Arrow batches, one at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _changes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Rows that differ from the one before in any key; nulls are equal to each other."""
    n = batch.num_rows
    out = np.zeros(max(n - 1, 0), bool)
    for key in keys:
        column = batch.column(key)
        a, b = column.slice(1), column.slice(0, n - 1)
        differ = pc.fill_null(pc.not_equal(a, b), False)
        lone = pc.not_equal(pc.is_null(a), pc.is_null(b))
        out |= pc.or_(differ, lone).to_numpy(zero_copy_only=False)
    return np.flatnonzero(out) + 1


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table per group of neighbouring rows with equal keys; only the unfinished group is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        first = [batch.column(k)[0].as_py() for k in keys]
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *_changes(batch, keys).tolist(), batch.num_rows]
        for start, stop in zip(cuts[:-2], cuts[1:-1]):
            yield pa.Table.from_batches([*held, batch.slice(start, stop - start)])
            held = []
        held.append(batch.slice(cuts[-2]))
        last = [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]
    if held:
        yield pa.Table.from_batches(held)
