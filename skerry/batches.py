"""Arrow batches in ``mapInArrow``: whole key groups without one Python call a group."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def breaks(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Positions at which the key columns of a table sorted by them change (not 0, not the end)."""
    n = table.num_rows
    if n < 2:
        return np.empty(0, np.int64)
    new = np.zeros(n - 1, bool)
    for k in keys:
        col = table.column(k).combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks)
        new |= pc.not_equal(col.slice(1), col.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new) + 1


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 200_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of at least ``rows`` rows (but the last) that hold whole key groups, with the starts of the groups.

    The batches must come sorted by the keys, as from ``sortWithinPartitions``; keys hold no nulls. Memory is bounded by
    ``rows`` plus the largest group.
    """
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        at = breaks(t, keys)
        if at.size:
            cut = int(at[-1])
            yield t.slice(0, cut).combine_chunks(), np.concatenate([[0], at[:-1]])
            held = t.slice(cut).combine_chunks().to_batches()
            n -= cut
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, np.concatenate([[0], breaks(t, keys)]).astype(np.int64)


def floats(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def list_array(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, type=kind))
