"""Stretches of rows that belong together, in sorted Arrow batches of a task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def same_as_before(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Whether each value equals the one before (False for the first, and beside a NULL)."""
    out = np.zeros(len(column), bool)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) > 1:
        out[1:] = pc.fill_null(pc.equal(column.slice(1), column.slice(0, len(column) - 1)), False).to_numpy(zero_copy_only=False)
    return out


def stretches(batches: Iterator[pa.RecordBatch], same: Sequence[str], copies: Sequence[str] = (), fresh: str | None = None) -> Iterator[tuple[pa.Table, np.ndarray, bool]]:
    """(rows, places where stretches begin, whether these are the last rows) of whole stretches of rows equal in ``same``.

    A row that equals the row before in all of ``copies`` is left out. A stretch also begins where ``fresh`` is true. Any number
    of whole stretches come together; the rows of an open stretch wait for its end, so a task holds its longest one.
    """
    waiting: list[pa.Table] = []
    before: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if not t.num_rows:
            continue
        ahead = 0 if before is None else 1
        seen = t if before is None else pa.concat_tables([before, t])
        if copies:
            copy = np.logical_and.reduce([same_as_before(seen[c]) for c in copies])
            if copy.any():
                copy[:ahead] = False
                seen = seen.filter(pa.array(~copy))
        together = np.logical_and.reduce([same_as_before(seen[c]) for c in same])
        if fresh is not None:
            together = together & ~seen[fresh].to_numpy()
        t, begins = seen.slice(ahead), np.flatnonzero(~together[ahead:])
        if not t.num_rows:
            continue
        before = t.slice(t.num_rows - 1)
        if not len(begins) or (len(begins) == 1 and begins[0] == 0 and not waiting):
            waiting.append(t)
            continue
        cut = int(begins[-1])
        whole = pa.concat_tables([*waiting, t.slice(0, cut)]).combine_chunks()
        if whole.num_rows:
            yield whole, np.unique(np.append(0, begins[:-1] + whole.num_rows - cut)), False
        waiting = [t.slice(cut)]
    if waiting:
        yield pa.concat_tables(waiting).combine_chunks(), np.zeros(1, np.int64), True
