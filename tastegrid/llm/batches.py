"""Arrow batches in parts, so no task holds the texts of a whole batch as Python strings or sends them back at once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

AT_ONCE = 256


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``AT_ONCE`` in a batch, without a copy."""
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(start, AT_ONCE)


def column_values(column: pa.Array) -> Iterator:
    """The values of a column, ``AT_ONCE`` of them as Python objects at a time."""
    for start in range(0, len(column), AT_ONCE):
        yield from column.slice(start, AT_ONCE).to_pylist()
