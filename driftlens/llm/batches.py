"""Arrow batches in small pieces, so that few texts exist as Python objects at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

ROWS = 500


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, at most ``rows`` in a batch; batches without rows are left out."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
