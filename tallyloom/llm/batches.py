"""Arrow batches in small parts, so that a worker holds the Python objects of a few rows at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

ROWS = 500


def sliced(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in order, at most ``rows`` at a time; an empty batch stays one."""
    for batch in batches:
        for a in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(a, rows)
