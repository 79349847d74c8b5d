"""Arrow batches in the tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

#: Rows that a task turns into Python objects at a time.
ROWS = 256


def small(batches: Iterable[pa.Array], rows: int = ROWS) -> Iterator[pa.Array]:
    """The same rows in shorter batches: what a task holds besides its input does not follow Spark's batch size."""
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.slice(first, rows)
