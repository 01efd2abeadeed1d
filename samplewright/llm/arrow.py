"""Helpers for operators that take Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute

#: Text bytes that are turned into Python objects at once.
PIECE_BYTES = 4 << 20
PIECE_ROWS = 2048


def pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a piece has few rows and, unless one text is longer, few bytes."""
    for batch in batches:
        lengths = batch.column(text)
        if len(batch) == 0:
            continue
        sizes = [0 if x is None else x for x in pa.compute.binary_length(lengths).to_pylist()]
        start = total = 0
        for k, size in enumerate(sizes):
            if k > start and (total + size > PIECE_BYTES or k - start >= PIECE_ROWS):
                yield batch.slice(start, k - start)
                start, total = k, 0
            total += size
        yield batch.slice(start)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()
