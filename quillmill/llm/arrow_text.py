"""Arrow batches of texts in slices of bounded size, and their words as numbers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once, so memory does not follow the batch size.
SLICE_BYTES = 2_000_000


def slices(lengths: Iterable[int], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `most` bytes together, a longer row alone."""
    begin = total = 0
    end = 0
    for end, n in enumerate(lengths):
        if total and total + n > most:
            yield begin, end
            begin, total = end, 0
        total += n
    if total or begin == 0:
        yield begin, end + 1


def text_slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of a batch of two columns, in slices of bounded size."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
    bounds = [*slices(lengths)]
    if bounds[-1][1] < batch.num_rows:
        bounds.append((bounds[-1][1], batch.num_rows))
    for a, b in bounds:
        yield batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)


def numbered_words(texts: pa.Array, lines: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Lower-cased, blank-separated pieces of texts without nulls: the distinct
    pieces, each piece's number among them, and each text's bounds.  A line feed
    separates pieces; with `lines` it is a piece of its own."""
    low = pc.replace_substring(pc.utf8_lower(texts), "\n", " \n " if lines else " ")
    split = pc.split_pattern(low, " ")
    coded = split.values.dictionary_encode()
    first = split.offsets[0].as_py()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices), np.asarray(split.offsets) - first


def differs(column: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before it; the first one does."""
    out = np.ones(len(column), bool)
    if len(column) > 1:
        a, b = column.slice(1), column.slice(0, len(column) - 1)
        equal = pc.or_kleene(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        out[1:] = ~np.asarray(equal)
    return out


def released() -> None:
    """Gives memory that this process holds but does not use back to the machine: workers are used again by later
    tasks, and what each kind of task has once needed would add up; so would what the driver has once fitted."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which the worker's unused memory is released."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            released()

    return whole
