"""Vector code compression (operator 13): product codes by exact k-means with exponion search.

Vectors become integers and are cut into equal parts; each part position has a
codebook.  In every round a part starts at the entry it had before.  An entry that
is at least as near as that one, at the squared distance U, lies within twice the
distance of it: its squared distance to the entry is at most 4 U.  So the entry's
neighbours, sorted by distance, are scanned up to that radius and no further, in
exact integers, with ties to the lower index.

A round is one pass: tasks assign their rows and give one sum for each entry, and
codebooks (parts x entries rows, whatever the input) are all that the driver sees.
Rows keep their entries from round to round; a lost block is assigned anew from
the codebooks of the rounds before, with the same result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.vectors import finite_vector

#: Whole numbers below this, in parts of at most this width, are computed with in 64 bits (a squared
#: distance times four stays below 2 ** 59); batches with larger ones in Python's.
NARROW, NARROW_WIDTH = 1 << 22, 1 << 11


def whole_numbers(blobs: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors as bytes of doubles, one row each, filled with zeros up to dims.
    The scale is a power of two, so the product is exact; 64-bit integers, or Python's where they could overflow."""
    sizes = [len(b) // 8 for b in (x.as_py() for x in blobs)] if len(blobs) else []
    if len(set(sizes)) == 1 and sizes[0] == dims:
        x = np.frombuffer(b"".join(b.as_py() for b in blobs), np.float64).reshape(len(sizes), dims)
    else:
        x = np.zeros((len(sizes), dims))
        for row, b in zip(x, blobs, strict=True):
            v = np.frombuffer(b.as_py(), np.float64)
            row[: len(v)] = v
    if not x.size or np.abs(x).max() < NARROW / scale and dims <= NARROW_WIDTH:
        return np.floor(x * scale).astype(np.int64)
    exact = [[math.floor(v * scale) if abs(v) < 2.0**53 else int(v) * scale for v in row] for row in x.tolist()]
    return np.array(exact, object).reshape(x.shape)


def neighbours(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry all entries, itself first, by (squared distance, index), and the distances."""
    gaps = ((book[:, None, :] - book[None, :, :]) ** 2).sum(2)
    order = np.array([sorted(range(len(book)), key=lambda j, a=a: (j != a, gaps[a, j], j)) for a in range(len(book))])
    return order, np.take_along_axis(gaps, order, 1)


def nearest(parts: np.ndarray, before: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row and its squared distance, by exponion search from the entry before."""
    if parts.dtype == object:
        book = book.astype(object)
    elif np.abs(book).max(initial=0) < NARROW:
        book = book.astype(np.int64)
    else:
        parts = parts.astype(object)
    order, gaps = neighbours(book)
    entry, least = before.copy(), np.zeros(len(parts), parts.dtype)
    for a in np.unique(before).tolist():
        rows = np.flatnonzero(before == a)
        start = ((parts[rows] - book[a]) ** 2).sum(1)
        by_radius = np.argsort(-start, kind="stable")
        rows, start = rows[by_radius], start[by_radius]
        best, at = start.copy(), np.full(len(rows), a)
        for j, gap in zip(order[a, 1:].tolist(), gaps[a, 1:].tolist(), strict=True):
            n = int((4 * start >= gap).sum())  # the radii fall along the rows, the gaps rise along the list
            if not n:
                break
            d = ((parts[rows[:n]] - book[j]) ** 2).sum(1)
            better = (d < best[:n]) | ((d == best[:n]) & (j < at[:n]))
            best[:n] = np.where(better, d, best[:n])
            at[:n] = np.where(better, j, at[:n])
        entry[rows], least[rows] = at, best
    return entry, least


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.uint8).reshape(len(column), parts)


def compress(
    vectors: DataFrame, *, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, list[np.ndarray]]:
    """(rows, codebooks): rows with id_col, label_col, codes binary (a byte for each part) and
    error long; codebooks one array of whole numbers (entries x width) for each part.

    Vectors that are null or hold null or non-finite components are dropped.
    Codebooks start as the vectors of the smallest ids, of repeated ids the
    smallest vector; fewer ids give fewer entries.  Rows with a null id are coded
    but start no entry, so a table of nothing else gives no rows.  A vector shorter than the
    longest one, or not a multiple of `parts` long, is filled with zeros.  An error that
    no long holds is null.  Extra columns are ignored; empty tables give no rows and no entries.
    entries: at most 256.
    """
    id_type, label_type = (vectors.schema[c].dataType.simpleString() for c in (id_col, label_col))
    doubles = F.col(vector_col).cast("array<double>")
    usable = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), doubles.alias("v")).where(finite_vector(F.col("v")))
    longest = usable.agg(F.max(F.size("v"))).first()[0]
    width = max(1, math.ceil((longest or 0) / parts))
    seeds = usable.where(F.col("id").isNotNull()).select("id").distinct().orderBy("id").limit(entries)
    starts = usable.join(F.broadcast(seeds), "id").groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect()  # `entries` rows
    first = pa.array([np.asarray(r["v"], np.float64).tobytes() for r in starts], pa.binary())
    whole = whole_numbers(first, parts * width, scale).reshape(-1, parts, width)
    books = [whole[:, p] for p in range(parts)]
    if not starts:
        none = vectors.sparkSession.createDataFrame([], f"`{id_col}` {id_type}, `{label_col}` {label_type}, codes binary, error bigint")
        return none, books

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [np.asarray(v.values, np.float64).tobytes() for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary()), pa.array([bytes(parts)] * len(blobs), pa.binary())], ["id", "label", "blob", "codes"])

    def assign(batches: Iterator[pa.RecordBatch], known: list[np.ndarray]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            if batch.num_rows:
                cut = whole_numbers(batch.column(2), parts * width, scale).reshape(batch.num_rows, parts, width)
                found = [nearest(cut[:, p], before, book) for p, (before, book) in enumerate(zip(_codes(batch.column(3), parts).T, known, strict=True))]
                yield batch, cut, np.stack([f[0] for f in found], 1), sum(f[1] if cut.dtype != object and width * parts <= NARROW_WIDTH else f[1].astype(object) for f in found)

    def moved(known: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, _, codes, _ in assign(batches, known):
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary())], batch.schema.names)

        return run

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's sums, as decimal text: they are exact whatever the size."""
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), object)
        for batch in batches:
            cut, codes = whole_numbers(batch.column(2), parts * width, scale).reshape(batch.num_rows, parts, width), _codes(batch.column(3), parts)
            for p in range(parts):
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                own = np.zeros((entries, width), cut.dtype)
                np.add.at(own, codes[:, p], cut[:, p])
                sums[p] += own
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(counts[p, e]), pa.array([",".join(map(str, s)) for s in sums[p, e]], pa.string())], ["part", "entry", "n", "sums"])

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        added = [sum(column) for column in zip(*([int(x) for x in s.split(",")] for s in rows["sums"]), strict=True)]
        return pd.DataFrame({"part": rows["part"].iloc[:1], "entry": rows["entry"].iloc[:1], "n": [int(rows["n"].sum())], "sums": [",".join(map(str, added))]})

    shape = f"id {id_type}, label {label_type}, blob binary, codes binary"
    sums = "part bigint, entry bigint, n bigint, sums string"
    state = usable.mapInArrow(pack, shape)
    held = None
    for _ in range(rounds):
        state = state.mapInArrow(moved([*books]), shape).persist(StorageLevel.MEMORY_AND_DISK)
        found = state.mapInArrow(summed, sums).groupBy("part", "entry").applyInPandas(total, sums).collect()  # parts x entries rows
        books = [b.astype(object) for b in books]
        for r in found:
            books[r["part"]][r["entry"]] = [int(x) // r["n"] for x in r["sums"].split(",")]
        if held is not None:
            held.unpersist()
        held = state
    final = [*books]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, codes, errors in assign(batches, final):
            fits = [int(x) if x < 1 << 63 else None for x in errors]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary()), pa.array(fits, pa.int64())], [id_col, label_col, "codes", "error"])

    return state.mapInArrow(coded, f"`{id_col}` {id_type}, `{label_col}` {label_type}, codes binary, error bigint"), final


def codebooks_digest(books: list[np.ndarray]) -> str:
    """sha256 of all entries' components by part, entry and position, as decimal text with commas."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for entry in book for x in entry).encode()).hexdigest()


def decode(codes: bytes, books: list[np.ndarray]) -> list[int]:
    """The whole numbers that a code stands for, filling zeros included."""
    return [int(x) for c, book in zip(codes, books, strict=True) for x in book[c]]
