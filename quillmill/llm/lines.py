"""Line dedup (operator 12): keep bitmaps instead of text.

The keys of all lines become 128-bit hashes.  These are range-partitioned by hash
and document and sorted by (hash, document, position), so that a task streams
through runs of equal keys in which first occurrences come first.  A very common
line is a run that spans several partitions: each of them tells the head of its
part and how many documents that part holds, at most two short rows a run's end,
and these are added up.  No text is moved; what comes back is a bit for each line.

Null and empty texts are one empty line.  Rows with one id are one document where
documents are counted (null is an id too); rows equal in id and text share a
bitmap.  Extra columns play no part.  Empty tables give empty tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.arrow_text import differs
from quillmill.llm.durable import durable

#: What is stripped at the ends of a line's key.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Kinds of rows that a task tells of its runs.
DROP, PENDING, HEAD = 0, 1, 2


def line_key(line: Column) -> Column:
    """A line without blanks at both ends, A to Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text (null: empty) and mark, a hash of the text that tells rows of one id apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("mark", F.xxhash64("text"))


class RunStream:
    """Rows (h1, h2, id, mark, pos) in sorted order, a batch at a time, as rows (kind, ..., n).

    Held between batches: the rows of the last run while it has fewer than `least`
    documents, else only its first row.
    """

    def __init__(self, least: int, keep_first: bool) -> None:
        self.least, self.keep_first = least, keep_first
        self.open: pa.RecordBatch | None = None  # the last run while it is undecided
        self.head: pa.RecordBatch | None = None  # the first row of the last run once it has enough documents
        self.first = True  # whether the last run is the partition's first

    def _told(self, rows: pa.RecordBatch, kind: int, n: int = 0) -> Iterator[pa.RecordBatch]:
        if rows.num_rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows.num_rows, kind, np.int32)), *rows.columns, pa.array(np.full(rows.num_rows, n, np.int64))], ["kind", *rows.schema.names, "n"]
            )

    def _at_an_end(self, run: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """A whole run at an end of the partition.  It may go on in the next partition, so its head and its count are told."""
        n = int(differs(run.column("id")).sum())
        yield from self._told(run.slice(0, 1), HEAD, n)
        if n >= self.least:
            yield from self._told(run.slice(int(self.keep_first)), DROP)
        else:
            yield from self._told(run.slice(1), PENDING)

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not batch.num_rows:
            return
        if self.head is not None:  # is it more of a run that is known to go?
            same = np.logical_and(*(np.asarray(batch.column(h)) == self.head.column(h)[0].as_py() for h in ("h1", "h2")))
            n = batch.num_rows if same.all() else int(same.argmin())
            yield from self._told(batch.slice(0, n), DROP)
            batch = batch.slice(n)
            if not batch.num_rows:
                return
            if self.first:
                yield from self._told(self.head, HEAD, self.least)
            self.head, self.first = None, False
        if self.open is not None:
            batch, self.open = pa.concat_batches([self.open, batch]), None
        starts = differs(batch.column("h1")) | differs(batch.column("h2"))
        if self.first and starts[1:].any():
            n = 1 + int(starts[1:].argmax())
            yield from self._at_an_end(batch.slice(0, n))
            batch, starts, self.first = batch.slice(n), starts[n:], False
        run = np.cumsum(starts) - 1
        goes = (np.bincount(run, weights=starts | differs(batch.column("id"))) >= self.least)[run]
        last = int(np.flatnonzero(starts)[-1])
        if goes[last]:
            self.head = batch.slice(last, 1)
        else:
            self.open = batch.slice(last)
        yield from self._told(batch.filter(pa.array(goes & ~starts if self.keep_first else goes)), DROP)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.head is not None:
            yield from self._told(self.head, HEAD, self.least)
        elif self.open is not None:
            yield from self._at_an_end(self.open)


def dropped_lines(docs: DataFrame, *, least_docs: int = 10, least_chars: int = 1, keep_first: bool = False, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, mark, pos: the lines (from 0) whose key has at least `least_chars` code points
    and stands in at least `least_docs` documents; with `keep_first` all but the first
    of each key, in the order of documents and positions.  A line may come twice."""
    named = _named(docs, id_col, text_col)
    lines = named.select("id", "mark", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).withColumn("key", line_key(F.col("line")))
    hashed = lines.where(F.length("key") >= least_chars).select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"), "id", "mark", "pos")
    hashed = durable(hashed)  # the range partitioner looks at its input twice
    order = ["h1", "h2", "id", "mark", "pos"]
    ordered = hashed.repartitionByRange("h1", "h2", "id").sortWithinPartitions(*order)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = RunStream(least_docs, keep_first)
        for batch in batches:
            yield from runs.add(batch)
        yield from runs.end()

    id_type = docs.schema[id_col].dataType.simpleString()
    told = durable(ordered.mapInArrow(stream, f"kind int, h1 bigint, h2 bigint, id {id_type}, mark bigint, pos int, n bigint"))
    heads = told.where(F.col("kind") == HEAD)  # at most two of a partition
    common = heads.groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.min(F.struct("id", "mark", "pos")).alias("first")).where(F.col("docs") >= least_docs)
    late = told.where(F.col("kind") != DROP).join(common, ["h1", "h2"])
    if keep_first:
        late = late.where((F.col("kind") == PENDING) | ~F.struct("id", "mark", "pos").eqNullSafe(F.col("first")))
    return told.where(F.col("kind") == DROP).select("id", "mark", "pos").unionByName(late.select("id", "mark", "pos"))


def keep_bitmaps(docs: DataFrame, *, least_docs: int = 10, least_chars: int = 1, keep_first: bool = False, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id_col, mark long (of the text), n_lines long, n_dropped long, keep binary: a bit for
    each line, 1 if it stays, packed and compressed; one row for each id and text.

    See `dropped_lines` for which lines go."""
    gone = dropped_lines(docs, least_docs=least_docs, least_chars=least_chars, keep_first=keep_first, text_col=text_col, id_col=id_col)
    gone = gone.groupBy(F.col("id").alias("gone_id"), F.col("mark").alias("gone_mark")).agg(F.collect_set("pos").alias("gone"))
    known = _named(docs, id_col, text_col).select("id", "mark", (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n_lines")).distinct()
    both = known.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("mark") == F.col("gone_mark")), "left").select("id", "mark", F.col("n_lines").cast("long"), "gone")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, dropped = [], []
            for n, gone in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
                bits = np.ones(n, bool)
                if gone.is_valid:
                    bits[np.asarray(gone.values)] = False
                maps.append(zlib.compress(np.packbits(bits).tobytes()))
                dropped.append(n - int(bits.sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())], [id_col, "mark", "n_lines", "n_dropped", "keep"])

    return both.mapInArrow(packed, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, mark bigint, n_lines bigint, n_dropped bigint, keep binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id_col, n_lines, n_dropped, text (the lines that stay, joined by line feeds); one row
    for each row of docs.  The only step that moves texts: once, to their bitmaps."""
    named = _named(docs, id_col, text_col)
    maps = bitmaps.select(F.col(id_col).alias("b_id"), F.col("mark").alias("b_mark"), "n_lines", "n_dropped", "keep")
    both = named.join(maps, F.col("id").eqNullSafe(F.col("b_id")) & (F.col("mark") == F.col("b_mark"))).select("id", "n_lines", "n_dropped", "keep", "text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for n, gone, keep, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True):
                whole = text.as_py()
                if gone:
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep.as_py()), np.uint8), count=n)
                    lines = whole.split("\n")
                    whole = "\n".join(lines[i] for i in np.flatnonzero(bits).tolist())
                texts.append(whole)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.string())], [id_col, "n_lines", "n_dropped", "text"])

    return both.mapInArrow(kept, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_lines bigint, n_dropped bigint, text string")
