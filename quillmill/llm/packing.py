"""Packing token sequences by minimum bin slack (operator 1).

Each document's ids are cut into full windows; what is left over (shorter than
a window) waits in a buffer.  For each sequence, a bit set holds the totals
that the waiting lengths can make; the total closest to the capacity is traced
back to a multiset of lengths, and that multiset is used again as often as the
counts allow.  A gap that no multiset fills is closed by cutting one waiting
piece.  What is left at the end of a task, less than one sequence, is dealt to
sequences whose lengths are powers of two, which need no padding.

Every task packs the rows it reads on its own: there is no shuffle, no shared
state, and a task run again gives the same pieces under the same sequence ids
(the partition number in the high bits).  Memory is bounded by the buffer.

Defined results: a null or empty text is its closing id alone; a row with a
null id keeps it; repeated rows are packed each on its own; an empty table
gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.arrow_text import text_slices, tidy
from quillmill.llm.bpe import text_encoder

#: Ids (4 bytes each) that wait in a task before its buffer is packed.
BUFFER_IDS = 4_000_000
#: Bits for the number of a sequence within its partition.
SEQUENCE_BITS = 36


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths whose total is the largest of at most `room`.

    counts: how many pieces of each length there are.  Longer lengths come
    first; the search ends as soon as `room` itself can be made.
    """
    mask, made, steps = (1 << room + 1) - 1, 1, []
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length], room // length), 1
        while left > 0 and not made >> room & 1:
            step = min(step, left)
            more = made | made << length * step & mask
            if more != made:
                steps.append((length, step, made))
                made = more
            left -= step
            step *= 2
        if made >> room & 1:
            break
    total, picked = made.bit_length() - 1, defaultdict(int)
    for length, step, before in reversed(steps):
        if not before >> total & 1:
            picked[length] += step
            total -= length * step
    return dict(picked)


class Packer:
    """One task's sequences.  A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, capacity: int, partition: int):
        self.capacity, self.next = capacity, partition << SEQUENCE_BITS
        self.waiting: dict[int, list] = defaultdict(list)
        self.held = 0
        self.out: list[tuple] = []

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, tokens in pieces:
            self.out.append((doc, start, len(ids) // 4, ids, tokens, self.next, offset))
            offset += len(ids) // 4
        self.next += 1

    def _wait(self, piece: tuple) -> None:
        self.waiting[len(piece[2]) // 4].append(piece)
        self.held += len(piece[2]) // 4

    def add(self, doc, ids: bytes) -> None:
        step, tokens = 4 * self.capacity, len(ids) // 4
        whole = len(ids) - len(ids) % step
        for at in range(0, whole, step):
            self._sequence([(doc, at // 4, ids[at : at + step], tokens)])
        if whole < len(ids):
            self._wait((doc, whole // 4, ids[whole:], tokens))

    def _take(self, length: int) -> tuple:
        pieces = self.waiting[length]
        piece = pieces.pop()
        if not pieces:
            del self.waiting[length]
        self.held -= length
        return piece

    @staticmethod
    def _cut(piece: tuple, at: int) -> tuple[tuple, tuple]:
        doc, start, ids, tokens = piece
        return (doc, start, ids[: 4 * at], tokens), (doc, start + at, ids[4 * at :], tokens)

    def pack(self) -> None:
        """Fills sequences while a whole one is waiting."""
        while self.held >= self.capacity:
            longest = max(self.waiting)
            counts = {n: len(p) for n, p in self.waiting.items()}
            counts[longest] -= 1
            picked = fullest({n: c for n, c in counts.items() if c}, self.capacity - longest)
            picked[longest] = picked.get(longest, 0) + 1
            gap = self.capacity - sum(n * c for n, c in picked.items())
            times = 1 if gap else min(len(self.waiting[n]) // c for n, c in picked.items())  # a cut changes the counts
            for _ in range(times):
                pieces = [self._take(n) for n, c in picked.items() for _ in range(c)]
                if gap:  # each piece still waiting is longer than the gap, else it would have been picked
                    head, tail = self._cut(self._take(max(self.waiting)), gap)
                    pieces.append(head)
                    self._wait(tail)
                self._sequence(pieces)

    def finish(self) -> None:
        self.pack()
        rest = [p for n in sorted(self.waiting, reverse=True) for p in self.waiting[n]]
        self.waiting.clear()
        left, self.held = self.held, 0
        while left:
            room = 1 << left.bit_length() - 1
            left -= room
            pieces = []
            while room:
                piece = rest.pop(0)
                if len(piece[2]) // 4 > room:
                    piece, tail = self._cut(piece, room)
                    rest.insert(0, tail)
                room -= len(piece[2]) // 4
                pieces.append(piece)
            self._sequence(pieces)

    def taken(self, names: list[str], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        for at in range(0, len(self.out), 4000):
            columns = zip(*self.out[at : at + 4000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        self.out = []


def pack_documents(docs: DataFrame, path: str, *, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", buffer_ids: int = BUFFER_IDS) -> DataFrame:
    """All documents as pieces of sequences of at most `capacity` ids.

    Returns id_col, start long (ids of the document before the piece), length
    long, ids binary (little-endian unsigned 32-bit), doc_tokens long (with
    the closing id), sequence_id long, offset long (in the sequence).
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, close = text_encoder(path, "library"), Packer(capacity, TaskContext.get().partitionId()), end_id.to_bytes(4, "little")
        arrow_kind = None
        for batch in batches:
            arrow_kind = batch.schema.field(0).type
            for ids, texts in text_slices(batch):
                for doc, packed in zip(ids.to_pylist(), encoder.encode(texts), strict=True):
                    packer.add(doc, packed + close)
                if packer.held >= buffer_ids:
                    packer.pack()
                yield from packer.taken(names, arrow_kind)
        packer.finish()
        if arrow_kind is not None:
            yield from packer.taken(names, arrow_kind)
        encoder.forget()

    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(tidy(run), f"`{id_col}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
