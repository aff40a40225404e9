"""Conversation structure repair (operator 11): cheapest edits by a tensor DP.

A conversation is a row of roles and texts.  Edits keep, rerole or delete a row
or insert one, so that the initials of the roles read ``(s?(ua)+)?``.  Four
states tell what has been written: nothing, s, u, a.  Conversations are put in
buckets by length; a bucket is one tensor with time first, and each step updates
the costs of all its conversations and states at once.  Costs run backwards and
are stored, so the edits are traced forwards, all conversations at once, and in
each place the letter that comes first in ASCII is taken.

Rows are range-partitioned and sorted by conversation and turn.  A conversation
inside one partition is repaired where it is.  One that crosses a border, or that is longer
than `PIECE_ROWS` or `PIECE_BYTES`, is cut into pieces.  What a piece does to costs is
a 4 x 4 table (the least cost from each state to each state), so all pieces are
worked on at the same time: tables first, then the costs at each piece's end,
then the state in which each is entered; only these few numbers of a piece meet
in one task.  No task holds a whole long conversation.

Rows of one turn are in the order of role and text.  Null roles and texts are one
space.  Null turns come first; a null conversation id is a conversation too.  An
empty role has no initial and is treated as any other role that is not s, u or a.
Extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillmill.llm.arrow_text import differs
from quillmill.llm.durable import durable
from quillmill.llm.lines import BLANKS

#: A conversation of more rows or bytes is repaired in pieces.
PIECE_ROWS, PIECE_BYTES = 50_000, 16_000_000
# What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Faults of a row; the first two have to go.
SOUND, BLANK, DUPLICATE, CUT = range(4)
#: States: nothing written, or the last initial; initials are numbered likewise (0: another one).
START, S, U, A = range(4)
NEXT = np.array([U, U, A, U])  # the state after a written user or assistant row, the only one that may follow
FAR = 1 << 40
LETTERS = np.frombuffer(b"DIKR", np.uint8)
D, I, K, R = range(4)


def damage(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text: rows damaged by a checksum of their place (nulls: one space).

    Of 20 remainders 0 drops the row, 1 empties its text, 2 takes its `.!?` out, 3 repeats
    it, 4 makes it the user's."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(written(conv_col), F.lit(":"), written(turn_col)).cast("binary")), F.lit(20))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), written(role_col).alias("role"), written(text_col).alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


# --- the tensor DP


def _relax(b: np.ndarray) -> np.ndarray:
    """Costs (states first) with rows inserted where that is cheaper."""
    u, a = np.minimum(b[U], INSERT + b[A]), np.minimum(b[A], INSERT + b[U])
    return np.stack([np.minimum(b[START], INSERT + u), np.minimum(b[S], INSERT + u), u, a])


def _kept(initial: np.ndarray, fault: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The cost of keeping a row, by state: FAR where its initial can't follow or it has to go."""
    out = np.full(after.shape, FAR)
    extra = np.where(fault == CUT, TRUNCATED, 0) + np.where((fault == BLANK) | (fault == DUPLICATE), FAR, 0)
    out[START] = np.select([initial == S, initial == U], [after[S], after[U]], FAR)
    for state, follows in ((S, U), (U, A), (A, U)):
        out[state] = np.where(initial == follows, after[follows], FAR)
    return out + extra


def backward(initial: np.ndarray, fault: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Costs from each turn and state on: (turns + 1, 4, conversations).  initial and fault are
    (turns, conversations), filled at the end with -1; end is (4, conversations)."""
    costs = np.empty((len(initial) + 1, *end.shape), np.int64)
    costs[-1] = end
    for t in range(len(initial) - 1, -1, -1):
        after = costs[t + 1]
        extra = np.where(fault[t] == CUT, TRUNCATED, 0) + np.where((fault[t] == BLANK) | (fault[t] == DUPLICATE), FAR, 0)
        best = np.minimum(np.minimum(after + DELETE, _kept(initial[t], fault[t], after)), after[NEXT] + REROLE + extra)
        costs[t] = np.where(initial[t] < 0, after, np.minimum(_relax(best), FAR))
    return costs


def trace(initial: np.ndarray, fault: np.ndarray, end: np.ndarray, entry: np.ndarray, final: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The first of the cheapest edits: arrays conv, edit, state (after it) and row (the turn, -1 for an
    insertion), in order within each conversation; the state at the end; the cost.

    final: whether the conversation ends here, so that rows may be inserted at its end."""
    costs = backward(initial, fault, np.where(final, _relax(end), end))
    state, convs, told = entry.copy(), np.arange(len(entry)), []

    def write(who: np.ndarray, edit: int, row: int) -> None:
        told.append((who, np.full(len(who), edit), state[who].copy(), np.full(len(who), row)))

    for t in range(len(initial) + 1):
        open_ = convs[final & (costs[t][state, convs] != end[state, convs])] if t == len(initial) else convs[initial[t] >= 0]
        while len(open_):
            now = costs[t][state[open_], open_]
            goes = np.zeros(len(open_), bool) if t == len(initial) else costs[t + 1][state[open_], open_] + DELETE == now
            more = ~goes & (costs[t][NEXT[state[open_]], open_] + INSERT == now)
            if t < len(initial):
                gone, stay = open_[goes], open_[~goes & ~more]
                write(gone, D, t)
                after = costs[t + 1][:, stay]
                keeps = _kept(initial[t, stay], fault[t, stay], after)[state[stay], np.arange(len(stay))] == now[~goes & ~more]
                state[stay[keeps]] = initial[t, stay[keeps]]
                write(stay[keeps], K, t)
                state[stay[~keeps]] = NEXT[state[stay[~keeps]]]
                write(stay[~keeps], R, t)
            open_ = open_[more]
            state[open_] = NEXT[state[open_]]
            write(open_, I, -1)
            if t == len(initial):
                open_ = open_[costs[t][state[open_], open_] != end[state[open_], open_]]
    parts = [np.concatenate(x) if told else np.zeros(0, np.int64) for x in zip(*told, strict=True)] if told else [np.zeros(0, np.int64)] * 4
    order = np.argsort(parts[0], kind="stable")
    return dict(zip(("conv", "edit", "state", "row"), (p[order] for p in parts), strict=True)), state, costs[0][entry, convs]


def by_length(bounds: np.ndarray) -> Iterator[np.ndarray]:
    """Conversations in buckets: those whose length has the same power of two above it."""
    sizes = np.diff(bounds)
    bucket = np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
    for b in np.unique(bucket):
        yield np.flatnonzero(bucket == b)


def time_major(bounds: np.ndarray, members: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers (turns, members), and columns in that shape, -1 past each end."""
    sizes = np.diff(bounds)[members]
    t = np.arange(sizes.max(initial=0))[:, None]
    rows = np.where(t < sizes, bounds[members] + t, -1)
    return rows, [np.where(rows < 0, -1, c[rows]) if len(c) else np.full(rows.shape, -1) for c in columns]


#: Costs at the end of a conversation: nothing or an assistant row may be last.
END = np.array([0, FAR, FAR, 0])


def repaired_rows(bounds: np.ndarray, initial: np.ndarray, fault: np.ndarray, roles: pa.Array, texts: pa.Array, *, end: np.ndarray | None = None, entry: np.ndarray | None = None, final: np.ndarray | None = None) -> dict[str, list | pa.Array]:
    """cost, audit and repaired (a list of role and text) for each conversation of a flat table of rows."""
    n = len(bounds) - 1
    end = np.repeat(END[:, None], n, 1) if end is None else end
    entry, final = np.zeros(n, int) if entry is None else entry, np.ones(n, bool) if final is None else final
    found = []
    for members in by_length(bounds):
        rows, (i, f) = time_major(bounds, members, initial, fault)
        told, _, _ = trace(i, f, end[:, members], entry[members], final[members])
        source = np.where(told["row"] < 0, -1, rows[told["row"], told["conv"]]) if len(rows) else np.full(len(told["row"]), -1)
        found.append((members[told["conv"]], told["edit"], told["state"], source))
    conv, edit, state, source = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, int)] * 4
    order = np.argsort(conv, kind="stable")
    conv, edit, state, source = conv[order], edit[order], state[order], source[order]
    price = np.array([DELETE, INSERT, 0, REROLE])[edit] + np.where((edit != D) & (source >= 0) & (fault[source] == CUT if len(fault) else False), TRUNCATED, 0)
    letters, ends = LETTERS[edit].tobytes().decode(), np.cumsum(np.bincount(conv, minlength=n))
    live = edit != D
    at = pa.array(source[live], mask=source[live] < 0)
    set_role = pa.array(np.where(state[live] == U, "user", "assistant").astype(object), pa.string())
    role = pc.if_else(pa.array(edit[live] == K), roles.take(at), set_role)
    text = pc.fill_null(texts.take(at), "")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(conv[live], minlength=n))])
    return {
        "cost": np.bincount(conv, weights=price, minlength=n).astype(np.int64),
        "audit": [letters[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if n else [],
        "repaired": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([role, text], ["role", "text"])),
    }


# --- pieces


def _counts(bounds: np.ndarray, initial: np.ndarray, fault: np.ndarray) -> dict[str, np.ndarray]:
    """blank, duplicate, truncated, illegal (adjacent pairs within) of each piece."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    told = {name: np.bincount(owner[fault == code], minlength=n) for name, code in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT))}
    pairs = (owner[1:] == owner[:-1]) & ~legal(initial[:-1], initial[1:])
    return told | {"illegal": np.bincount(owner[1:][pairs], minlength=n)}


def legal(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (second == U) & ((first == S) | (first == A)) | (first == U) & (second == A)


def _repeated(bounds: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Rows whose key stood before in their conversation."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((np.arange(len(k1)), k2, k1, owner))
    again = (owner[order][1:] == owner[order][:-1]) & (k1[order][1:] == k1[order][:-1]) & (k2[order][1:] == k2[order][:-1])
    out = np.zeros(len(k1), bool)
    out[order[1:][again]] = True
    return out


PIECE = "part bigint, open boolean, initials binary, faults binary, keys binary, roles array<string>, texts array<string>"
RESULT = "n_rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired array<struct<role:string,text:string>>"


def _bytes(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    return [values[a:b].astype(np.int8).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class Cutter:
    """Sorted rows of a partition, a batch at a time, as rows of PIECE and RESULT: a whole
    conversation inside the partition with its result, others as open pieces."""

    def __init__(self, partition: int) -> None:
        self.part = partition << 32
        self.carry: pa.RecordBatch | None = None
        self.edge: pa.RecordBatch | None = None  # a row of the conversation whose pieces have been told already
        self.first = True

    def _whole(self, rows: pa.RecordBatch, bounds: np.ndarray, is_open: bool) -> Iterator[pa.RecordBatch]:
        n = len(bounds) - 1
        if not n:
            return
        initial, fault = (np.asarray(rows.column(c)).astype(int) for c in ("initial", "fault"))
        k1, k2 = np.asarray(rows.column("k1")), np.asarray(rows.column("k2"))
        fault = np.where((fault != BLANK) & _repeated(bounds, k1, k2), DUPLICATE, fault)
        parts = pa.array(np.arange(self.part, self.part + n))
        self.part += n
        heads = rows.column("conv").take(pa.array(bounds[:-1]))
        if is_open:
            offsets = pa.array(bounds, pa.int32())
            keys = [np.stack([k1[a:b], k2[a:b]], 1).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            piece = [pa.array(_bytes(initial, bounds), pa.binary()), pa.array(_bytes(fault, bounds), pa.binary()), pa.array(keys, pa.binary()), *(pa.ListArray.from_arrays(offsets, _plain(rows.column(c))) for c in ("role", "text"))]
            result = [pa.nulls(n, t) for t in _result_types()]
        else:
            piece = [pa.nulls(n, t) for t in (pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()))]
            made = repaired_rows(bounds, initial, fault, _plain(rows.column("role")), _plain(rows.column("text")))
            result = _result(np.diff(bounds), _counts(bounds, initial, fault), made)
        yield pa.RecordBatch.from_arrays([heads, parts, pa.array([is_open] * n), *piece, *result], ["conv", *_names(PIECE), *_names(RESULT)])

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not batch.num_rows:
            return
        if self.carry is not None:
            batch, self.carry = pa.concat_batches([self.carry, batch]), None
        elif self.edge is not None and differs(pa.concat_arrays([self.edge, batch.column("conv").slice(0, 1)]))[1]:
            self.edge = None
        starts = np.flatnonzero(differs(batch.column("conv")))
        ends_at = int(starts[-1])
        if len(starts) > 1 and (self.first or self.edge is not None):
            yield from self._whole(batch.slice(0, int(starts[1])), np.array([0, starts[1]]), True)
            starts, self.first, self.edge = starts[1:], False, None
        whole = batch.slice(int(starts[0]), ends_at - int(starts[0]))
        yield from self._whole(whole, starts - starts[0], False)
        rest = batch.slice(ends_at)
        if rest.num_rows > PIECE_ROWS or rest.nbytes > PIECE_BYTES:
            yield from self._whole(rest, np.array([0, rest.num_rows]), True)
            self.edge, self.first = rest.column("conv").slice(0, 1), False
        else:
            self.carry = rest

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.carry is not None:
            yield from self._whole(self.carry, np.array([0, self.carry.num_rows]), True)


def _plain(column: pa.Array) -> pa.Array:
    """Without the offset of a slice."""
    return pa.concat_arrays([column.cast(pa.string())])


def _names(schema: str) -> list[str]:
    return [x.split(" ")[0] for x in schema.split(", ")]


def _result_types() -> list[pa.DataType]:
    return [*[pa.int64()] * 6, pa.string(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))]


def _result(sizes: np.ndarray, counts: dict[str, np.ndarray], made: dict) -> list[pa.Array]:
    return [*(pa.array(x, pa.int64()) for x in (sizes, *(counts[k] for k in ("blank", "duplicate", "truncated", "illegal")), made["cost"])), pa.array(made["audit"], pa.string()), made["repaired"]]


def _numbers(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int8).astype(int)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """bounds, initials and faults of a batch of pieces, rows that earlier pieces hold (`again`) being duplicates."""
    initials, faults = ([_numbers(x) for x in batch.column(c).to_pylist()] for c in ("initials", "faults"))
    for fault, again in zip(faults, batch.column("again").to_pylist(), strict=True):
        if again:
            fault[again] = DUPLICATE
    none = [np.zeros(0, int)]
    return np.concatenate([[0], np.cumsum([len(x) for x in initials])]).astype(int), np.concatenate(none + initials), np.concatenate(none + faults)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece the least costs from each state (rows) to each state at its end, and its first and last initial."""
    for batch in batches:
        bounds, initial, fault = _flat(batch)
        n = batch.num_rows
        tables = np.zeros((n, 4, 4), np.int64)
        for members in by_length(bounds):
            _, (i, f) = time_major(bounds, members, initial, fault)
            for state in range(4):
                end = np.full((4, len(members)), FAR)
                end[state] = 0
                tables[members, :, state] = backward(i, f, end)[0].T
        edges = [np.array([initial[x] for x in at], np.int64) for at in (bounds[:-1], bounds[1:] - 1)]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("part"), pa.array([t.tobytes() for t in tables], pa.binary()), *map(pa.array, edges)], ["conv", "part", "table", "head", "tail"])


def _ends(pieces: pd.DataFrame) -> pd.DataFrame:
    """The costs at the end of each piece of a conversation, whether it is the last, and whether its first row may not follow the piece before."""
    pieces = pieces.sort_values("part")
    costs, out = _relax(END[:, None])[:, 0], []
    for table in reversed(pieces["table"].tolist()):
        out.append(costs)
        costs = np.minimum(FAR, (np.frombuffer(table, np.int64).reshape(4, 4) + costs).min(1))
    head, tail = pieces["head"].to_numpy(), pieces["tail"].to_numpy()
    joint = np.concatenate([[False], ~legal(tail[:-1], head[1:])])
    return pd.DataFrame({"part": pieces["part"], "end": [c.astype(np.int64).tobytes() for c in reversed(out)], "final": np.arange(len(pieces)) == len(pieces) - 1, "joint": joint.astype(np.int64)})


def _end_costs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    final = np.asarray(batch.column("final").to_pylist(), bool)
    ends = np.stack([np.frombuffer(x, np.int64) for x in batch.column("end").to_pylist()], 1)
    return np.where(final, END[:, None], ends), final


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state at the end of each piece for each state in which it may be entered."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds, initial, fault = _flat(batch)
        ends, final = _end_costs(batch)
        exits = np.zeros((batch.num_rows, 4), np.int64)
        for members in by_length(bounds):
            _, (i, f) = time_major(bounds, members, initial, fault)
            for state in range(4):
                exits[members, state] = trace(i, f, ends[:, members], np.full(len(members), state), final[members])[1]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("part"), pa.array([x.tobytes() for x in exits], pa.binary())], ["conv", "part", "exits"])


def _entries(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state in which each piece of a conversation is entered."""
    pieces = pieces.sort_values("part")
    state, out = START, []
    for exits in pieces["exits"]:
        out.append(state)
        state = int(np.frombuffer(exits, np.int64)[state])
    return pd.DataFrame({"part": pieces["part"], "entry": np.array(out, np.int64)})


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds, initial, fault = _flat(batch)
        ends, final = _end_costs(batch)
        roles, texts = (_plain(batch.column(c).flatten()) for c in ("roles", "texts"))
        made = repaired_rows(bounds, initial, fault, roles, texts, end=ends, entry=np.asarray(batch.column("entry")).astype(int), final=final)
        counts = _counts(bounds, initial, fault)
        counts["illegal"] = counts["illegal"] + np.asarray(batch.column("joint")).astype(int)
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("part"), *_result(np.diff(bounds), counts, made)], ["conv", "part", *_names(RESULT)])


def repair_conversations(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_col, part long, n_rows, blank, duplicate, truncated, illegal, cost (longs), audit string,
    repaired array of (role, text): the faults of a conversation and its cheapest repair.

    One row for a conversation, or one for each of its pieces, to be added up and joined in the
    order of `part`.  A row's first fault counts: blank, duplicate (role and text seen
    earlier), truncated (the last character that is no blank is not one of `.!?`).  Keeping a row
    costs 0, reroling it 3, deleting it 4 (blanks and duplicates have to be), inserting one
    3; a truncated row that stays costs 3 more.  Of edits that cost the same, those whose
    initials (K, R, D, I) come first in ASCII are taken."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), written(role_col).alias("role"), written(text_col).alias("text"))
    stripped = F.btrim("text", F.lit(BLANKS))
    fault = F.when(stripped == "", BLANK).when(~F.right(stripped, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(SOUND)
    initial = F.when(F.startswith("role", F.lit("s")), S).when(F.startswith("role", F.lit("u")), U).when(F.startswith("role", F.lit("a")), A).otherwise(START)
    coded = rows.withColumns({"initial": initial, "fault": fault, "k1": F.xxhash64("role", "text"), "k2": F.xxhash64(F.lit("turn"), "text", "role")})
    ordered = coded.repartitionByRange("conv", "turn").sortWithinPartitions("conv", "turn", "role", "text").drop("turn")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(TaskContext.get().partitionId())
        for batch in batches:
            yield from cutter.add(batch)
        yield from cutter.end()

    conv = f"conv {turns.schema[conv_col].dataType.simpleString()}"
    pieces = durable(ordered.mapInArrow(cut, f"{conv}, {PIECE}, {RESULT}"))
    opened = pieces.where("open")
    within = Window.partitionBy("conv", "k1", "k2")  # a piece holds a key once: at most a row for each piece
    keys = opened.mapInArrow(_keys, f"{conv}, part bigint, row int, k1 bigint, k2 bigint")
    again = keys.withColumn("first", F.min("part").over(within)).where(F.col("part") > F.col("first")).groupBy("part").agg(F.collect_list("row").alias("again"))
    thin = durable(opened.select("conv", "part", "initials", "faults").join(again, "part", "left").select("conv", "part", "initials", "faults", "again"))
    ends = thin.mapInArrow(_tables, f"{conv}, part bigint, table binary, head bigint, tail bigint").groupBy("conv").applyInPandas(_ends, "part bigint, end binary, final boolean, joint bigint")
    ended = durable(thin.join(ends, "part"))
    entries = ended.mapInArrow(_exits, f"{conv}, part bigint, exits binary").groupBy("conv").applyInPandas(_entries, "part bigint, entry bigint")
    finished = ended.join(entries, "part").join(opened.select("part", "roles", "texts"), "part").mapInArrow(_finish, f"{conv}, part bigint, {RESULT}")
    result = ["conv", "part", *_names(RESULT)]
    return pieces.where("not open").select(*result).unionByName(finished.select(*result)).withColumnRenamed("conv", conv_col)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a piece that is no blank and no duplicate within it, with its key."""
    for batch in batches:
        for i in range(batch.num_rows):
            fault = _numbers(batch.column("faults")[i].as_py())
            rows = np.flatnonzero((fault != BLANK) & (fault != DUPLICATE))
            keys = np.frombuffer(batch.column("keys")[i].as_py(), np.int64).reshape(-1, 2)[rows]
            own = pa.array(np.zeros(len(rows), np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("conv").slice(i, 1).take(own), batch.column("part").slice(i, 1).take(own), pa.array(rows.astype(np.int32)), pa.array(keys[:, 0]), pa.array(keys[:, 1])], ["conv", "part", "row", "k1", "k2"])
