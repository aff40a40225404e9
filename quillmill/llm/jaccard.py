"""N-gram Jaccard join of whole texts, by size-aware heavy-light search (operator 2).

A text's set holds the 64-bit hashes of its distinct word n-grams; equal sets
are one node.  Two nodes link when |A n B| / |A u B| >= threshold.  The join
finds every link's component, but never lists the pairs of a group.

0. Texts are cut and hashed once; the sets are kept in the checkpoint folder.
1. Frequencies.  Every task sends its hashes, sorted and delta-coded, to hash
   ranges; a range counts them all and marks in two bit maps which elements are
   repeated (in two sets or more) and which are frequent.  A set of which less
   than the threshold is repeated can link with nothing and takes no further part.
   All tasks order each set by (single, repeated, frequent; hash); an error in
   a map (two hashes in one cell) changes that order for everyone alike and loses
   nothing.
2. Small sets enumerate fixed-size subsets: two sets that link share at least
   two of the first n - ceil(t n) + 2 elements of each, so each pair of those
   elements is a key (sets so small that one common element can be enough go to
   the lists instead, at any threshold).  Large sets put the first n - ceil(t n) + 1 elements into
   inverted lists.  The size that separates the two is where enumeration begins to
   cost more than scanning lists of the measured mean length.  Small sets that
   can link with large ones are in the lists as well.
3. A list gives the pairs that size and position allow.  A list of more than a
   few members gives only a star around the member that has the element earliest;
   once links are known, the pairs of such a list that are not in one component
   yet are all checked, in blocks of its members.
4. Candidates are verified by their whole sizes and all repeated elements.

Nothing else that grows with the input is broadcast or collected: the bit maps
follow the input up to 2 ** MAP_BITS bits; beyond that they fill up, which costs
work and not results.

Defined results: null and empty texts, and texts without words, have an empty
set and link with nothing; with fewer words than n the whole sequence is the
one element; repeated rows and ids are copies of each other; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.arrow_text import text_slices, tidy
from quillmill.llm.components import connected_components
from quillmill.llm.durable import durable

#: The largest bit maps have this power of two of bits (128 MB each).
MAP_BITS = 30
#: Bytes of the maps that one job brings to the driver.
PART_BYTES = 1 << 24
#: Elements in more sets than this are frequent.
FREQUENT = 24
#: Longer lists give stars; members of a block when a long list is checked whole.
STAR = 3
LIST_BLOCK = 256
#: Hashes that a task gathers before it sends them, and about how many a hash range holds.
GATHERED = 2_000_000
RANGE = 3_000_000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; texts may be null."""
    low = pc.replace_substring_regex(pc.ascii_lower(texts.fill_null("")), r"[\x09-\x0D]", " ")
    split = pc.split_pattern(low, " ")
    bounds = np.asarray(split.offsets)
    coded = split.values.dictionary_encode()
    names = coded.dictionary.to_pylist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w) for w in names), np.uint64, len(names))
    full = np.fromiter((bool(w) for w in names), bool, len(names))
    index = np.asarray(coded.indices)
    real = full[index] if len(index) else np.zeros(0, bool)
    until = np.concatenate([[0], np.cumsum(real)])[bounds]
    words = hashes[index[real]] if len(index) else np.zeros(0, np.uint64)
    if len(words) >= n:
        grams = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            grams += words[k : len(words) - n + 1 + k] * _ODD[k % len(_ODD)] + np.uint64(k)
        grams = mixed(grams)
    out = []
    for a, b in zip(until[:-1].tolist(), until[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(grams[a : b - n + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            few = np.array([int(b - a)], np.uint64)
            for k in range(a, b):
                few = mixed(few * _ODD[7] + words[k])
            out.append(few)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(s: np.ndarray) -> int:
    return np.frombuffer(xxhash.xxh64_digest(s.tobytes(), seed=5)[::-1], "<i8")[0].item()


def required(n: np.ndarray | int, percent: int):
    """The least intersection with any set, the set itself among them."""
    return -(-n * percent // 100)


def overlap_needed(a, b, percent: int):
    """The least intersection of two sets of these sizes that link."""
    return -(-(a + b) * percent // (100 + percent))


# --- blobs that compress: sorted 32-bit values as byte planes of their differences


def _planes(values: np.ndarray) -> bytes:
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(blob: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(blob, np.uint8).reshape(4, -1).T.tobytes(), "<u4")


def _deltas(values: np.ndarray) -> bytes:
    return _planes(np.diff(values, prepend=np.uint32(0)))


def _undeltas(blob: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(blob), dtype=np.uint32)


class Ranges:
    """Hash ranges: the leading bits name the range, the next 32 the place in it."""

    def __init__(self, bits: int):
        self.bits = bits

    def split(self, hashes: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray]]:
        """hashes: sorted.  Each range that has some, their positions, their places."""
        parts = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        places = (hashes >> np.uint64(32 - self.bits)).astype(np.uint32)
        edges = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else []
        for a, b in zip(edges, [*edges[1:], len(parts)], strict=True):
            yield int(parts[a]), slice(a, b), places[a:b]


def plan(texts: DataFrame) -> tuple[Ranges, int]:
    """Hash ranges and bits of a map, from the number of characters: a range has
    about RANGE words at most (and there are enough for every core); a map has
    about one cell a word, within its bound."""
    words = (texts.agg(F.sum(F.length("text"))).first()[0] or 0) / 6 + 1
    wanted = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    bits = min(MAP_BITS, max(20, math.ceil(math.log2(words))))
    return Ranges(min(bits - 3, max(6, math.ceil(math.log2(2 * min(wanted, 8192))), math.ceil(math.log2(words / RANGE))))), bits


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """The distinct sets among batches of (node, elements)."""
    seen: set[int] = set()
    for batch in batches:
        for node, elements in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if node not in seen:
                seen.add(node)
                yield node, np.frombuffer(elements.as_buffer(), np.uint64)


def least_size(percent: int) -> int:
    """The smallest set that can link with another than itself: n of n + 1 elements must be enough."""
    return -(-percent // (100 - percent))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


class Maps:
    """Two bit maps over the leading bits of hashes."""

    def __init__(self, bits: int):
        self.bits = bits
        self.repeated = np.zeros((1 << bits) // 8, np.uint8)
        self.frequent = np.zeros((1 << bits) // 8, np.uint8)

    @staticmethod
    def has(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        cell = hashes >> np.uint64(64 - (len(marks) * 8).bit_length() + 1)
        return (marks[(cell >> np.uint64(3)).astype(np.int64)] >> (7 - (cell & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def frequency_maps(sets: DataFrame, ranges: Ranges, bits: int) -> tuple[Maps, float]:
    """The maps, and the mean number of other sets that hold an element of a set,
    over the elements that are not frequent.  sets: node, elements."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent() -> pa.RecordBatch:
            every = np.sort(np.concatenate(held))
            rows = [(r, _deltas(places)) for r, _, places in ranges.split(every)]
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], ["r", "blob"])

        for _, s in _nodes(batches):  # copies in one task count once
            held.append(s)
            size += len(s)
            if size > GATHERED:
                yield sent()
                held, size = [], 0
        if held:
            yield sent()

    maps = Maps(bits)
    slice_bits = maps.bits - ranges.bits

    def marked(places: np.ndarray) -> bytes | None:
        if not len(places):
            return None
        marks = np.zeros(1 << slice_bits, np.uint8)
        marks[places >> np.uint32(32 - slice_bits)] = 1
        return np.packbits(marks).tobytes()

    def count(group: pd.DataFrame) -> pd.DataFrame:
        every = np.sort(np.concatenate([_undeltas(b) for b in group["blob"]]))
        edges = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        times = np.diff(np.append(edges, len(every)))
        rest = times[times <= FREQUENT].astype(np.float64)
        return pd.DataFrame({"r": [group["r"].iloc[0]], "repeated": [marked(every[edges[times > 1]])], "frequent": [marked(every[edges[times > FREQUENT]])], "total": [rest.sum()], "squares": [(rest**2).sum()]})

    counted = sets.mapInArrow(tidy(gather), "r int, blob binary").groupBy("r").applyInPandas(count, "r int, repeated binary, frequent binary, total double, squares double")
    total = squares = 0.0
    # Slices of maps of bounded size, PART_BYTES a job; written first, so that few jobs don't mean few tasks.
    for row in durable(counted).coalesce(1 + (2 << bits) // 8 // PART_BYTES).toLocalIterator():
        for name in ("repeated", "frequent"):
            if row[name] is not None:
                part = np.frombuffer(row[name], np.uint8)
                getattr(maps, name)[row["r"] * len(part) : (row["r"] + 1) * len(part)] = part
        total += row["total"]
        squares += row["squares"]
    return maps, (squares / total - 1) if total else 0.0


def boundary(mean_list: float, percent: int) -> int:
    """percent: below 100, or no size would do.  The largest size for which enumerating pairs costs no more than scanning.

    A set of size n has m = n - ceil(t n) + 2 leading elements: m (m - 1) / 2 keys,
    against m - 1 lists of 1 + mean_list entries.
    """
    n = 2
    while True:
        m = n + 1 - required(n + 1, percent) + 2
        if m * (m - 1) / 2 > (m - 1) * (1 + max(0.0, mean_list)):
            return n
        n += 1


def _keys(s: np.ndarray, maps: Maps, percent: int, small: int) -> tuple[np.ndarray, np.ndarray]:
    """A set's keys and the position of each (0 for pairs, which positions do not prune)."""
    n = len(s)
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    if n < least_size(percent):  # only equal sets link, and those are one node
        return none
    tiny = 100 // percent  # up to this size one common element can be enough
    again = maps.has(maps.repeated, s)
    single = n - int(np.count_nonzero(again))
    if n - single < required(n, percent):
        return none
    s = s[again]  # single elements come first, but nobody else has them
    hot = maps.has(maps.frequent, s)
    ordered = np.concatenate([s[~hot], s[hot]])
    lead = n - required(n, percent) + 1
    keys, at = [], []
    if tiny < n <= small:
        first = ordered[: max(0, lead + 1 - single)]
        i, j = np.triu_indices(len(first), 1)
        keys.append(mixed(first[i] * _ODD[1] ^ mixed(first[j] + _ODD[2])))
        at.append(np.zeros(len(i), np.uint32))
    if n * 100 >= percent * (small + 1) or n * percent <= 100 * tiny:
        keys.append(ordered[: max(0, lead - single)])
        at.append(np.arange(single, max(single, lead), dtype=np.uint32)[: len(keys[-1])])
    return (np.concatenate(keys), np.concatenate(at)) if keys else none


def list_pairs(node: np.ndarray, size: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of one list that may link by their sizes and positions."""
    i, j = np.triu_indices(len(node), 1)
    need = overlap_needed(size[i], size[j], percent)
    good = np.minimum(size[i] - at[i], size[j] - at[j]) >= need
    i, j = i[good], j[good]
    return np.minimum(node[i], node[j]), np.maximum(node[i], node[j])


def candidates(sets: DataFrame, percent: int, maps: Broadcast, small: int, ranges: Ranges) -> DataFrame:
    """list (null: a pair), a, b, size, at.  Pairs a < b to verify; members a of
    long lists, whose pairs are only partly among them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def sent() -> pa.RecordBatch:
            key, node, total, at = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(key, kind="stable")
            key, node, total, at = key[order], node[order], total[order], at[order]
            rows = [(r, _deltas(places), node[own].tobytes(), _planes(total[own]), _planes(at[own])) for r, own, places in ranges.split(key)]
            kinds = [pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["r", "places", "nodes", "sizes", "ats"])

        for node, s in _nodes(batches):
            key, at = _keys(s, maps.value, percent, small)
            if len(key):
                held.append((key, np.full(len(key), node, np.int64), np.full(len(key), len(s), np.uint32), at))
            size += len(key)
            if size > GATHERED // 3:
                yield sent()
                held, size = [], 0
        if size:
            yield sent()

    def match(group: pd.DataFrame) -> pd.DataFrame:
        place = np.concatenate([_undeltas(b) for b in group["places"]])
        node = np.concatenate([np.frombuffer(b, np.int64) for b in group["nodes"]])
        size = np.concatenate([_unplanes(b) for b in group["sizes"]]).astype(np.int64)
        at = np.concatenate([_unplanes(b) for b in group["ats"]]).astype(np.int64)
        order = np.lexsort((node, place))
        place, node, size, at = place[order], node[order], size[order], at[order]
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (node[1:] != node[:-1])])  # copies from several tasks
        place, node, size, at = place[new], node[new], size[new], at[new]
        edges = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        counts = np.diff(np.append(edges, len(place)))
        left, right = [], []
        long_rows = []
        for k in np.flatnonzero(counts > 1):
            own = slice(edges[k], edges[k] + counts[k])
            if counts[k] <= STAR:
                a, b = list_pairs(node[own], size[own], at[own], percent)
            else:
                hub = int(np.lexsort((node[own], at[own]))[0])
                others = np.arange(counts[k]) != hub
                hn, hs, ha = node[own][hub], size[own][hub], at[own][hub]
                good = others & (np.minimum(hs - ha, size[own] - at[own]) >= overlap_needed(size[own], hs, percent))
                a, b = np.minimum(node[own][good], hn), np.maximum(node[own][good], hn)
                name = (int(group["r"].iloc[0]) << 32) + int(place[own][0])
                long_rows.append(pd.DataFrame({"list": name, "a": node[own], "b": 0, "size": size[own], "at": at[own]}))
            left.append(a)
            right.append(b)
        pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1) if left else np.zeros((2, 0), np.int64)
        out = [pd.DataFrame({"list": pd.array([None] * pairs.shape[1], "Int64"), "a": pairs[0], "b": pairs[1], "size": 0, "at": 0}), *long_rows]
        return pd.concat(out, ignore_index=True).astype({"list": "Int64"})

    blobs = sets.mapInArrow(tidy(send), "r int, places binary, nodes binary, sizes binary, ats binary")
    return blobs.groupBy("r").applyInPandas(match, "list bigint, a bigint, b bigint, size bigint, at bigint")


def node_map(nodes: DataFrame, bits: int) -> np.ndarray:
    """A bit map of the cells of the nodes in column a."""
    cell = F.shiftrightunsigned("a", 64 - bits)
    step = 18  # 32 KB a row

    def mark(group: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(1 << step, np.uint8)
        marks[group["low"]] = 1
        return pd.DataFrame({"high": [group["high"].iloc[0]], "marks": [np.packbits(marks).tobytes()]})

    cells = nodes.select(cell.alias("c")).distinct().select(F.shiftright("c", step).alias("high"), F.col("c").bitwiseAND((1 << step) - 1).alias("low"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in cells.groupBy("high").applyInPandas(mark, "high bigint, marks binary").collect():  # at most 2 ** 26 bits, 8 MB
        part = np.frombuffer(row["marks"], np.uint8)
        out[row["high"] * len(part) : (row["high"] + 1) * len(part)] = part
    return out


def node_sets(sets: DataFrame, wanted: DataFrame, maps: Broadcast, bits: int) -> DataFrame:
    """node, size, elements binary: the repeated elements of (at least) the wanted nodes.
    The others are in no other set, so they add to no intersection.  bits: of the maps,
    which are not to be read on the driver."""
    shared = sets.sparkSession.sparkContext.broadcast(node_map(wanted, min(26, bits)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(Maps.has(shared.value, np.asarray(batch.column(0)).view(np.uint64))))
            rows = []
            for node, elements in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if node not in seen:
                    seen.add(node)
                    s = np.frombuffer(elements.as_buffer(), np.uint64)
                    rows.append((node, len(s), s[Maps.has(maps.value.repeated, s)].tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["node", "size", "elements"])

    return sets.mapInArrow(tidy(send), "node bigint, size bigint, elements binary").groupBy("node").agg(F.first("size").alias("size"), F.first("elements").alias("elements"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link.  The side that recurs is joined last."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, total in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist(), strict=True):
                both = np.sort(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)]), kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (total - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    first = pairs.join(sets.select(F.col("node").alias("b"), F.col("size").alias("nb"), F.col("elements").alias("eb")), "b")
    both = first.join(sets.select(F.col("node").alias("a"), F.col("size").alias("na"), F.col("elements").alias("ea")), "a")
    return both.select("a", "b", "ea", "eb", (F.col("na") + F.col("nb")).alias("total")).mapInArrow(tidy(check), "a bigint, b bigint")


def hashed_sets(texts: DataFrame, id_type: str, n: int) -> DataFrame:
    """id, node (null: the empty set), n_shingles long, elements binary; one row per text."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                sets = shingle_sets(texts, n)
                columns = [ids, pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "node", "n_shingles", "elements"])

    return texts.mapInArrow(tidy(tell), f"id {id_type}, node bigint, n_shingles bigint, elements binary")


def pairs_of_lists(rows: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs of each list, of different components, that may link by their
    sizes and positions.  rows: list, a, size, at, root.

    One side of such a pair is always outside the list's largest component: all
    members meet only those.  Both sides are cut into blocks of about LIST_BLOCK
    members, and each two blocks meet under a key of their own, so no list is one
    task's.  Lists of one component have nothing to check.
    """
    parts = rows.groupBy("list", "root").agg(F.count("*").alias("n"))
    shape = parts.groupBy("list").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("main"))
    blocks = lambda n: F.ceil(n / LIST_BLOCK).cast("long")
    shape = shape.where(F.col("n") > F.col("main.n")).select("list", F.col("main.root").alias("main"), blocks(F.col("n")).alias("xs"), blocks(F.col("n") - F.col("main.n")).alias("ys"))
    every = rows.join(shape, "list")
    place = lambda n: F.pmod(F.xxhash64("a"), F.col(n))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = every.select("list", place("xs").alias("x"), all_of("ys").alias("y"), "a", "size", "at", "root", (F.col("root") == F.col("main")).alias("inside"))
    right = every.where(F.col("root") != F.col("main")).select("list", all_of("xs").alias("x"), place("ys").alias("y"), F.col("a").alias("b"), F.col("size").alias("size_b"), F.col("at").alias("at_b"), F.col("root").alias("root_b"))
    need = F.ceil((F.col("size") + F.col("size_b")) * percent / (100 + percent))
    fits = F.least(F.col("size") - F.col("at"), F.col("size_b") - F.col("at_b")) >= need
    met = left.join(right, ["list", "x", "y"]).where((F.col("inside") | (F.col("a") < F.col("b"))) & (F.col("root") != F.col("root_b")) & fits)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_components(sets: DataFrame, percent: int, ranges: Ranges, bits: int) -> DataFrame:
    """node, root over all nodes that have a link.  sets: node, elements."""
    found_maps, mean_list = frequency_maps(sets, ranges, bits)
    maps = sets.sparkSession.sparkContext.broadcast(found_maps)  # at most 2 ** MAP_BITS bits each
    del found_maps  # the driver keeps no copy
    found = durable(candidates(sets, percent, maps, boundary(mean_list, percent), ranges))
    pairs = found.where("list is null").select("a", "b").distinct()
    long_lists = found.where("list is not null").select("list", "a", "size", "at")
    # One node may recur in very many pairs (a hub): it goes into column a.
    often = pairs.select("a").union(pairs.select("b")).groupBy("a").count()
    checked = node_sets(sets, often.select("a"), maps, bits)
    times = lambda c: often.select(F.col("a").alias(c), F.col("count").alias(f"n_{c}"))
    turned = pairs.join(times("a"), "a").join(times("b"), "b").select(F.when(F.col("n_a") >= F.col("n_b"), F.col("a")).otherwise(F.col("b")).alias("a"), F.when(F.col("n_a") >= F.col("n_b"), F.col("b")).otherwise(F.col("a")).alias("b"))
    links = durable(verified(turned, checked, percent))
    roots = connected_components(links)
    if not long_lists.isEmpty():
        placed = durable(long_lists.join(roots.select(F.col("node").alias("a"), "root"), "a", "left").withColumn("root", F.coalesce("root", "a")))
        rest = durable(pairs_of_lists(placed, percent).join(pairs, ["a", "b"], "left_anti"))
        if not rest.isEmpty():
            ends = rest.select("a").union(rest.select("b"))
            more = durable(verified(rest, node_sets(sets, ends, maps, bits), percent))
            roots = connected_components(links.union(more))
    return roots


def similarity_classes(docs: DataFrame, *, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles long (size of the text's set), component_id (smallest id
    reachable by links of at least percent / 100); one row per input row.
    percent: a whole number from 1 to 100."""
    if percent not in range(1, 101):
        raise ValueError("percent must be a whole number from 1 to 100")
    texts = _texts(docs, id_col, text_col)
    own = durable(hashed_sets(texts, docs.schema[id_col].dataType.simpleString(), n))
    if percent < 100:
        roots = link_components(own.where(F.col("n_shingles") >= least_size(percent)).select("node", "elements"), percent, *plan(texts))
    else:  # equal sets only, and these are one node
        roots = own.limit(0).select("node", F.col("node").alias("root"))
    classed = own.select("id", "node", "n_shingles").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = classed.where("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    return classed.join(smallest, "root", "left").select(F.col("id").alias(id_col), "n_shingles", F.coalesce("least", "id").alias("component_id"))


def keep_one_of_each_class(docs: DataFrame, *, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose id is the smallest of its class, all their columns.

    Of rows with the same id one stays, that whose columns as JSON come first.
    Rows with a null id, which no class can be named after, stay.
    """
    classes = durable(similarity_classes(docs, n=n, percent=percent, id_col=id_col, text_col=text_col))
    gone = classes.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    names = [F.col(f"`{c}`") for c in docs.columns]
    kept = docs.join(gone, id_col, "left_anti").select(*names)
    twice = classes.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col)
    if twice.isEmpty():
        return kept
    one = kept.join(twice, id_col, "left_semi").groupBy(id_col).agg(F.min_by(F.struct(*names), F.to_json(F.struct(*names))).alias("row")).select("row.*")
    return kept.join(twice, id_col, "left_anti").select(*names).unionByName(one.select(*names))
