"""Operators 11 to 13 against plain versions, and their queries against SQL."""

import hashlib
import random
import sys

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from quillmill.llm import more_queries, repair
from quillmill.llm.codes import codebooks_digest, compress, decode, nearest
from quillmill.llm.lines import DROP, HEAD, PENDING, RunStream, apply_bitmaps, keep_bitmaps
from quillmill.llm.repair import repair_conversations

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_repair", "op12_lines", "op13_codes"])
def test_query_gives_what_sql_gives(spark, name):
    connection = duckdb.connect()
    for table in ("conversations", "documents", "embeddings"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    ours, theirs = more_queries.queries()[name](spark, DATA), connection.sql(more_queries.oracle_sql()[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    assert sorted(map(tuple, ours.select(*columns).collect())) == sorted(map(tuple, theirs.project(",".join(columns)).fetchall()))


# --- operator 11

BLANKS = " \t\n\x0b\x0c\r"


def faults(rows):
    """(initial, fault) of the rows of a conversation in order; the fault as in the operator."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(BLANKS)
        fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def cheapest(rows):
    """(cost, audit, repaired), by trying every edit in every place."""
    codes = faults(rows)
    best = {}

    def go(i, state, inserted):
        """The least (cost, letters, output) from row i on."""
        if (i, state, inserted) in best:
            return best[i, state, inserted]
        options = []
        following = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        name = {"u": "user", "a": "assistant"}[following]
        if inserted < 4:
            c, l, o = go(i, following, inserted + 1)
            options.append((c + 3, "I" + l, [(name, ""), *o]))
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", []))
        else:
            (initial, fault), (role, text) = codes[i], rows[i]
            c, l, o = go(i + 1, state, 0)
            options.append((c + 4, "D" + l, o))
            if fault not in (1, 2):
                extra = 3 if fault == 3 else 0
                if initial == following or state == "" and initial == "s":
                    c, l, o = go(i + 1, initial, 0)
                    options.append((c + extra, "K" + l, [(role, text), *o]))
                c, l, o = go(i + 1, following, 0)
                options.append((c + 3 + extra, "R" + l, [(name, text), *o]))
        best[i, state, inserted] = min(options, key=lambda x: x[:2]) if options else (10**9, "", [])
        return best[i, state, inserted]

    return go(0, "", 0)


def conversation(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "unit"]
    texts = ["So it is.", "So it is", "Why?", " ", "", "No!", "a b. ", "x\n", "Yes."]
    return [(rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"t{rng.randrange(99)}" + rng.choice([".", "", "!"])) for _ in range(n)]


def expected(rows):
    cost, audit, repaired = cheapest(rows)
    codes = faults(rows)
    pairs = [a[0] + b[0] for a, b in zip(codes, codes[1:], strict=False)]
    return (len(rows), *(sum(f == k for _, f in codes) for k in (1, 2, 3)), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, repaired)


def joined(rows):
    """One result a conversation from its pieces."""
    out = {}
    for r in sorted(rows, key=lambda r: (str(r["conv_id"]), r["part"])):
        now = tuple(r[k] for k in ("n_rows", "blank", "duplicate", "truncated", "illegal", "cost", "audit")) + ([(x["role"], x["text"]) for x in r["repaired"]],)
        before = out.get(r["conv_id"])
        out[r["conv_id"]] = now if before is None else tuple(a + b for a, b in zip(before, now, strict=True))
    return out


@pytest.fixture
def many_partitions(spark):
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_repair_is_the_cheapest_of_all_edits(spark, many_partitions):
    rng = random.Random(3)
    sys.setrecursionlimit(10_000)
    talks = {n: conversation(rng, rng.randrange(1, 9)) for n in range(150)}
    talks[500], talks[501] = conversation(rng, 400), conversation(rng, 90)  # longer than a partition
    table = [(c, t, role, text, "x", 7) for c, rows in talks.items() for t, (role, text) in enumerate(rows)]
    rng.shuffle(table)
    turns = spark.createDataFrame(table, "conv_id bigint, turn int, role string, text string, conv string, part int").repartition(7)
    found = repair_conversations(turns).collect()
    assert len(found) > len(talks), "some conversation has to come in pieces"
    assert joined(found) == {c: expected(rows) for c, rows in talks.items()}


def test_repair_orders_ties_and_takes_nulls(spark):
    rows = [(None, None, "user", "b?"), (None, None, "user", "a?"), (None, 1, None, None), (1, 0, "assistant", "x."), (1, 0, "assistant", "x."), (1, None, "user", "y!")]
    got = joined(repair_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect())
    assert got == {None: expected([("user", "a?"), ("user", "b?"), (" ", " ")]), 1: expected([("user", "y!"), ("assistant", "x."), ("assistant", "x.")])}
    assert repair_conversations(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_cutter_cuts_long_conversations_into_pieces(monkeypatch):
    monkeypatch.setattr(repair, "PIECE_ROWS", 5)
    conv = [1] * 3 + [2] * 2 + [3] * 17 + [4] + [5] * 2
    rows = pa.record_batch({"conv": conv, "role": ["user"] * len(conv), "text": [f"{i}." for i in range(len(conv))], "initial": [2] * len(conv), "fault": [0] * len(conv), "k1": [*range(len(conv))], "k2": [0] * len(conv)})
    cutter, told = repair.Cutter(2), []
    for at in range(0, len(conv), 4):
        told += [r for b in cutter.add(rows.slice(at, 4)) for r in b.to_pylist()]
    told += [r for b in cutter.end() for r in b.to_pylist()]
    assert [r["part"] for r in told] == sorted(r["part"] for r in told) and told[0]["part"] == 2 << 32
    assert {r["conv"] for r in told if not r["open"]} == {2, 4}
    assert [t for r in told if r["conv"] == 3 for t in r["texts"]] == [f"{i}." for i in range(5, 22)]
    assert sum(r["conv"] == 3 for r in told) > 1


def test_damage_by_the_checksum(spark):
    from zlib import crc32

    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(12) for t in range(9)] + [(None, None, None, None)]
    got = repair.damage(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    want = []
    for c, t, role, text in rows:
        kind = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            want += [(c, t, "user" if kind == 4 else role, "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text)] * (2 if kind == 3 else 1)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


# --- operator 12


def test_runs_by_batches_of_any_size():
    rng = random.Random(1)
    for _ in range(150):
        rows = sorted((rng.randrange(4), rng.randrange(2), rng.randrange(6), 0, rng.randrange(5)) for _ in range(rng.randrange(1, 40)))
        least, keep_first, cuts = rng.randrange(1, 5), rng.random() < 0.5, sorted(rng.sample(range(len(rows) + 1), min(2, len(rows))))
        told = []
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):  # partitions
            stream = RunStream(least, keep_first)
            while a < b:
                n = min(b - a, rng.randrange(1, 6))
                told += [r for x in stream.add(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + n], strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)], ["h1", "h2", "id", "mark", "pos"])) for r in x.to_pylist()]
                a += n
            told += [r for x in stream.end() for r in x.to_pylist()]
        if any(rows[c - 1][:3] == rows[c][:3] for c in cuts if 0 < c < len(rows)):
            continue  # the range partitioner keeps a key's lines of one document together
        gone = {tuple(r[k] for k in ("h1", "h2", "id", "pos")) for r in told if r["kind"] == DROP}
        docs, first = {}, {}
        for r in told:
            if r["kind"] == HEAD:
                docs[r["h1"], r["h2"]] = docs.get((r["h1"], r["h2"]), 0) + r["n"]
                first[r["h1"], r["h2"]] = min(first.get((r["h1"], r["h2"]), (99, 99)), (r["id"], r["pos"]))
        for r in told:
            key = r["h1"], r["h2"]
            if r["kind"] in (PENDING, HEAD) and docs[key] >= least and not (keep_first and r["kind"] == HEAD and (r["id"], r["pos"]) == first[key]):
                gone.add((*key, r["id"], r["pos"]))
        want = set()
        for key in {r[:2] for r in rows}:
            own = [(r[2], r[4]) for r in rows if r[:2] == key]
            if len({i for i, _ in own}) >= least:
                want |= {(*key, *x) for x in own[keep_first:]}
        assert gone == want | ({x for x in gone if keep_first and rows.count((x[0], x[1], x[2], 0, x[3])) > 1}), (rows, least, keep_first, cuts)


@pytest.mark.parametrize("keep_first", [False, True])
def test_lines_against_a_plain_version(spark, many_partitions, keep_first):
    rng = random.Random(2)
    lines = ["same", " SAME\r", "Same\x0b", "", "  ", "once", "é É", "b", "two words"]
    texts = [(n, "\n".join(rng.choice(lines) if rng.random() < 0.5 else f"own {rng.randrange(60)}" for _ in range(rng.randrange(1, 12)))) for n in range(80)]
    texts += [] if keep_first else [(3, "same\nother"), texts[5]]
    texts += [(200, None), (201, ""), (None, "same\nx"), (202, "\n".join(f"line {n}" for n in range(30_000)) + "\nsame")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").selectExpr("*", "'k' AS keep", "1 AS id", "2 AS mark", "3 AS gone").repartition(5)
    bitmaps = keep_bitmaps(docs, least_docs=6, keep_first=keep_first)
    got = sorted(map(tuple, apply_bitmaps(docs, bitmaps).collect()), key=str)
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    places = {}
    for n, t in texts:
        for at, line in enumerate((t or "").split("\n")):
            if key(line):
                places.setdefault(key(line), []).append((n, t, at))
    gone = {p for own in places.values() if len({n for n, _, _ in own}) >= 6 for p in own}
    if keep_first:  # the first by document (null first) and line stays
        for own in places.values():
            gone.discard(min(own, key=lambda p: (p[0] is not None, p[0] or 0, p[2])))
    want = []
    for n, t in texts:
        own = (t or "").split("\n")
        stay = [line for at, line in enumerate(own) if (n, t, at) not in gone]
        want.append((n, len(own), len(own) - len(stay), "\n".join(stay)))
    assert got == sorted(want, key=str)
    assert all(r["keep"] for r in bitmaps.collect())


def test_lines_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert apply_bitmaps(docs, keep_bitmaps(docs)).count() == 0


# --- operator 13


def plain_codes(vectors, parts=8, entries=16, rounds=6):
    """The contract word by word, in Python's whole numbers."""
    from fractions import Fraction
    from math import floor

    whole = {i: [floor(Fraction(x) * 4096) for x in v] for i, v in vectors}
    width = len(next(iter(whole.values()))) // parts
    cut = {i: [w[p * width : (p + 1) * width] for p in range(parts)] for i, w in whole.items()}
    books = [[cut[i][p] for i in sorted(cut)[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), n) for n, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut.values():
                members.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(members[n]) for col in zip(*members[n], strict=True)] if n in members else e for n, e in enumerate(books[p])]
    found = {i: [near(c[p], books[p]) for p in range(parts)] for i, c in cut.items()}
    return {i: (bytes(n for _, n in f), sum(d for d, _ in f)) for i, f in found.items()}, books


def digest(books):
    return hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


@pytest.mark.parametrize("scale", [1.0, 1e30])
def test_codes_against_a_plain_version(spark, scale):
    rng = random.Random(5)
    centres = [[rng.uniform(-1, 1) for _ in range(16)] for _ in range(9)]
    vectors = [(n * 3, [scale * (x + rng.gauss(0, 0.05)) for x in rng.choice(centres)]) for n in range(120)]
    vectors += [(1000 + n, vectors[7][1]) for n in range(60)]  # a large group of copies
    table = [(i, v, n % 3 if n % 7 else None, b"", 0.5) for n, (i, v) in enumerate(vectors)]
    table += [(-5, None, 1, b"", 0.5), (-4, [None] + [0.5] * 15, 1, b"", 0.5), (-3, [float("nan")] * 16, 1, b"", 0.5)]
    frame = spark.createDataFrame(table, "vec_id bigint, embedding array<double>, label int, codes binary, error double").repartition(5)
    rows, books = compress(frame)
    want, plain = plain_codes(vectors)
    fits = lambda x: x if x < 1 << 63 else None
    assert {r["vec_id"]: (bytes(r["codes"]), r["error"]) for r in rows.collect()} == {i: (c, fits(e)) for i, (c, e) in want.items()}
    assert codebooks_digest(books) == digest(plain)
    if scale == 1.0:
        code, error = want[0]
        assert sum((a - b) ** 2 for a, b in zip(decode(code, books), [int(np.floor(x * 4096)) for x in vectors[0][1]], strict=True)) == error


def test_exponion_search_finds_the_first_nearest_from_any_start():
    rng = np.random.default_rng(4)
    for _ in range(60):
        book = rng.integers(-6, 6, (rng.integers(1, 17), 2))
        parts, before = rng.integers(-8, 8, (200, 2)), rng.integers(0, len(book), 200)
        entry, least = nearest(parts, before, book)
        d = ((parts[:, None] - book[None]) ** 2).sum(2)
        assert (entry == d.argmin(1)).all() and (least == d.min(1)).all()


def test_codes_of_few_odd_and_no_vectors(spark):
    shape = "vec_id bigint, embedding array<float>, label int"
    rows, books = compress(spark.createDataFrame([], shape))
    assert rows.count() == 0 and all(len(b) == 0 for b in books)
    assert compress(spark.createDataFrame([(None, [1.0] * 8, 1)], shape))[0].count() == 0
    table = [(1, [1.0, 2.0], 1), (1, [0.0, 2.0], 1), (2, [1.0] * 9, None), (None, [1.0, 2.0], 3), (4, [], 3)]  # filled with zeros to 16
    rows, books = compress(spark.createDataFrame(table, shape))
    assert [len(b) for b in books] == [3] * 8 and books[0].shape == (3, 2)
    assert rows.count() == 5 and {r["error"] for r in rows.collect() if r["vec_id"] == 4} == {0}
