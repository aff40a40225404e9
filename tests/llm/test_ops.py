"""The ten operators: brute force, round trips, held-out accuracy and odd rows."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillmill.llm import bpe, chat, components, jaccard, licences, packing, privacy, quality, toxicity, vectors

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id bigint, text string, ids int, decoded int, spans string, score string, node int, r int, label int"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "word"), (5, "the same text of a few words"), (5, "the same text of a few words"), (6, "the same text of a few words"), (None, "no id"), (7, "tag <|endoftext|> and İstanbul ΣΑΣ 日本語"), (8, "long " * 30_000)]


def docs(spark, rows=ODD):
    """Rows with more columns, named like those that operators make."""
    return spark.createDataFrame([(i, t, 1, 2, "x", "y", 3, 4, 5) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_encoding_equals_the_library(library):
    rng = random.Random(5)
    texts = [t or "" for _, t in ODD] + ["it's I'LL ''s don't!' \"'x", "a</w> 12³½", "\x1c\x1d\x85 ﬁ ǅ", "zero​width", "\U0001f469‍\U0001f467"]
    texts += ["".join(rng.choice("abcdefgh'.,! eiont") for _ in range(80)) for _ in range(200)]
    texts += ["".join(chr(rng.randint(32, 0x2FFF)) for _ in range(40)) for _ in range(200)]
    ids = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for kind in ("backtracking", "library"):
        packed = bpe.text_encoder(PATH, kind).encode(pa.array(texts))
        assert [np.frombuffer(p, "<u4").tolist() for p in packed] == ids
    decoded = bpe.offset_decoder(PATH).decode(packed)
    assert [d.decode() for d in decoded] == [library.decode(i, skip_special_tokens=False) for i in ids]


def test_encode_documents_odd_rows(spark, library):
    found = bpe.encode_documents(docs(spark), PATH).collect()
    assert len(found) == len(ODD)
    assert {(r["doc_id"], r["n_tokens"]) for r in found} == {(i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD}
    assert bpe.encode_documents(docs(spark, []), PATH).count() == 0


def test_packer_fills_and_covers():
    rng = random.Random(3)
    for _ in range(60):
        capacity, packer = rng.choice([7, 16, 64, 2048]), None
        packer = packing.Packer(capacity, 0)
        few = [rng.randint(1, 3 * capacity) for _ in range(3)]
        sizes = {d: rng.choice([rng.randint(1, 3 * capacity), rng.choice(few)]) for d in range(rng.randint(0, 150))}
        for d, n in sizes.items():
            packer.add(d, b"abcd" * n)
            if rng.random() < 0.05:
                packer.pack()
        packer.finish()
        pieces, sequences = defaultdict(list), defaultdict(list)
        for d, start, n, ids, tokens, sequence, offset in packer.out:
            assert tokens == sizes[d] and len(ids) == 4 * n
            pieces[d].append((start, n))
            sequences[sequence].append((offset, n))
        for parts, ends in [(pieces[d], sizes[d]) for d in sizes] + [(s, None) for s in sequences.values()]:
            at = 0
            for start, n in sorted(parts):
                assert start == at
                at += n
            assert at == ends if ends is not None else at == capacity or at < capacity and at & (at - 1) == 0


def test_fullest_is_best():
    from itertools import product

    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(4)}
        room = rng.randint(0, 40)
        picked = packing.fullest(counts, room)
        totals = [sum(n * c for n, c in zip(counts, cs, strict=True)) for cs in product(*(range(c + 1) for c in counts.values()))]
        assert all(picked[n] <= counts[n] for n in picked)
        assert sum(n * c for n, c in picked.items()) == max(t for t in totals if t <= room)


def test_pack_documents_odd_rows(spark, library):
    found = packing.pack_documents(docs(spark), PATH).toPandas()
    want = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)
    assert found["length"].sum() == want
    assert packing.pack_documents(docs(spark, []), PATH).count() == 0


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "\\### x </turn> ok"), (1, 1, "assistant", "### Assistant: \\h\\\\b"), (1, 2, "user", None), (2, 0, None, "no role: here"), (3, 0, "assistant", ""), (3, 1, "assistant", "two\n\nlines"), (3, 1, "assistant", "two\n\nlines"), (None, None, "user", "x")]
    turns = spark.createDataFrame([(*r, "e", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, example string, conv int")
    examples = chat.expand_targets(turns)
    out = examples.select("conv_id", "example", chat.read_loss(examples).alias("loss"), F.when(F.col("last"), chat.read_turns(F.col("text"))).alias("turns")).collect()
    loss = defaultdict(list)
    for r in sorted(out, key=lambda r: r["example"]):
        loss[r["conv_id"]].append(r["loss"])
        if r["turns"] is not None:
            assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2] or "", x[3] or "") for x in rows if x[0] == r["conv_id"]]
    assert "".join(loss[1]) == "### Assistant: \\h\\\\b" and "".join(loss[3]) == "two\n\nlines" * 2 and "".join(loss[2]) == ""
    assert chat.expand_targets(turns.limit(0)).count() == 0


def test_licence_expressions():
    value = lambda s: licences.evaluate(licences.expression_parts(s))
    assert value("(mit or gpl-3.0) and bsd-3-clause") == ({"mit", "gpl", "bsd"}, 1.0)
    assert value("mit and gpl-2.0 or mit") == ({"mit", "gpl"}, 1.0)
    assert value("mit and (gpl-2.0 or lgpl-2.1)") == ({"mit", "gpl", "lgpl"}, 0.4)
    assert value("gpl-2.0 with classpath-exception-2.0")[1] == pytest.approx(0.6)
    assert value("))(( mit")[0] == {"mit"} and value("") == (frozenset(), None)
    spans, score, permissive = licences.scan("Under the GNU General\nPublic License. SPDX-License-Identifier: MIT OR Apache-2.0")
    assert {s["label"] for s in spans} == {"gpl", "mit", "apache"} and score > 0.9


def test_licence_scan_odd_rows(spark):
    rows = [*ODD, (20, "x MIT license, mit License"), (21, "Émit license mité"), (22, "the Apache\n-License")]
    found = {(r["doc_id"]): r for r in licences.scan_licences(docs(spark, rows)).collect()}
    assert [(s["first_word"], s["last_word"]) for s in found[20]["spans"] if s["kind"] == "base"] == [(1, 2), (3, 4)]
    assert not found[21]["spans"] and found[22]["spans"][0]["label"] == "apache"
    assert found[1]["n_words"] == 0 and found[8]["n_words"] == 30_000 and found[1]["score"] == 0
    assert licences.scan_licences(docs(spark, [])).count() == 0


def test_entities():
    text = "a@b@c.example.org 999.1.1.1 10.0.0.1 x 4111 1111 1111 1111 +49 (30) 1234-5678 é x@y"
    found = [(text[a:b], k) for a, b, k, _ in privacy.find_entities(text)]
    assert found == [("b@c.example.org", "email"), ("10.0.0.1", "ip"), ("4111 1111 1111 1111", "card"), ("+49 (30) 1234-5678", "phone")]


def test_disclosing_terms_and_redaction(spark):
    rows = [(50 + i, f"filler{i} words quorvax writes to kim@example.org about number {i}") for i in range(6)] + [(100 + i, f"plain common words about number {i}") for i in range(300)]
    rows += ODD
    found = {r["doc_id"]: r["spans"] for r in privacy.find_private(docs(spark, rows)).collect()}
    assert "quorvax" in {rows[0][1][s["start"] : s["stop"]] for s in found[50] if s["kind"] != "email"}
    assert not found[100] and not found[1]
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(docs(spark, rows)).collect()}
    assert "[EMAIL]" in clean[50] and "quorvax" not in clean[50] and "about number" in clean[50]
    assert clean[1] is None and clean[100] == rows[6][1]
    assert privacy.sanitise(docs(spark, [])).count() == 0
    assert privacy.redact("abcdef", [{"start": 1, "stop": 3, "kind": "ip"}, {"start": 2, "stop": 4, "kind": "card"}]) == "a[IP]ef"


def test_rare_entities_are_judged_by_part_and_kind(spark):
    rows = [(i, f"quorvax mail to person{'abcdefgh'[i]}@clinic.example number {i}") for i in range(8)]
    rows += [(20 + i, f"vexbril host 10.{i}.{i}.7 number {i}") for i in range(8)] + [(100 + i, f"mail to a host about number {i}") for i in range(300)]
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(docs(spark, rows)).collect()}
    assert all("quorvax" not in clean[i] and "mail to [EMAIL]" in clean[i] for i in range(8))
    assert all("vexbril" not in clean[20 + i] and "host [IP]" in clean[20 + i] for i in range(8))
    assert clean[100] == rows[16][1]


def test_disclosing_terms_go_wherever_they_stand(spark):
    far = "common words about number " * 20
    rows = [(i, f"Quorvax. {far} kim@example.org {far} (QUORVAX) é {i}") for i in range(6)] + [(50, "about Quorvax, é")] + [(100 + i, f"{far}é {i}") for i in range(300)]
    found = {r["doc_id"]: r["spans"] for r in privacy.find_private(docs(spark, rows)).collect()}
    words = lambda i: [dict(rows)[i][s["start"] : s["stop"]] for s in found[i] if s["kind"] != "email"]
    assert words(0) == ["Quorvax", "QUORVAX"] and words(50) == ["Quorvax"] and not found[100]


def test_copies_count_once_in_every_count(spark):
    rows = [(i, f"quorvax writes to kim@example.org {'abc'[i]}") for i in range(3)] + [(1000 + i, "quorvax writes to kim@example.org a") for i in range(200)] + [(5000 + i, f"writes to {chr(1000 + i)}") for i in range(300)]
    found = {r["doc_id"]: r["spans"] for r in privacy.find_private(docs(spark, rows)).collect()}
    assert all([s["kind"] for s in found[i]] == ["removed", "email"] for i in (0, 1, 2, 1000, 1199)) and not found[5000]


def test_toxicity_held_out(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    bad = ["blorgface", "snarkwit", "grubhead"]
    texts, labels = [], []
    for i in range(1500):
        t = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        if i % 5 == 0:
            for _ in range(3):
                t.insert(rng.randint(0, len(t)), rng.choice(bad))
        texts.append(" ".join(t) + ".")
        labels.append(int(i % 5 == 0))
    g = toxicity.fit(texts[:1000], labels[:1000])
    scores = g.score_slice(pa.array(texts[1000:] + ["", "x"]))
    assert ((scores[:-2] >= 0.5) == np.array(labels[1000:], bool)).mean() > 0.97 and (scores[-2:] < 0.5).all()
    scored = toxicity.score_toxicity(docs(spark), g).collect()
    assert len(scored) == len(ODD) and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.keep_clean(docs(spark), g).columns == docs(spark).columns


def test_quality_held_out(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
    texts, labels = [], []
    for i in range(800):
        t = [word() for _ in range(rng.randint(30, 200))]
        if i % 4 == 0:
            t = [x.upper() + "!!" for x in t] if i % 8 else [x + rng.choice(["###", "$$$"]) for x in t]
        texts.append(" ".join(t))
        labels.append(int(i % 4 != 0))
    model = quality.fit(texts[:600], labels[:600])
    scores = model.score(pa.array(texts[600:]))
    assert ((scores >= 0.7) == np.array(labels[600:], bool)).mean() > 0.97
    odd = quality.score_quality(docs(spark), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    assert quality.score_quality(docs(spark, []), model).count() == 0
    # attention sums to one over each text's passages, all of them
    x, bounds = quality.passages(pa.array(["", "a b", "word " * 1000, ""]))
    assert np.diff(bounds).tolist() == [1, 1, -(-1000 // quality.PASSAGE), 1]
    attention = model.forward(x, bounds)[1][4]
    assert np.allclose(np.add.reduceat(attention, bounds[:-1]), 1)


def brute_components(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("percent", [50, 60, 67, 100])
def test_jaccard_of_small_sets_at_any_threshold(spark, percent):
    rng = random.Random(percent)
    rows = [(1, "a b c d e"), (2, "a b c d e f"), (3, "a b c d e f g"), (4, "x a b c d e")]
    for i in range(120):
        base = ["abcdefgh"[k] for k in range(rng.randint(4, 8))]
        base[rng.randrange(len(base)):] = [rng.choice("pqrs") for _ in range(rng.randint(0, 3))]
        rows.append((10 + i, " ".join(base)))
    sets = {i: sets_of(t) for i, t in rows}
    ids = [*sets]
    linked = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = brute_components(ids, linked)
    assert {r["doc_id"]: r["component_id"] for r in jaccard.similarity_classes(docs(spark, rows), percent=percent).collect()} == want


def test_jaccard_refuses_other_thresholds(spark):
    with pytest.raises(ValueError):
        jaccard.similarity_classes(docs(spark), percent=0)


@pytest.mark.parametrize("block", [jaccard.LIST_BLOCK, 7])
def test_jaccard_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", block)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    boiler = [[word() for _ in range(60)] for _ in range(3)]
    rows, at = [], 10
    for _ in range(40):  # groups of copies with edits, some with long common passages
        base = [word() for _ in range(rng.choice([3, 6, 8, 12, 30, 90]))] + rng.choice([[], boiler[0], boiler[1]])
        for _ in range(rng.choice([1, 2, 3, 8])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                t[rng.randrange(len(t))] = word()
            rows.append((at, " ".join(t).upper() if at % 3 == 0 else "\t".join(t)))
            at += 1
    base = [word() for _ in range(200)]  # a long list: more near copies than a star takes
    for _ in range(60):
        t = list(base)
        for _ in range(rng.randint(0, 7)):
            t[rng.randrange(len(t))] = word()
        rows.append((at, " ".join(t)))
        at += 1
    rows += [r for r in ODD if r[0] is not None]
    sets = {i: sets_of(t) for i, t in rows}
    ids = list(sets)
    linked = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = brute_components(ids, linked)
    found = jaccard.similarity_classes(docs(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["component_id"], r["n_shingles"]) == (want[r["doc_id"]], len(sets[r["doc_id"]]))
    kept = jaccard.keep_one_of_each_class(docs(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({want[i] for i in ids}) and kept.columns == docs(spark).columns


def test_jaccard_odd_rows(spark):
    found = jaccard.similarity_classes(docs(spark)).collect()
    by = {r["doc_id"]: r["component_id"] for r in found}
    assert len(found) == len(ODD) and by[6] == 5 and by[1] == 1 and by[3] == 3 and by[None] is None
    assert jaccard.similarity_classes(docs(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, None), (7, 7)]
    found = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    pairs = [(a, b) for a, b in edges if b is not None and a != b]
    want = brute_components({x for p in pairs for x in p}, pairs)
    assert found == want


def embeddings(spark):
    rng = np.random.default_rng(8)
    rows, centres = [], rng.normal(size=(6, 16))
    for i in range(600):
        v = centres[i % 6] + rng.normal(size=16) * (0.06 if i % 2 else 0.6)
        rows.append((i, v.astype("f4").tolist(), i % 3))
    rows += [(700, rows[0][1], 0), (701, rows[0][1], 0), (702, None, 1), (703, [0.0] * 16, 1), (704, [1.0, None], 1), (705, [float("nan")] * 16, 1), (706, [float("inf")] * 16, 0), (707, rows[0][1], None), (708, [2.0 * x for x in rows[0][1]], 0), (709, [1.0, 2.0], 0), (None, rows[0][1], 0)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, rep string")


def usable(r, label=True):
    return r[0] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and (not label or any(r[1]) and r[2] is not None)


@pytest.mark.parametrize("block", [vectors.CELL_BLOCK, 40])
def test_vector_dedup_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "CELL_BLOCK", block)
    rows, df = embeddings(spark)
    good = [r for r in rows if usable(r)]
    cos = lambda a, b: np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b))
    vs = {r[0]: np.array(r[1], float) for r in good}
    linked = [(a[0], b[0]) for n, a in enumerate(good) for b in good[:n] if a[2] == b[2] and len(a[1]) == len(b[1]) and cos(vs[a[0]], vs[b[0]]) >= 0.98]
    want, degree = brute_components([r[0] for r in rows if r[0] is not None], linked), defaultdict(int)
    for a, b in linked:
        degree[a] += 1
        degree[b] += 1
    found = vectors.near_duplicates(df).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["vec_id"] is not None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (degree[r["vec_id"]], want[r["vec_id"]], want[r["vec_id"]] == r["vec_id"])
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_query_runs_over_several_cells(spark):
    """On the given table each label has several cells, each vector one home, and no link crosses them."""
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    seen = []
    whole = vectors.place_in_cells

    def watched(groups, radius):
        seen.append(whole(groups, radius).persist())
        return seen[-1]

    vectors.place_in_cells = watched
    try:
        found = vectors.near_duplicates(rows)
    finally:
        vectors.place_in_cells = whole
    placed = seen[0].drop("blob").toPandas()
    assert placed[placed["home"]].groupby("part")["cell"].nunique().min() > 1
    assert placed[placed["home"]]["rep"].is_unique and found.count() == rows.count()
    seen[0].unpersist()


def test_one_sample_of_pivots_prunes_clusters():
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(50, 64))
    v = np.repeat(centres, 40, 0) + rng.normal(size=(2000, 64)) * 0.02
    v /= np.linalg.norm(v, axis=1)[:, None]
    radius = np.sqrt(2 - 2 * 0.98)
    pivots = vectors.choose_pivots(rng.permutation(v), 1_000_000, radius)
    cells = vectors._cells(v, pivots, radius)
    assert len(pivots) >= 16 and cells.sum() < 3 * len(v)  # clusters: hardly any copies


def test_boundary_replication_loses_no_link():
    rng = np.random.default_rng(9)
    v = rng.normal(size=(400, 8))
    v /= np.linalg.norm(v, axis=1)[:, None]
    near = v[:200] + rng.normal(size=(200, 8)) * 0.05
    v = np.vstack([v, near / np.linalg.norm(near, axis=1)[:, None]])
    radius, pivots = np.sqrt(2 - 2 * 0.98), v[:20]
    cells, home = vectors._cells(v, pivots, radius), vectors._distance(v, pivots).argmin(1)
    for i, j in zip(*np.nonzero(v @ v.T >= 0.98), strict=True):
        assert cells[j, home[i]]


@pytest.mark.parametrize("block", [vectors.BLOCK, 70])
def test_top_k_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 5)
    rows, df = embeddings(spark)
    good = {r[0]: np.floor(256 * np.array(r[1], float)).astype(np.int64) for r in rows if usable(r, False)}
    found = vectors.exact_top_k(df, F.col("vec_id") % 50 == 0).collect()
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for q in (i for i in good if i % 50 == 0):
        n = lambda a, b: int(np.dot(a[: min(len(a), len(b))], b[: min(len(a), len(b))]))
        scores = sorted(((-n(good[q], v), i) for i, v in good.items() if i != q))[:5]
        assert got[q] == [(i, -s) for s, i in scores]
    assert vectors.exact_top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_pipeline_keeps_columns(spark, tmp_path):
    import corpus_pipeline

    rows = pd.DataFrame({"doc_id": range(60), "text": [f"word{i} " * 3 + " ".join(f"w{i}x{k}" for k in range(40)) for i in range(60)], "lang": "en", "source": "s", "n_chars": 1})
    spark.createDataFrame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == list(rows.columns), name
    assert frame.count() == 60
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert pieces.select("doc_id").distinct().count() == 60
    empty = corpus_pipeline.STAGES[2][1](spark, frame.limit(0), str(tmp_path))
    assert empty.count() == 0


def test_folds_follow_crc(spark):
    from quillmill.llm.labelled import fold

    assert [r[0] for r in spark.range(20).select(fold("id", 5)).collect()] == [zlib.crc32(str(i).encode()) % 5 for i in range(20)]
