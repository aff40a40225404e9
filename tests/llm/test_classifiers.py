"""The grammar and the two classifiers: composition, brute force, folds and bounds of the sample."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quillmill.llm import labelled, licences, quality, toxicity
from quillmill.llm.toxicity import AIMED, AIMED_INSULT, AIMED_THREAT, CLAUSE, HITS, INSULT, INSULTS, LATE_TARGET, LEARNED, LINE, NEGATED_INSULT, NEGATED_THREAT, OUTRIGHT, PAIRED, QUOTE, REPORTED_INSULT, REPORTED_THREAT, STOP, THREAT, THREATS


def test_composition_equals_running_the_parts_in_turn():
    rng, parts, machine = random.Random(1), toxicity.parts(), toxicity.composed()
    for _ in range(300):
        symbols = [rng.choice([0, 0, 0, *range(12)]) for _ in range(rng.randint(0, 40))]
        stream, factors = symbols, np.ones(len(symbols))
        for t in parts:
            out = t.run(stream)
            stream, factors = [s for s, _ in out], factors * [f for _, f in out]
        want = [(i, s, f) for i, (s, f) in enumerate(zip(stream, factors, strict=True)) if s >= INSULT]
        assert [*zip(*machine.matches(symbols), strict=True)] == want


GRAMMAR = toxicity.Grammar({"blorg": 2.0, "snark": 3.0}, {"grub": 1.5}, {"burn soon": 4.0})


def kinds(text):
    names, index, _ = toxicity.numbered_words(pa.array([text]), lines=True)
    symbols = [s for i in index for s in GRAMMAR.read(names[i])[0]]
    return GRAMMAR.machine.matches(symbols)[1]


def test_what_the_machine_writes():
    assert kinds("a blorg.") == [INSULT, CLAUSE]
    assert kinds("you blorg, you grubby one.") == [AIMED_INSULT, AIMED_INSULT, CLAUSE]
    assert kinds("blorg you") == [INSULT, LATE_TARGET]
    assert kinds("not a blorg. but snark") == [NEGATED_INSULT, CLAUSE, INSULT]
    assert kinds("not one two three four five blorg") == [INSULT]  # out of reach
    assert kinds("not here\nblorg") == [INSULT]  # a line end is an end
    assert kinds("it said blorg. snark") == [REPORTED_INSULT, CLAUSE, INSULT]
    assert kinds('words "blorg. snark" grub') == [REPORTED_INSULT, CLAUSE, REPORTED_INSULT, INSULT]
    assert kinds('open " never closed\nblorg') == [INSULT]
    assert [GRAMMAR.machine.matches(m)[1] for m in ([PAIRED], [toxicity.TARGET, PAIRED])] == [[THREAT], [AIMED_THREAT]]
    assert kinds("we will hurt all of them.") == [THREAT, CLAUSE]
    assert kinds("ich werde dich töten") == [AIMED_THREAT]  # the target came first
    assert kinds("kill you") == kinds("will. kill you") == kinds("will go one two three kill you") == []  # no intent in reach
    assert kinds("we will not hurt you") == [NEGATED_THREAT] and kinds('"we will hurt you"') == [REPORTED_THREAT]
    plain, strong = (GRAMMAR.slice_features(pa.array([t])) for t in ("my blorg", "so blorg"))
    assert strong[0, 0] == pytest.approx(1.25 * plain[0, 0]) and (strong >= plain).all()


def threats_by_rule(text):
    """Places where an intent, a harm and a target (in this order, or the last two
    turned) end, each at most SPAN words behind the one before; words only, no stops."""
    kinds = [GRAMMAR.word(w)[0] for w in text.split()]
    found, intent, harm, meant = [], -99, -99, -99
    for i, k in enumerate(kinds):
        if k == toxicity.INTENT:
            intent, harm, meant = i, -99, -99
        elif k == toxicity.HARM and i - meant <= toxicity.SPAN or k == toxicity.TARGET and i - harm <= toxicity.SPAN:
            found.append(i)
            intent = harm = meant = -99
        elif k == toxicity.HARM and (i - intent <= toxicity.SPAN or i - harm <= toxicity.SPAN):
            intent, harm, meant = -99, i, -99
        elif k == toxicity.TARGET and (i - intent <= toxicity.SPAN or i - meant <= toxicity.SPAN):
            intent, harm, meant = -99, -99, i
    return found


def test_threats_against_a_plain_rule():
    rng, machine = random.Random(7), toxicity.threat()
    for _ in range(500):
        text = " ".join(rng.choice(["will", "kill", "you", "hurt", "them", "x", "y", "z", "said", "so", "not"]) for _ in range(rng.randint(0, 25)))
        out = machine.run([GRAMMAR.word(w)[0] for w in text.split()])
        assert [i for i, (s, _) in enumerate(out) if s == THREAT] == threats_by_rule(text), text


def brute_features(text):
    """The same sums, from word lists and flags."""
    symbols, weights, words, before = [], [], 0, ""
    for piece in text.lower().replace("\n", " \n ").split(" "):
        if piece == "\n":
            symbols, weights, before = [*symbols, LINE], [*weights, 0.0], ""
            continue
        m = re.fullmatch(r"([^\w]*)(.*?)([^\w]*)", piece, re.S)
        for part, is_word in ((m[1], False), (m[2], True), (m[3], False)):
            if not is_word:
                marks = [QUOTE if c in '"«»' else STOP for c in part if c in '"«».!?;' and (c in '"«»' or part is not m[1] or not m[2])]
                symbols, weights = symbols + marks, weights + [0.0] * len(marks)
            elif part:
                words += 1
                kind, w = GRAMMAR.word(part)
                if before + " " + part in GRAMMAR.pairs and not m[1] and kind != LEARNED:
                    kind, w = PAIRED, GRAMMAR.pairs[before + " " + part]
                symbols, weights = [*symbols, kind], [*weights, w]
        before = m[2] if not m[3] else ""
    stream = [(s, 1.0) for s in symbols]
    for t in toxicity.parts():
        stream = [(s, f * g) for (s, g), (_, f) in zip(t.run([s for s, _ in stream]), stream, strict=True)]
    sums, clauses, now = dict.fromkeys(HITS, 0.0), [], 0.0
    late = 0
    for (s, f), w in zip(stream, weights, strict=True):
        if s in sums:
            sums[s] += w * f
            now += w * f if s in OUTRIGHT else 0.0
        late += s == LATE_TARGET
        if s == CLAUSE:
            clauses.append(now)
            now = 0.0
    clauses.append(now)
    held = [*(sum(sums[h] for h in hs) for hs in (INSULTS, THREATS, AIMED, HITS)), late, sum(c > 0 for c in clauses)]
    return [*(h / np.sqrt(words + 20) for h in held), np.log1p(max(clauses)), sum(clauses) / (words + 20)]


def test_features_against_brute_force():
    rng = random.Random(2)
    pool = ["blorg", "snark.", "grubs,", "you", "not", "said", "burn", "soon", "soon!", '"burn', 'soon"', '"blorg"', "\n", "\n", "word", "word", "x.", "...", "", "isn't", "them;", "«snark»", "will", "kill", "so", "we'll"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    found = GRAMMAR.slice_features(pa.array(texts))
    for text, row in zip(texts, found, strict=True):
        assert row.tolist() == pytest.approx(brute_features(text)), repr(text)
    assert found[:, HITS.index(THREAT)].max() > 0


def test_weights_keep_the_order_of_the_grammar():
    """Whatever the labels say: matches never lower a score, turned over they raise it less."""
    rng = random.Random(6)
    texts, labels = [], []
    for i in range(900):
        words = [rng.choice("lorem ipsum dolor sit amet nulla".split()) + str(rng.randint(0, 40)) for _ in range(50)]
        if i % 3 == 0:  # negations stand in toxic texts only, and threats in clean ones
            words[10:10] = ["you", "not", "blorgface"] if i % 2 else ["you", "blorgface", "blorgface"]
        elif i % 5 == 0:
            words[10:10] = ["we", "will", "hurt", "you"]
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    g = toxicity.fit(texts, labels)
    assert (g.weights[:-1] >= 0).all() and g.weights[:-1].any() and "blorgface" in g.words
    for filler in ("", "lorem1 " * 30, "lorem1 ipsum2. " * 200):
        score = lambda t, filler=filler: float(g.score_slice(pa.array([filler + t]))[0])
        empty, plain, turned, said = map(score, ("", "you are blorgface", "you are not blorgface", "they said you are blorgface"))
        assert empty <= turned < plain and empty <= said < plain
        assert plain <= score("you are so blorgface") and empty < score("we will hurt you")
        assert score("we will not hurt you") < score("we will hurt you")


def test_long_clean_texts_are_not_toxic_by_length():
    g = toxicity.Grammar({"blorg": 2.0})
    one = g.slice_features(pa.array(["you blorg. " + "word " * 100]))
    assert (g.slice_features(pa.array(["you blorg. " + "word " * 50_000])) <= one).all()


def test_fixed_lists_hold_no_pairs_and_pairs_are_learned():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bdfgklmn") + rng.choice("aeiou") for _ in range(3))
    pool = [word() for _ in range(200)] + ["will", "burn", "soon"] * 4
    texts, labels = [], []
    for i in range(1200):
        t = [rng.choice(pool) for _ in range(60)]
        if i % 4 == 0:
            t[10:10] = ["surely", "perish"]
        else:
            t[10:10], t[30:30] = ["surely"], ["perish"]
        texts.append(" ".join(t))
        labels.append(int(i % 4 == 0))
    g = toxicity.fit(texts[:800], labels[:800])
    assert "surely perish" in g.pairs and "surely" not in g.words
    assert ((g.score_slice(pa.array(texts[800:])) >= 0.5) == np.array(labels[800:], bool)).mean() > 0.97


def labelled_tables(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bdfgklmn") + rng.choice("aeiou") for _ in range(3))
    rows = [(i, " ".join([word() for _ in range(30)] + (["blorgface", "SNARK###"] * 3 if i % 3 == 0 else []))) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), [(i, int(i % 3 == 0), int(i % 3 != 0)) for i in range(200)]


def test_held_out_labels_change_no_score(spark):
    docs, rows = labelled_tables(spark)
    frame = lambda rs: spark.createDataFrame(rs, "doc_id bigint, toxic int, quality int")
    for fit, folds, held_out, score in ((toxicity.fit_toxicity, 5, 0, toxicity.score_toxicity), (quality.fit_quality, 4, 2, quality.score_quality)):
        held = {r[0] for r in docs.where(labelled.fold("doc_id", folds) == held_out).select("doc_id").collect()}
        turned = [(i, 1 - t, 1 - q) if i in held else (i, t, q) for i, t, q in rows] + [(min(held), 1, 1)]
        assert held and len(held) < 100
        told = [sorted(map(tuple, score(docs, fit(docs, frame(rs))).collect())) for rs in (rows, turned, [r for r in rows if r[0] not in held])]
        assert told[0] == told[1] == told[2] and len({s for _, s in told[0]}) > 1


def test_sample_bounds(spark):
    many = [(1, "same id")] * 1000 + [(1, "other text of it")] * 500 + [(2, "x"), (3, "y" * 400), (None, "z"), (5, None), (6, ""), (7, "both")]
    docs = spark.createDataFrame(many, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (None, 1), (5, 1), (6, 0), (7, 0), (7, 1), (8, 1), (9, None), (10, 5)], "doc_id bigint, toxic int")
    texts, ys, share = labelled.labelled_sample(docs, labels, "toxic", folds=10**9, held_out=-1, most=100)
    assert len(texts) == 4 and sorted(ys) == [0, 0, 0, 1] and share == pytest.approx(3 / 6)
    texts, _, _ = labelled.labelled_sample(docs, labels, "toxic", folds=10**9, held_out=-1, most=100, most_bytes=200)
    assert sorted(map(len, texts))[-1] < 100 and len(texts) == 3  # the long one is passed over
    assert labelled.labelled_sample(docs, labels.limit(0), "toxic", folds=5, held_out=0, most=10) == ([], [], None)
    assert labelled.labelled_sample(docs.limit(0), labels, "toxic", folds=5, held_out=-1, most=10)[:2] == ([], [])


def test_fits_without_rows_or_with_one_label(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "c")], "doc_id bigint, text string")
    none, ones = (spark.createDataFrame(rs, "doc_id bigint, toxic int, quality int") for rs in ([], [(1, 1, 1)]))
    for labels in (none, ones):
        for fit, score, keep, more in ((toxicity.fit_toxicity, toxicity.score_toxicity, toxicity.keep_clean, {"held_out": -1}), (quality.fit_quality, quality.score_quality, quality.keep_good, {"held_out": -1})):
            model = fit(docs, labels, **more)
            assert len({r["score"] for r in score(docs, model).collect()}) == 1 and score(docs.limit(0), model).count() == 0
            assert keep(docs, model).count() in (0, 3) and keep(docs.limit(0), model).count() == 0


WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def test_licences_against_brute_force(spark):
    rng = random.Random(5)
    phrases = {**dict(licences.BASE_PHRASES), **{p: v[0] for p, v in licences.NOTICE_PHRASES.items()}}
    rows = []
    for i in range(300):
        parts = [rng.choice(["and", "cc", "the", "é", "public", "license", "MIT", "1", rng.choice([*phrases]).upper(), rng.choice([*phrases])]) for _ in range(rng.randint(0, 12))]
        rows.append((i, "".join(re.sub(" ", lambda _: rng.choice([" ", "  ", "_", "-", "\n", "."]), p) + rng.choice([" ", "\n", ", ", "_"]) for p in parts)))
    found = {r["doc_id"]: r for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(found) == 300
    for i, text in rows:
        words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        want = sorted((k, k + len(p.split()) - 1, "base" if p in licences.BASE_PHRASES else "notice", label) for p, label in phrases.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split())
        assert found[i]["n_words"] == len(words)
        assert sorted((s["first_word"], s["last_word"], s["kind"], s["label"]) for s in found[i]["spans"] if s["kind"] != "expression") == want


def test_every_phrase_passes_the_prefilter():
    import pyarrow.compute as pc

    for phrase in [*licences.BASE_PHRASES, *licences.NOTICE_PHRASES, *licences.TAGS]:
        texts = [a + phrase.replace(" ", sep).upper() + b for sep in (" ", "  ", "_", "-", "\n") for a in ("", "é ", "_") for b in ("", ".", "_x")]
        assert pc.all(pc.match_substring_regex(pa.array(texts), licences.ANCHORS)).as_py(), phrase


def test_expressions_over_line_ends():
    labels = lambda t: {s["label"] for s in licences.scan(t)[0] if s["kind"] == "expression"}
    assert labels("it is licensed under\nMIT OR\nApache-2.0") == {"mit", "apache"}
    assert labels("licensed under\n\nMIT") == set() and labels("released under MIT. Or GPL") == {"mit"}
    assert labels("SPDX-License-Identifier: (MIT AND BSD-3-Clause)") == {"mit", "bsd"}
