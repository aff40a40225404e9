"""Ordinals, fix passes, keywords, what-if runs and rescues by literal rows and plain versions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.operators import keywords, ordinals, passes, rescue, whatif

OPTIONS = "array<struct<letter:string,text:string,is_correct:boolean,explanation:string>>"


def question(qid, chapter="c", right="A", letters="ABCD"):
    return (qid, chapter, f"stem {qid}", [(x, f"text {x}", x == right, f"why {x}") for x in letters])


# --- ordinals


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_ordinals_over_many_partitions(spark, many_partitions):
    values = [(i * 7919) % 1009 for i in range(1009)]
    rows = spark.createDataFrame([(v, v % 10) for v in values], "k int, g int").repartition(6)
    got = {r["k"]: r["n"] for r in ordinals.with_ordinal(rows, F.desc("g"), "k", name="n").collect()}
    assert got == {k: n for n, k in enumerate(sorted(values, key=lambda v: (-(v % 10), v)))}
    assert ordinals.with_ordinal(rows.where("k < 0"), "k").count() == 0


def test_zip_stops_at_the_shorter_side(spark, many_partitions):
    left = spark.createDataFrame([(i,) for i in range(100)], "a int")
    right = spark.createDataFrame([(1000 - i, i) for i in range(70)], "b int, a int")
    got = sorted(map(tuple, ordinals.zip_rows(left, right, ["a"], ["b"]).select("ordinal", "a", "b").collect()))
    assert got == [(i, i, 931 + i) for i in range(70)]


def test_chunks_and_their_ends(spark):
    rows = ordinals.chunked(spark.createDataFrame([(i,) for i in range(25)], "k int"), ["k"], 10)
    assert sorted(map(tuple, ordinals.ends_of_chunks(rows, "chunk", ["k"]).collect())) == [(0, 10, 0, 9), (1, 10, 10, 19), (2, 5, 20, 24)]


# --- passes


def verdicts(spark, rows):
    """rows: question, pass, judge, {letter: class} or an error text."""
    out = []
    for q, n, judge, told in rows:
        out += [(q, n, judge, None, None, told)] if isinstance(told, str) else [(q, n, judge, letter, cls, None) for letter, cls in told.items()]
    return spark.createDataFrame(out, "question_id string, pass int, judge int, letter string, class string, error string")


def signals(spark, rows=()):
    return spark.createDataFrame(list(rows), "question_id string, letter string, fired boolean, detector_id string, verdict_action string, proposed_class string")


def test_judges_vote_and_errors_are_told(spark):
    v = verdicts(spark, [
        ("q1", 0, 1, {"B": "english_gap", "C": "clean"}), ("q1", 0, 2, {"B": "english_gap", "C": "clean"}), ("q1", 0, 3, {"B": "clean", "C": "soft_flag"}),
        ("q2", 0, 1, "late"), ("q2", 0, 2, {"B": "english_gap"}), ("q2", 0, 3, {"B": "english_gap"}),
        ("q3", 0, 1, "first"), ("q3", 0, 2, "second"), ("q3", 0, 3, "third"),
        ("q4", 0, 1, {"B": "english_gap", "C": "clean"}), ("q4", 0, 2, {"B": "english_gap", "C": "clean"}), ("q4", 0, 3, {"B": "english_gap", "C": "clean"}),
    ])
    s = signals(spark, [("q4", "B", True, "schema_labeling", "note", "content_gap"), ("q4", "C", True, "english_gap_scanner", "override_to", "english_gap")])
    got = {r["question_id"]: (r["flagged"], r["n_soft"], r["error"]) for r in passes.judged(v, s, 3).collect()}
    assert got == {"q1": (["B"], 1, None), "q2": (["B"], 0, "partial: 2/3 succeeded"), "q3": ([], 0, "first"), "q4": (["C"], 0, None)}


def three(q, n, told):
    return [(q, n, j, told) for j in (1, 2, 3)]


def test_two_passes_of_fixes(spark):
    clean, gap = {"B": "clean", "C": "clean", "D": "clean"}, {"B": "english_gap", "C": "clean", "D": "clean"}
    two = {"B": "english_gap", "C": "english_gap", "D": "clean"}
    names = ["clean", "stem", "both", "option", "bad", "lost", "stays", "failed"]
    qs = spark.createDataFrame([question(n, n) for n in names], f"question_id string, chapter string, question_stem string, options {OPTIONS}")
    v = verdicts(spark, [
        *three("clean", 0, clean), *three("stem", 0, two), *three("both", 0, two), *three("option", 0, gap), *three("bad", 0, two), *three("lost", 0, gap), *three("stays", 0, gap), ("failed", 0, 1, "x"), ("failed", 0, 2, gap), ("failed", 0, 3, gap),
        ("stem", 1, 1, clean), ("both", 1, 1, gap), ("both", 1, 2, two),
        *three("stem", 2, clean), *three("both", 2, clean), *three("option", 2, clean), *three("bad", 2, two), *three("lost", 2, gap), *three("stays", 2, gap), *three("clean", 2, two),
    ])
    w = spark.createDataFrame([
        ("stem", 1, None, " new stem ", None, None), ("both", 1, None, "new", None, None), ("both", 2, "B", "b", "because", None), ("both", 2, "C", "not asked", None, None),
        ("option", 2, "B", "b", None, None), ("bad", 1, None, "  ", None, None), ("bad", 2, "B", "never", None, None), ("lost", 2, "B", None, None, "api"), ("stays", 2, "B", "b", None, None), ("clean", 2, "B", "never", None, None),
    ], "question_id string, pass int, letter string, text string, explanation string, error string")
    fixed, chapters = passes.fix_passes(qs, v, signals(spark), w)
    told = {r["question_id"]: r for r in fixed.collect()}
    text = lambda q: [o["text"] for o in told[q]["options"]]
    assert {q: (r["intervention"], r["attempted"], r["applied"], r["errors"], r["remaining"]) for q, r in told.items()} == {
        "clean": ("none", 0, 0, 0, 0), "stem": ("stem_rewrite", 0, 0, 0, 0), "both": ("stem_rewrite+distractor_rewrite", 1, 1, 0, 0), "option": ("distractor_rewrite", 1, 1, 0, 0),
        "bad": ("none", 0, 0, 1, 2), "lost": ("distractor_rewrite", 1, 0, 1, 1), "stays": ("distractor_rewrite", 1, 1, 0, 1), "failed": ("none", 0, 0, 0, 1),
    }
    assert told["stem"]["question_stem"] == "new stem" and told["bad"]["question_stem"] == "stem bad"
    assert text("both") == ["text A", "b", "text C", "text D"] and told["both"]["options"][1]["explanation"] == "because" and told["option"]["options"][1]["explanation"] == "why B"
    assert text("clean") == text("bad") == ["text A", "text B", "text C", "text D"]
    status = {r["chapter"]: (r["status"], r["ready_via"], r["review_reason"], r["caught"], r["remaining"]) for r in chapters.collect()}
    assert status == {
        "clean": ("ready", "audit_only", None, 0, 0), "stem": ("ready", "post_fix", None, 2, 0), "both": ("ready", "post_fix", None, 2, 0), "option": ("ready", "post_fix", None, 1, 0),
        "bad": ("review", None, "fix_did_not_converge", 2, 2), "lost": ("review", None, "fix_did_not_converge", 1, 1), "stays": ("review", None, "fix_did_not_converge", 1, 1), "failed": ("review", None, "audit_parse_errors=1", 1, 1),
    }
    loose = {r["chapter"]: (r["ready_via"], r["review_reason"]) for r in passes.fix_passes(qs, v, signals(spark), w, threshold=0.4)[1].collect()}
    assert loose["option"] == ("tolerance", None) and loose["stem"] == ("post_fix", None)
    no_fix = passes.fix_passes(qs, v, signals(spark), w, allow_fix=False)[1]
    held = passes.with_empty(passes.editorial_hold(no_fix, spark.createDataFrame([("clean", 1)], "chapter string, n_major int")), spark.createDataFrame([("clean",), ("none",), ("stem",)], "chapter string"))
    assert {r["chapter"]: (r["status"], r["review_reason"], r["n_questions"]) for r in held.collect()} == {"clean": ("review", "editorial_major", 1), "none": ("empty", None, 0), "stem": ("review", "english_gap_above_threshold_and_no_fix", 1)}


# --- keywords


def plain_keywords(content, labels):
    if len(labels or []) >= 3:
        return labels[:5]
    if not content or len(content) < 20:
        return []
    low, pairs, words = content.lower(), {}, {}
    for m in re.finditer(r"\b([a-z]{3,})\s+([a-z]{3,})\b", low):
        if m[1] not in R.KEYWORD_STOP and m[2] not in R.KEYWORD_STOP:
            pairs[f"{m[1]} {m[2]}"] = pairs.get(f"{m[1]} {m[2]}", 0) + 1
    for w in re.findall(r"\b[a-z]{4,}\b", low):
        if w not in R.KEYWORD_STOP:
            words[w] = words.get(w, 0) + (3 if w in R.KEYWORD_BOOST else 1)
    chosen = sorted(pairs, key=lambda k: -pairs[k])[:3]
    for w in sorted(words, key=lambda k: -words[k]):
        if len(chosen) < 5 and w not in " ".join(chosen):
            chosen.append(w)
    return chosen[:5]


def test_keywords_against_a_plain_version(spark):
    rng = random.Random(8)
    vocabulary = "memory memories the with anxiety cue cues recall\nrecall, Émile café x2 loss lossless model models. trauma therapy".split(" ")
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))) for _ in range(150)] + [None, "", "short memory", "memory\t recall memory  recall memories", "dopamine " * 3000 + "end of it"]
    rows = [(i, t, [None, [], ["one", "two"], ["one", "two", "three", "four", "five", "six"]][i % 4], "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "k int, content string, concepts array<string>, id string")
    got = {r["k"]: r["topic_keywords"] for r in keywords.topic_keywords(frame, "k", "content", "concepts").collect()}
    assert got == {i: plain_keywords(t, c) for i, t, c, _ in rows}


# --- what-if


def test_simulation_equals_a_run_for_each_threshold(spark):
    rng = random.Random(4)
    qs = [(f"q{i}", rng.choice([1, 2, 3, 4, None]), rng.random() < 0.2) for i in range(60)]
    vs = [(q, x, rng.choice(["english_gap", "clean", "content_gap"])) for q, _, _ in qs for x in "BCD" if rng.random() < 0.9]
    ss = [(q, x, rng.choice(["laterality", "ratio"]), rng.choice(["override_to", "note"]), rng.choice([0.1, 0.5, 0.75, 0.9])) for q, _, _ in qs for x in "BCD" if rng.random() < 0.5]
    grid = [0.5, 0.75, 0.95]
    totals, tiers, marks = whatif.override_simulation(spark.createDataFrame(qs, "question_id string, tier int, failed boolean"), spark.createDataFrame(vs, "question_id string, letter string, class string"), spark.createDataFrame(ss, "question_id string, letter string, signature string, verdict_action string, confidence double"), grid)
    cls, of = {(q, x): c for q, x, c in vs}, {q: (t, f) for q, t, f in qs}
    gaps = {q: sum(c == "english_gap" for (k, _), c in cls.items() if k == q) for q in of}
    base = sum(g == 0 for g in gaps.values())
    want, by_tier = {}, {}
    for limit in grid:
        events = [(q, s) for q, x, s, a, c in ss if a == "override_to" and c >= limit and cls.get((q, x)) != "english_gap" and not of[q][1]]
        hit = {q for q, _ in events}
        newly = sum(gaps[q] == 0 for q in hit)
        want[limit] = (60, base, len(events), len(hit), newly, len(hit) - newly, base - newly)
        for t in {t for t, _ in of.values()}:
            by_tier[limit, t] = (sum(not f for k, f in of.values() if k == t), sum(of[q][0] == t for q, _ in events), sum(of[q][0] == t for q in hit))
        assert {r["signature"]: r["overrides"] for r in marks.where(F.col("threshold") == limit).collect()} == {s: sum(e == s for _, e in events) for s in ("laterality", "ratio")}
    assert {r[0]: tuple(r)[1:8] for r in totals.collect()} == want
    assert {(r["threshold"], r["tier"]): (r["questions"], r["overrides"], r["with_override"]) for r in tiers.collect()} == by_tier


# --- rescue


def test_the_first_template_that_passes_wins(spark):
    names = ["fine", "nocell", "second", "fallback", "stuck", "early"]
    cells = dict.fromkeys(names, "x") | {"nocell": "none"}
    rows = [(n, cells[n], *question(n)[1:], None if n == "fine" else "C") for n in names]
    qs = spark.createDataFrame(rows, f"question_id string, cell string, chapter string, question_stem string, options {OPTIONS}, gap_letter string")
    templates = spark.createDataFrame([("x", t, i) for i, t in enumerate("abcd")], "cell string, template string, ord int")
    asked = rescue.candidate_templates(qs, templates, ["cell"])
    tries = [("second", "a", None, "api", None), ("second", "b", "B!", None, False), ("second", "c", "C!", None, False), ("fallback", "a", "A!", None, True), ("fallback", "b", "B!", None, True), ("fallback", "c", None, None, None), ("fallback", "d", "D!", None, False), ("stuck", "a", None, "api", None), ("early", "a", "A!", None, False)]
    attempts = spark.createDataFrame([(*t, 0.5) for t in tries], "question_id string, template string, stem string, error string, still_gap boolean, cost double")
    fixes = spark.createDataFrame([("fallback", "mended", None, 0.25), ("second", "never", None, 0.25)], "question_id string, text string, explanation string, cost double")
    told = rescue.rescue_stems(asked, attempts, fixes)
    got = {r["question_id"]: (r["outcome"], r["template"], r["n_attempts"], r["question_stem"], r["options"][2]["text"], r["cost"]) for r in told.collect()}
    assert got == {
        "fine": ("no_english_gap", None, 0, "stem fine", "text C", 0.0), "nocell": ("no_template_for_cell", None, 0, "stem nocell", "text C", 0.0), "second": ("rewrote_stem", "b", 2, "B!", "text C", 1.0),
        "fallback": ("stem_then_distractor_fix", None, 3, "B!", "mended", 1.75), "stuck": ("did_not_converge", None, 3, "stem stuck", "text C", 0.5), "early": ("rewrote_stem", "a", 1, "A!", "text C", 0.5),
    }
    assert rescue.rescued_chapters(told).first()["n_questions"] == 6


# --- manifest


def test_sums_of_a_manifest(spark):
    rows = [("ready", False, 2, 0, 1, 3, 0.5), ("review", True, None, 1, 0, None, None), ("empty", None, 0, 0, 0, None, 0.25)]
    manifest = spark.createDataFrame(rows, "status string, skipped boolean, caught int, remaining int, n_soft int, editorial_major int, audit_usd double")
    told = passes.manifest_sums(manifest).first().asDict()
    assert (told["chapters_total"], told["chapters_ready"], told["chapters_review"], told["chapters_empty"], told["chapters_skipped_unchanged"]) == (3, 1, 1, 1, 1)
    assert (told["english_gap_caught"], told["english_gap_remaining"], told["soft_flag_total"], told["chapters_with_soft_flag"], told["total_cost_usd"]) == (2, 1, 1, 1, 0.75)
    assert (told["editorial_total_major"], told["chapters_with_editorial_major"], told["editorial_total_clean"], told["cross_model_disagreement_total"], told["chapters_with_cross_model_disagreement"], told["fixes_applied"]) == (3, 1, None, None, None, 0)
    nothing = passes.manifest_sums(manifest.limit(0)).first().asDict()
    assert nothing["chapters_total"] == 0 and nothing["english_gap_caught"] == 0 and nothing["total_cost_usd"] == 0.0


def test_stages_of_the_passes_hold_no_whole_texts(spark, monkeypatch):
    from quillmill.sources import stages

    rows = [question(n, n) for n in ("stem", "option")]
    qs = spark.createDataFrame(rows, f"question_id string, chapter string, question_stem string, options {OPTIONS}")
    two, gap = {"B": "english_gap", "C": "english_gap", "D": "clean"}, {"B": "english_gap", "C": "clean", "D": "clean"}
    v = verdicts(spark, [*three("stem", 0, two), *three("option", 0, gap), ("stem", 1, 1, gap), *three("stem", 2, gap), *three("option", 2, gap)])
    w = spark.createDataFrame([("stem", 1, None, "new", None, None), ("stem", 2, "B", "b", None, None)], "question_id string, pass int, letter string, text string, explanation string, error string")
    held, names = [], ("written", "stored")
    for name in names:
        keep = getattr(stages, name, None)
        if keep and hasattr(passes, name):
            monkeypatch.setattr(passes, name, lambda df, keep=keep: held.append(keep(df)) or held[-1])
    fixed, _ = passes.fix_passes(qs, v, signals(spark), w)
    assert {r["question_id"]: r["question_stem"] for r in fixed.collect()} == {"stem": "new", "option": "stem option"}
    assert held and not any(t in repr(r) for df in held for r in df.collect() for t in ("text B", "stem option", "why B"))


def test_shipping_chapters_writes_no_texts_between_passes(spark, monkeypatch):
    from quillmill.plans.flows import ship_chapters

    held = []
    for name in ("written", "stored"):
        if keep := getattr(passes, name, None):
            monkeypatch.setattr(passes, name, lambda df, keep=keep: held.append(df.columns) or keep(df))
    assert ship_chapters(spark, "/root/testdata/sf0.001").where("n_questions > 0").count() > 0
    assert len(held) == 4 and not any({"options", "question_stem"} & {*columns} for columns in held)
