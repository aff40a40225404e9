"""Rewrites by letter, critiques, rescues by gate and rubric audits by literal rows."""

import json

import pytest
from pyspark.sql import functions as F

from quillmill.operators import assembly, patches, sweeps

OPTIONS = "array<struct<letter:string,text:string,is_correct:boolean,explanation:string>>"
FOUR = [(x, f"text {x}", x == "B", f"why {x}") for x in "ABCD"]
ANSWERS = "question_id string, content string, error string"


def texts(row):
    return {o["letter"]: (o["text"], o["explanation"], o["is_correct"]) for o in row["options"] or []}


def test_rewritten_takes_the_last_rewrite_of_a_letter(spark):
    rows = spark.createDataFrame([(FOUR, [("A", "new", None), ("A", "newer", "so"), ("B", "right", ""), ("C", "", "only this"), ("Z", "nobody", "x"), (None, "null", "x")]), (FOUR, []), (None, []), (FOUR, None)], f"options {OPTIONS}, new array<struct<letter:string,text:string,explanation:string>>")
    of = lambda may: [texts(r) for r in rows.select(patches.rewritten(F.col("options"), F.col("new"), may).alias("options")).collect()]
    plain = {x: (f"text {x}", f"why {x}", x == "B") for x in "ABCD"}
    assert of("all") == [plain | {"A": ("newer", "so", False), "B": ("right", "", True)}, plain, {}, plain]
    assert of("wrong")[0] == plain | {"A": ("newer", "so", False)}
    assert of("correct")[0] == plain | {"B": ("right", "", True)}


def critique(revised=True, stem="new stem", options=(), **more):
    return json.dumps({"revised": revised, "rationale": "since", "question": {"question_stem": stem, "options": list(options)}, **more})


CRITIQUES = {
    "clean": (FOUR, [], critique(), None, "skipped", None),
    "none": (FOUR, None, critique(), None, "skipped", None),
    "silent": (FOUR, ["A"], None, None, "failed", "no_answer"),
    "late": (FOUR, ["A"], "", "late", "failed", "api_error: late"),
    "prose": (FOUR, ["A"], "I can't", None, "failed", "parse_failed"),
    "empty": (FOUR, ["A"], "{}", None, "failed", "parse_failed"),
    "list": (FOUR, ["A"], "[1]", None, "failed", "parse_failed"),
    "bare": ([], ["A"], critique(), None, "failed", "no_options"),
    "content": (FOUR, ["A"], critique(False), None, "kept", None),
    "unsaid": (FOUR, ["A"], '{"rationale": 3}', None, "kept", None),
    "better": (FOUR, ["A"], "```json\n" + critique(options=[{"letter": "A", "text": "", "explanation": 4, "is_correct": True}, {"letter": "B", "explanation": "now", "is_correct": False}, "C"]) + "\n```", None, "revised", None),
    "blank stem": (FOUR, ["A"], critique(stem="  "), None, "revised", None),
}


def test_self_critique(spark):
    rows = spark.createDataFrame([(q, "ch", "stem", v[0], v[1]) for q, v in CRITIQUES.items()], f"question_id string, chapter string, question_stem string, options {OPTIONS}, flagged array<string>")
    answers = spark.createDataFrame([(q, v[2], v[3]) for q, v in CRITIQUES.items() if v[2] is not None], ANSWERS)
    done = patches.self_critique(rows, answers)
    got = {r["question_id"]: r for r in done.collect()}
    assert {q: (r["outcome"], r["error"]) for q, r in got.items()} == {q: v[4:] for q, v in CRITIQUES.items()}
    plain = {x: (f"text {x}", f"why {x}", x == "B") for x in "ABCD"}
    assert texts(got["better"]) == plain | {"A": ("", "why A", False), "B": ("text B", "now", True)}
    assert got["better"]["question_stem"] == "new stem" and got["better"]["rationale"] == "since"
    assert got["blank stem"]["question_stem"] == "stem" and got["unsaid"]["rationale"] == "" and got["late"]["rationale"] is None
    assert all(texts(r) == plain and r["question_stem"] == "stem" for q, r in got.items() if q not in ("better", "bare", "blank stem"))
    usage = spark.createDataFrame([("better", 1000, 100), ("clean", 10**9, 1), ("content", 1000, 0)], "question_id string, tokens_in long, tokens_out long")
    assert [tuple(r) for r in patches.critique_summary(done, usage).collect()] == [("ch", 10, 2, 6, 0.0375)]


def lettered(name, *entries):
    return json.dumps({name: [dict(zip(("letter", "text", "explanation"), e)) for e in entries]})


RESCUES = {
    "identity": ("apply_identity", FOUR, '{"text": "by its mechanism", "letter": "A"}', None, None, {"B": ("by its mechanism", "why B", True)}),
    "no text": ("apply_identity", FOUR, '{"explanation": "x"}', None, "missing_text_in_response", None),
    "realm": ("topic_realm", FOUR, lettered("distractors", ("A", "a", "x"), ("B", "b", "y"), ("C", "", "z"), ("D", "d")), None, None, {"A": ("a", "x", False), "D": ("d", "why D", False)}),
    "scope": ("scope_match", FOUR, lettered("options", ("A", "a")), None, "missing_distractors_in_response", None),
    "keyword": ("stem_keyword_distribution", FOUR, lettered("distractors", ("Z", "a")), None, None, {}),
    "claim": ("option_claim", FOUR, lettered("options", ("B", "b", "moved")), None, None, {"B": ("b", "moved", True)}),
    "claims": ("option_claim", FOUR, lettered("options"), None, "missing_options_in_response", None),
    "other": ("length_balance", FOUR, "{}", None, "no_strategy", None),
    "null gate": (None, FOUR, "{}", None, "no_strategy", None),
    "no right": ("topic_realm", FOUR[2:], lettered("distractors", ("C", "c")), None, "no_correct_option", None),
    "silent": ("topic_realm", FOUR, None, None, "no_answer", None),
    "late": ("topic_realm", FOUR, "x", "late", "late", None),
    "prose": ("topic_realm", FOUR, "x", None, "no_parsed", None),
}


def test_rescue_by_gate(spark):
    failures = spark.createDataFrame([(q, v[0], v[1], 1) for q, v in RESCUES.items()], f"question_id string, gate string, options {OPTIONS}, v int")
    answers = spark.createDataFrame([(q, v[2], v[3]) for q, v in RESCUES.items() if v[2] is not None], ANSWERS)
    got = {r["question_id"]: r for r in patches.rescue_by_gate(failures.withColumnRenamed("v", "kept"), answers).collect()}
    assert {q: (r["rescued"], r["error"]) for q, r in got.items()} == {q: (v[4] is None, v[4]) for q, v in RESCUES.items()}
    for q, (gate, options, _, _, error, changed) in RESCUES.items():
        assert texts(got[q]) == {x[0]: (x[1], x[3], x[2]) for x in options} | (changed or {}), q
        assert got[q]["strategy"] == (None if error == "no_strategy" else gate) and got[q]["kept"] == 1


@pytest.mark.parametrize("unknown_as", [None, "clean"])
def test_rubric_verdicts(spark, unknown_as):
    said = {
        "major": ('{"c": "major", "issues": [{"d": 1}, {}], "summary": "bad"}', None), "odd": ('{"c": "awful", "issues": [1]}', None), "number": ('{"c": 3}', None), "plain": ('```json\n{"c": "clean"}\n```', None),
        "prose": ("no", None), "late": ("", "late"), "silent": (None, None),
    }
    questions = spark.createDataFrame([(q, q[:1]) for q in said], "question_id string, k string")
    answers = spark.createDataFrame([(q, *v) for q, v in said.items() if v[0] is not None], ANSWERS)
    told = patches.rubric_verdicts(questions, answers, "c", patches.EDITORIAL_CLASSES, unknown_as)
    want = {"major": ("major", 2, "bad", None), "plain": ("clean", 0, "", None), "prose": (None, 0, "", "parse_failed"), "late": (None, 0, "", "api_error: late"), "silent": (None, 0, "", "no_answer")}
    for q, name, n in (("odd", "awful", 1), ("number", "None", 0)):
        want[q] = (None, 0, "", f"unknown_class: {name}") if unknown_as is None else ("clean", n, f"unrecognized class '{name}'; coerced to clean", None)
    assert {r["question_id"]: tuple(r)[1:] for r in told.collect()} == want
    counts = {r["k"]: tuple(r)[1:] for r in patches.rubric_counts(told.join(questions, "question_id"), ["k"], patches.EDITORIAL_CLASSES).collect()}
    assert counts["m"] == (1, 0, 0, 1, 0) and counts["p"] == (2, 1, 0, 0, 1)


def test_empty_tables(spark):
    rows = spark.createDataFrame([], f"question_id string, chapter string, question_stem string, gate string, options {OPTIONS}, flagged array<string>")
    answers = spark.createDataFrame([], ANSWERS)
    assert patches.self_critique(rows, answers).count() == patches.rescue_by_gate(rows, answers).count() == patches.rubric_verdicts(rows, answers, "c", ("x",)).count() == 0


def test_name_sweep(spark):
    rows = spark.createDataFrame([("a", "As Freud & Jung, Adler (1911) said. Freud's theory. Freud et al. left"), ("b", "According to Jung it is so"), ("b", None), ("c", "Per Jung no"), ("a", "nobody here")], "src string, x string")
    names = sweeps.swept_names(sweeps.name_hits(rows, F.col("x"), F.col("src")), ["a", "b"], ["Jung"])
    got = {r["name"]: (r["total"], r["in_a"], r["in_b"], r["as_year"], r["as_et_al"], r["as_according_to"], r["as_possessive"], r["whitelisted"]) for r in names.collect()}
    assert got == {"Freud": (3, 3, 0, 1, 1, 0, 1, False), "Jung": (3, 1, 1, 1, 0, 2, 0, True), "Adler": (1, 1, 0, 1, 0, 0, 0, False)}
    assert tuple(sweeps.sweep_summary(names).first()) == (7, 3, 1, 3, 42.9, 2, 4, 57.1)
    assert [tuple(r)[:2] for r in sweeps.top_names(names, 2).collect()] == [("Freud", 3), ("Jung", 3)] and [r["name"] for r in sweeps.top_names(names, 5, True).collect()] == ["Freud", "Adler"]
    assert tuple(sweeps.sweep_summary(names.where("false")).first()) == (0, 0, 0, 0, 0.0, 0, 0, 0.0)


WRONG = "array<struct<text:string,explanation:string,concept_id:string,concept_label:string,misconception_id:string,misconception_label:string,misconception_type:string>>"
SLOTS = "array<struct<distractor_level:int,misconception_id:string,misconception_label:string,misconception_type:string>>"
CONCEPT = "struct<concept_id:string,concept_label:string,knowledge_tested:string>"
PARTS = f"question_id string, chapter_title string, section_title string, anchor_label string, target_position string, correct struct<text:string,explanation:string>, distractors {WRONG}, slots {SLOTS}, pre_tested {CONCEPT}, tested_concept {CONCEPT}, flashcard_seeds map<string,struct<front:string,back:string>>, flashcard_fronts struct<concept_front:string,comparison_front:string,nuance_front:string>, topic_keywords array<string>, own_keywords array<string>"


def test_question_record(spark):
    wrong = [(f"w{i}", None, f"c{i}", f"C{i}", f"m{i}", None, "kind") for i in range(3)]
    slots = [(1, "s0", "S0", None), (2, "", None, "other"), (3, None, None, None), (4, "unused", None, None)]
    fronts, whole = ("cf", "pf", None), ("t", "e")
    rows = [
        ("full", "Ch", "Sec", "L", "B", whole, wrong, slots, ("p", "P", "ignored"), ("t", "T", "knows"), {"concept": ("f", "b"), "comparison": ("", "b2")}, fronts, ["k"], ["own"]),
        ("bare", "Ch", None, None, "D", whole, wrong, slots, None, ("t", "T", None), None, None, [], None),
        ("few", "Ch", "", "", "A", whole, wrong[:2], slots, None, ("t", "T", None), {}, fronts, None, ["own"]),
        ("none", "Ch", "", "", "A", whole, None, None, ("", "P", None), None, None, fronts, None, None),
    ]
    got = {r["question_id"]: r.asDict(recursive=True) for r in assembly.question_record(spark.createDataFrame(rows, PARTS)).collect()}
    assert {q: r["error"] for q, r in got.items()} == {"full": None, "bare": None, "few": "distractor count mismatch", "none": "missing tested_concept"}
    full = got["full"]
    assert [tuple(o.values()) for o in full["options"]] == [
        ("A", "w0", False, "", "c0", "C0", 1, "p", "s0", "S0", "kind"), ("B", "t", True, "e", "p", "P", None, None, None, None, None),
        ("C", "w1", False, "", "c1", "C1", 2, "p", "m1", None, "other"), ("D", "w2", False, "", "c2", "C2", 3, "p", "m2", None, "kind"),
    ]
    assert full["tested_concept"] == {"concept_id": "p", "concept_label": "P", "knowledge_tested": "knows"} and full["topic_keywords"] == ["k"] and full["book_reference"] == {"chapter": "Ch", "section": "Sec", "anchor": "L"}
    assert full["flashcard_seeds"] == {"concept": {"front": "f", "back": "b"}, "comparison": {"front": "pf", "back": "b2"}, "nuance": {"front": "", "back": ""}}
    assert [o["letter"] for o in got["bare"]["options"] if o["is_correct"]] == ["D"] and got["bare"]["book_reference"] == {"chapter": "Ch", "section": "Ch", "anchor": ""} and got["bare"]["topic_keywords"] == []
    assert got["few"]["options"] is None and got["few"]["topic_keywords"] == ["own"]
