"""Routed fixes, judges' answers and the wide export by literal rows."""

import json

import pytest
from pyspark.sql import functions as F

from quillmill.functions import text as T
from quillmill.operators import judges, publish, routing, tells

OPTIONS = "array<struct<letter:string,text:string,is_correct:boolean,explanation:string>>"


@pytest.mark.parametrize(("text", "told"), [("LEFT side", "Right side"), ("Left, left and lEFT", "Right, right and right"), ("leftover Lefty", "leftover Lefty"), ("the left-hand", "the right-hand"), ("", "")])
def test_first_letter_decides_the_capital(spark, text, told):
    assert spark.createDataFrame([(text,)], "t string").select(T.replace_word(F.col("t"), "left", "right")).first()[0] == told


def fixed(spark, stem, signals, texts, rewrites=(), flagged=("B",), why="because of the right side"):
    options = [(x, t, x == "A", why) for x, t in zip("ABCD", texts, strict=True)]
    q = spark.createDataFrame([("q", "c", stem, options, [*flagged])], f"question_id string, chapter string, question_stem string, options {OPTIONS}, flagged array<string>")
    s = spark.createDataFrame([("q", letter, kind, True, pair) for letter, kind, pair in signals] + [("q", "C", "laterality", False, None)], "question_id string, letter string, signature string, fired boolean, pair array<string>")
    w = spark.createDataFrame([("q", *r) for r in rewrites], "question_id string, letter string, signature string, text string, explanation string")
    return routing.route_fixes(q, s, w)


def told(spark, *args, **more):
    r = fixed(spark, *args, **more).first()
    return [o["text"] for o in r["options"]], [o["explanation"] for o in r["options"]], r["attempted"], r["by_fixer"], r["patched"], r["residual"]


def test_a_side_is_flipped_in_text_and_explanation(spark):
    texts, why, *rest = told(spark, "A Left lesion", [("B", "laterality", None)], ["Right", "RIGHT and right", "right", "x"])
    assert texts == ["Right", "Left and left", "right", "x"] and why[1] == "because of the left side" and why[0] == "because of the right side"
    assert rest == [1, {"laterality_fixer": 1}, True, False]


def test_what_does_not_apply_changes_nothing(spark):
    same = lambda *a, **b: told(spark, *a, **b)[2:]
    assert same("left and right", [("B", "laterality", None)], "wxyz") == (1, {}, False, True)  # both sides in the stem
    assert same("left", [("B", "laterality", None)], "wxyz") == (1, {}, False, True)  # the option lacks the other side
    assert same("left", [("A", "laterality", None)], ["right", "x", "y", "z"]) == (1, {}, False, True)  # never the correct option
    assert same("left", [("B", "imperative_lead", None)], ["w", "right", "y", "z"], flagged=()) == (0, {}, False, False)  # no such fixer
    assert same("left, bilateral", [("B", "laterality", None)], ["w", "unilateral", "y", "z"])[2] is False  # the first pair of the stem decides


def test_pairs_swap_the_text_alone(spark):
    texts, why, *_ = told(spark, "stem", [("B", "tier_a_brief", ["Antagonist", "agonist"]), ("C", "tier_b_lexical", ["between", "within"]), ("D", "tier_b_lexical", ["between", "within"])], ["x", "An Agonist binds", "between and within", "Within it"], why="agonist within")
    assert texts == ["x", "An Antagonist binds", "between and within", "Between it"] and set(why) == {"agonist within"}


def test_quantifiers_are_dropped_or_rewritten(spark):
    long = "it always takes one two three four five six seven eight"
    rewrites = [("C", "universal_quantifier", " often so ", "why not"), ("D", "universal_quantifier", "all the same", None)]
    texts, why, attempted, by, *_ = told(spark, "stem", [(x, "universal_quantifier", None) for x in "BCD"], ["x", long, "Never so", "every one"], rewrites)
    assert texts == ["x", "it takes one two three four five six seven eight", "often so", "every one"] and why[2] == "why not" and (attempted, by) == (3, {"universal_quantifier_fixer": 2})


def test_ratios_need_a_rewrite_without_one(spark):
    ratio = lambda text: told(spark, "At 9:6", [("B", "numeric_ratio", None)], ["x", "at 1:3 more", "y", "z"], [("B", "numeric_ratio", text, None)])[0][1]
    assert [ratio(t) for t in ("more of it", "2:1", "none", " ")] == ["more of it", "at 1:3 more", "at 1:3 more", "at 1:3 more"]


def test_patches_add_up_and_chapters_are_summed(spark):
    both = fixed(spark, "left in childhood", [("B", "stage_timing", None), ("B", "laterality", None)], ["x", "right in adulthood", "y", "z"])
    assert both.first()["options"][1]["text"] == "left in childhood"
    row = routed = routing.routed_chapters(both.unionByName(fixed(spark, "none", [], "wxyz"))).first()
    assert (row["attempted"], row["applied"], row["residual"], row["cost"], routed["laterality_fixer"], row["stage_timing_fixer"], row["numeric_ratio_fixer"]) == (2, 1, 1, 0.005, 1, 1, 0)


def test_findings_of_a_judge(spark):
    q = spark.createDataFrame([(n,) for n in "abcdefg"], "question_id string")
    say = lambda x: json.dumps({"defensible_alternatives": x})
    answers = spark.createDataFrame([("a", say([{"letter": "B", "argument": "x" * 300}, 7, {"letter": "C"}]), None), ("b", say([]), None), ("c", "no", None), ("d", None, "TimeoutError: late"), ("e", "```json\n" + say([{"letter": "D", "argument": "so"}]) + "\n```", None), ("f", say("text"), None)], "question_id string, content string, error string")
    got = sorted(((r["question_id"], r["letter"], r["fired"], r["confidence"], r["reason"], r["extra"] and r["extra"]["argument"]) for r in judges.answered_signals(q, answers, "llm_ambiguity").collect()), key=str)
    assert got == sorted([
        ("a", "B", True, 0.6, "x" * 200, "x" * 300), ("a", "C", True, 0.6, "", ""), ("b", None, False, 1.0, "llm_ambiguity: no defensible alternatives found", None), ("c", None, False, 0.0, "llm_ambiguity: parse_failed", None),
        ("d", None, False, 0.0, "llm_ambiguity: api_error: TimeoutError: late", None), ("e", "D", True, 0.6, "so", "so"), ("f", None, False, 1.0, "llm_ambiguity: no defensible alternatives found", None), ("g", None, False, 0.0, "llm_ambiguity: no client", None),
    ], key=str)


def test_the_gate_of_eliminable_distractors(spark):
    options = [("A", "x", True, "")]
    rows = [(n, "" if n == "empty" else "stem", options, "skip" if n == "skip" else "strict", "swap", "defined") for n in ("hit", "clean", "older", "skip", "empty", "failed", "broken", "unasked")]
    q = spark.createDataFrame(rows, f"question_id string, question_stem string, options {OPTIONS}, gate_action string, correction_strategy string, note string")
    gap = {"letter": "B", "class": "english_gap", "contradicted_stem_fact": "f", "explanation": "e"}
    new = json.dumps({"classifications": [gap, {"letter": "C", "class": "content_gap"}], "flagged_distractors": [{"letter": "D"}]})
    answers = [("hit", new, None), ("clean", json.dumps({"classifications": [{"letter": "C", "class": "clean"}]}), None), ("older", json.dumps({"flagged_distractors": [{"letter": "D"}]}), None), ("skip", new, None), ("empty", new, None), ("failed", new, "late"), ("broken", "{", None)]
    got = {r["question_id"]: (r["eliminable"], r["ok"], r["reason"]) for r in judges.eliminable(q, spark.createDataFrame(answers, "question_id string, content string, error string")).collect()}
    assert got == {
        "hit": (["B"], False, "[strategy=swap] distractor B: contradicted by 'f'. e"), "clean": ([], True, None), "older": (["D"], False, "[strategy=swap] distractor D: contradicted by ''. "), "skip": ([], True, "policy=skip:defined"),
        "empty": ([], True, None), "failed": ([], True, None), "broken": ([], True, None), "unasked": ([], True, None),
    }


def test_the_export_has_62_columns_and_grows(spark):
    assert len(publish.EXPORT_COLUMNS) == len(set(publish.EXPORT_COLUMNS)) == 62
    kind = "array<struct<letter:string,text:string,is_correct:boolean,explanation:string,distractor_level:int,misconception_type:string,concept_id:string,misconception_id:string,confused_with:string>>"
    options = [("A", "a", False, "ea", 2, "t", "c1", "m1", "x"), ("B", "b", True, None, None, None, "c0", None, None)]
    rows = [("q1", "BPSY", 3, options, ("c0", "label", "k"), ["u1", "u2"], ["s"], {"concept": ("f", "b")}), ("q2", None, None, None, None, [], None, None)]
    records = spark.createDataFrame(rows, f"question_id string, domain_code string, difficulty_tier int, options {kind}, tested_concept struct<concept_id:string,concept_label:string,knowledge_tested:string>, anchor_uids array<string>, anchor_content_summaries array<string>, flashcard_seeds map<string,struct<front:string,back:string>>")
    anchors = spark.createDataFrame([("u1", "7", "fact"), ("u2", "8", "no")], "uid string, chapter_num string, testable_fact string")
    wide = publish.wide_export(records, anchors, {"BPSY": 4})
    got = {r["question_id"]: {k: v for k, v in r.asDict().items() if v} for r in wide.collect()}
    assert wide.columns == publish.EXPORT_COLUMNS and got["q2"] == {"question_id": "q2", "question_type": "single_choice"}
    assert got["q1"] == {
        "question_id": "q1", "question_type": "single_choice", "domain_code": "BPSY", "domain_id": "4", "difficulty_tier": "3", "chapter_num": "7", "testable_fact": "fact", "anchor_uid": "u1", "anchor_content_summary": "s", "option_a": "a", "option_b": "b",
        "explanation_a": "ea", "tested_concept_id": "c0", "tested_concept_label": "label", "knowledge_tested": "k", "flashcard_concept_front": "f", "flashcard_concept_back": "b", "distractor_1_letter": "A", "distractor_1_level": "2",
        "distractor_1_misconception_type": "t", "distractor_1_concept_id": "c1", "distractor_1_misconception_id": "m1", "distractor_1_confused_with": "x",
    }
    old = wide.where("question_id = 'q1'").withColumn("domain_code", F.lit("kept"))
    assert sorted((r["question_id"], r["domain_code"]) for r in publish.appended(old, wide).collect()) == [("q1", "kept"), ("q2", "")]
    for known, new in (("q1", ["q2"]), ("q2", ["q1"]), ("q3", ["q1", "q2"])):
        rest = publish.wide_export(records, anchors, {"BPSY": 4}, spark.createDataFrame([(known,)], "question_id string")).collect()
        assert sorted(r["question_id"] for r in rest) == new and all({k: v for k, v in r.asDict().items() if v} == got[r["question_id"]] for r in rest)


def test_the_export_shuffles_whole_records_once(spark):
    rows = [(f"q{i}", [f"u{i}"] if i % 2 else []) for i in range(20)]
    kind = "array<struct<letter:string,text:string,is_correct:boolean,explanation:string,distractor_level:int,misconception_type:string,concept_id:string,misconception_id:string,confused_with:string>>"
    records = spark.createDataFrame(rows, "question_id string, anchor_uids array<string>").withColumns({"options": F.expr(f"cast(array() as {kind})"), "tested_concept": F.expr("named_struct('concept_id', 'c', 'concept_label', 'l', 'knowledge_tested', 'k')"), "flashcard_seeds": F.expr("cast(map() as map<string,struct<front:string,back:string>>)"), "question_stem": F.concat(F.lit("stem of "), "question_id")})
    anchors = spark.createDataFrame([("u1", "7", "fact")], "uid string, chapter_num string, testable_fact string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = publish.wide_export(records, anchors, None, records.where("question_id < 'q15'").select("question_id"))
        plan = told._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["question_id"], r["chapter_num"], r["question_stem"]) for r in told.collect()) == sorted((f"q{i}", "", f"stem of q{i}") for i in range(20) if f"q{i}" >= "q15")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.split("\n")
    moved = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert sum("stem of" in lines[i + 1] for i in moved) == 1 and len(moved) > 1


def test_all_exports_stand_in_one_folder(spark, monkeypatch):
    from quillmill.plans import repairs

    folders, csv = set(), repairs.files.write_csv
    monkeypatch.setattr(repairs.files, "write_csv", lambda rows, path, *a, **k: folders.add(path) or csv(rows, path, *a, **k))
    assert repairs.export_rows(spark, "/root/testdata/sf0.001").count() > 0 and len(folders) == 1  # no row is written twice


def test_lengths_and_marks_that_tell(spark):
    rows = [
        ("even", [("A", "aaaa", True, ""), ("B", "bbbb", False, ""), ("C", "cccc", False, "")]), ("long", [("A", "a" * 13, True, ""), ("B", "b" * 10, False, ""), ("C", "c" * 5, False, "")]),
        ("marks", [("A", "one (two); e.g. three", True, ""), ("B", "plain", False, ""), ("C", "plain", False, "")]), ("both", [("A", "x -- y", True, ""), ("B", "(b)", False, ""), ("C", None, False, "")]),
    ]
    q = spark.createDataFrame(rows, f"question_id string, options {OPTIONS}")
    ratios = {r["question_id"]: (r["ratio"], round(r["to_mean"], 3), r["longest"], r["much_longer"]) for r in tells.length_ratios(q).collect()}
    assert ratios["even"] == (1.0, 1.0, True, False) and ratios["long"] == (2.6, 1.733, True, True) and ratios["both"][0] == float("inf")
    told = {r["question_id"]: (r["total"], r["most"], r["mean"], r["over_most"], r["over_mean"], r["only"], r["strict"]) for r in tells.marked_options(q).collect()}
    assert told == {
        "even": (0, 0, 0.0, False, False, [], False), "long": (0, 0, 0.0, False, False, [], False), "marks": (3, 0, 0.0, True, True, ["parens", "semicolons"], True), "both": (1, 1, 0.5, False, True, ["dashes"], False),
    }
    assert tuple(tells.marks_summary(tells.marked_options(q)).first()) == (4, 1, 2, 1, 1, 1, 1)
    assert tells.length_summary(tells.length_ratios(q.where("question_id <> 'both'"))).first()["over_2_0"] == 2
