"""Literal rows for briefs, assembly, rotation and audit files."""

import os
import uuid

from pyspark.sql import functions as F

from quillmill.functions import text as T
from quillmill.operators import assembly, briefs, planning, verdicts
from quillmill.sources import files

POOL = "array<struct<misconception_id:string,concepts_involved:array<string>>>"


def get(spark, c):
    return spark.range(1).select(c).first()[0]


def test_metadata_names(spark):
    columns = "domain_code string, chapter_title string, section_title string, anchor_uid string, anchor_id_v2 string, verbatim_anchor string, tier int, variant int"
    row = assembly.metadata(spark.createDataFrame([("PMET", "Sleep & Wake", None, "u1", "D1-2", "x" * 130, 4, 12)], columns)).first()
    space = uuid.UUID(hex=assembly.QUESTION_SPACE)
    assert (row.question_id, row.chapter_file, row.section_title, len(row.anchor_label)) == ("QZ-PMET-D1-2-X-12", "sleep-wake.html", "Sleep & Wake", 120)
    assert (row.chapter_uuid, row.anchor_uuid) == (str(uuid.uuid5(space, "PMET:Sleep & Wake")), str(uuid.uuid5(space, "PMET:u1")))
    assert (row.difficulty_label, row.blooms_primary, row.blooms_secondary) == ("expert", "evaluate", "analyze")


def test_titles_and_fronts(spark):
    for slug in ("d7abc-long-term", "x", "", "a--b2c"):
        assert get(spark, assembly.titled(F.lit(slug))) == slug.replace("-", " ").title()
    fronts = get(spark, assembly.flashcard_fronts(F.lit(None).cast("string"), F.array(F.lit("a"))))
    assert fronts.comparison_front == "How does this concept differ from its most commonly confused concept?"


def test_slots_repeat_only_when_ids_run_out(spark):
    pool = F.from_json(F.lit('[{"misconception_id":"m1","concepts_involved":["a"]},{"misconception_id":"m1","concepts_involved":["b"]},{"misconception_id":"m2","concepts_involved":null}]'), POOL)
    slots = get(spark, planning.distractor_slots(pool, F.lit("b"), F.lit(None).cast("array<string>"), F.lit(1), F.lit(4)))
    assert [(s.slot, s.level, s.mode) for s in slots] == [(1, 3, "focused"), (2, 4, "focused"), (3, 4, "focused")]
    assert [s.misconception_id for s in slots][:2] in (["m1", "m2"], ["m2", "m1"]) and slots[2].misconception_id in ("m1", "m2")
    empty = get(spark, planning.distractor_slots(F.lit(None).cast(POOL), F.lit("b"), F.lit(None).cast("array<string>"), F.lit(1), F.lit(1)))
    assert [(s.level, s.mode) for s in empty] == [(1, "open"), (2, "open"), (3, "open")]


def test_targets_that_are_none(spark):
    for json in (None, "", "not json", "[1]", '"x"', "5"):
        assert get(spark, briefs.target_failure(F.lit(json).cast("string"))) == "not_an_object", json
    assert get(spark, briefs.target_failure(F.lit("{}"))) == "missing:competency_claim"
    assert get(spark, briefs.target_of(F.lit("{}"))).discrimination_prediction_level == "moderate"


def test_brief_terms_of_nothing_and_under_a_cap(spark):
    none = F.lit(None).cast("array<string>")
    assert get(spark, briefs.brief_terms(none, none, F.lit(None).cast("string"))) == []
    assert get(spark, briefs.brief_terms(none, F.array(F.lit("neuron contralateral hippocampus neuron")), F.lit(""), 2)) == ["contralateral", "hippocampus"]


def test_pairs_keep_their_shape(spark):
    given = F.array(F.lit("Encoding_vs_Storage_definition"), F.lit("x_vs_x"), F.lit("a_vs_b_"), F.lit(None).cast("string"), F.lit("vs_b"))
    assert [(p.a, p.b) for p in get(spark, briefs.labelled_pairs(given))] == [("encoding", "storage")]


def test_audit_without_flags_writes_no_fixed_file(spark, tmp_path):
    rows = spark.createDataFrame([(1, False)], "id int, flagged boolean")
    files.write_audit(rows, rows, {"judge": "v1"}, f"{tmp_path}/batch")
    assert os.path.exists(f"{tmp_path}/batch.audit.json") and not os.path.exists(f"{tmp_path}/batch.fixed.json")


def test_override_says_that_it_overrode(spark):
    judged = spark.createDataFrame([("q1", "clean"), ("q2", "english_gap"), ("q3", "clean")], "q string, class string")
    signals = spark.createDataFrame([("q1", True, "override_to", "english_gap"), ("q2", True, "override_to", "english_gap"), ("q3", False, "override_to", "english_gap")], "q string, fired boolean, verdict_action string, proposed_class string")
    told = verdicts.english_gap_override(judged, signals, ["q"]).orderBy("q").collect()
    assert [(r["class"], r["overridden"]) for r in told] == [("english_gap", True), ("english_gap", False), ("clean", False)]


def test_templates_keep_repeated_rows(spark):
    asked = spark.createDataFrame([("en", 1), ("en", 1), (None, 1)], "lang string, tier int")
    templates = spark.createDataFrame([("en", None, "english", 2), (None, 1, "first", 3)], "lang string, tier int, template string, ord int")
    assert sorted(r.template for r in planning.template_for(asked, templates, ["lang", "tier"]).collect()) == ["english", "english", "first"]


def test_deep_repair_keeps_nulls_and_numbers(spark):
    rows = spark.createDataFrame([(1, {"k": "itâ€™s"}, None), (2, None, ["Â\xa0"])], "i int, m map<string,string>, a array<string>")
    told = rows.select(*(T.repair_mojibake_deep(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema)).orderBy("i").collect()
    assert [(r.i, r.m, r.a) for r in told] == [(1, {"k": "it’s"}, None), (2, None, ["\xa0"])]
