"""Flat export, validation and rewriting of nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that begin a reason inside an option.
REASON_MARKERS = ("because", "since", "due to", "owing to", "for this reason", "in order to", "so that")


def by_letter(letter: str, field: str) -> Column:
    return F.coalesce(F.get(F.filter("options", lambda o: o.letter == letter), F.lit(0))[field], F.lit(""))


def flatten(questions: DataFrame) -> DataFrame:
    """Options pivoted by letter, distractors numbered in their order, missing values
    as empty strings (P01)."""
    wrong = F.filter("options", lambda o: ~F.coalesce(o.is_correct, F.lit(False)))
    right = F.filter("options", lambda o: o.is_correct)
    return questions.select(
        "question_id", "domain", "chapter", "difficulty_tier", "question_stem",
        *(by_letter(x, "text").alias(f"option_{x.lower()}") for x in "ABCD"), *(by_letter(x, "explanation").alias(f"explanation_{x.lower()}") for x in "ABCD"),
        F.coalesce(F.get(right, F.lit(0)).letter, F.lit("")).alias("correct_answer"),
        *(F.coalesce(F.get(wrong, F.lit(i)).letter, F.lit("")).alias(f"distractor_{i + 1}_letter") for i in range(3)),
    )


def strip_reasoning(questions: DataFrame, least_chars: int = 20, least_share: float = 0.55) -> DataFrame:
    """Cuts the reason off an option and puts it into the explanation (P12): the head
    must have 20 characters and 0.55 of the longest sibling, where siblings with a
    reason count by their heads."""
    pattern = r"(?i)^(.*?)[\s,;]*\b(" + "|".join(REASON_MARKERS) + r")\b(.*)$"

    def split(o: Column) -> Column:
        has = o.text.rlike(pattern)
        head = F.trim(F.regexp_extract(o.text, pattern, 1))
        clause = F.trim(F.concat(F.regexp_extract(o.text, pattern, 2), F.regexp_extract(o.text, pattern, 3)))
        return F.struct(o.alias("o"), has.alias("has"), F.when(has, head).otherwise(o.text).alias("head"), clause.alias("clause"))

    parts = F.transform("options", split)

    def rewritten(p: Column, i: Column) -> Column:
        longest = F.array_max(F.transform(F.filter(F.transform(F.col("__parts"), lambda q, j: F.struct(F.length(q.head).alias("n"), j.alias("j"))), lambda x: x.j != i), lambda x: x.n))
        good = p.has & (F.length(p.head) >= least_chars) & (F.length(p.head) >= longest * least_share)
        known = F.contains(F.lower(F.coalesce(p.o.explanation, F.lit(""))), F.lower(p.clause))
        explanation = F.when(known, p.o.explanation).otherwise(F.trim(F.concat_ws(" ", p.o.explanation, p.clause)))
        return F.when(good, p.o.withField("text", p.head).withField("explanation", explanation)).otherwise(p.o)

    return questions.withColumn("__parts", parts).withColumn("options", F.transform("__parts", rewritten)).drop("__parts")


def rewrite_by_letter(questions: DataFrame, rewrites: DataFrame) -> DataFrame:
    """Option texts replaced where a rewrite is not blank."""
    maps = rewrites.where(F.trim(F.coalesce("text", F.lit(""))) != "").groupBy("question_id").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("letter", "text")))).alias("__new"))
    joined = questions.join(maps, "question_id", "left")
    return joined.withColumn("options", F.transform("options", lambda o: o.withField("text", F.coalesce(F.element_at(F.col("__new"), o.letter), o.text)))).drop("__new")


def first_failure(*rules: tuple[Column, str]) -> Column:
    """The reason of the first rule that fails; null if none does."""
    return F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), reason) for ok, reason in rules), F.lit(None).cast("string"))


def brief_failure() -> Column:
    """A brief needs 2 claims, 2 concepts with id and label, 3 misconceptions, 3 angles."""
    return first_failure(
        (F.size("core_claims") >= 2, "core_claims"), (F.size("concepts") >= 2, "concepts"), (F.forall("concepts", lambda c: (F.trim(c.concept_id) != "") & (F.trim(c.label) != "")), "concept_fields"),
        (F.size("misconceptions") >= 3, "misconceptions"), (F.forall("misconceptions", lambda m: F.size(m.concepts_involved) >= F.when(m.type == "opposite_direction", 1).otherwise(2)), "concepts_involved"), (F.size("question_angles") >= 3, "question_angles"),
    )


def truncated(text: Column, most: int, head: int, tail: int) -> Column:
    """The whole text, or its head and tail."""
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.substring(text, 1, head), F.lit(" … "), F.right(text, F.lit(tail))))


def rendered(options: str = "options") -> Column:
    """Options as lines of a prompt."""
    return F.array_join(F.transform(options, lambda o: F.concat(o.letter, F.lit(") "), o.text)), "\n")


# The columns of the export, in order.
EXPORT_COLUMNS = (
    "question_id question_type domain_code domain_id domain_name chapter_num chapter_title chapter_file section_title chapter_uuid anchor_uuid anchor_label "
    "difficulty_tier difficulty_label blooms_primary blooms_secondary stem_pattern source_type variant question_stem option_a option_b option_c option_d correct_answer "
    "explanation_a explanation_b explanation_c explanation_d tested_concept_id tested_concept_label knowledge_tested anchor_uid anchor_point_id_v2 anchor_content_summary "
    "flashcard_concept_front flashcard_concept_back flashcard_comparison_front flashcard_comparison_back flashcard_nuance_front flashcard_nuance_back "
    "distractor_1_letter distractor_1_level distractor_1_misconception_type distractor_2_letter distractor_2_level distractor_2_misconception_type "
    "distractor_3_letter distractor_3_level distractor_3_misconception_type distractor_1_concept_id distractor_1_misconception_id distractor_1_confused_with "
    "distractor_2_concept_id distractor_2_misconception_id distractor_2_confused_with distractor_3_concept_id distractor_3_misconception_id distractor_3_confused_with "
    "generation_batch generated_by testable_fact"
).split()
#: Columns that a record has under their own names.
PLAIN_COLUMNS = (
    "question_id domain_code domain_name chapter_title chapter_file section_title chapter_uuid anchor_uuid anchor_label difficulty_tier difficulty_label "
    "blooms_primary blooms_secondary stem_pattern source_type variant question_stem generation_batch generated_by"
).split()


def wide_export(records: DataFrame, anchors: DataFrame, domain_ids: dict[str, int] | None = None, existing: DataFrame | None = None) -> DataFrame:
    """A record as 62 columns of text, missing values empty.

    records: the plain columns, question_type, correct_answer_letter, options (letter, text, is_correct, explanation, distractor_level,
    misconception_type, concept_id, misconception_id, confused_with), tested_concept, anchor_uids, anchor_point_ids_v2,
    anchor_content_summaries (arrays; the first counts), flashcard_seeds (a map of front and back).  anchors: uid,
    chapter_num, testable_fact, one row for each uid; they come from here, not from the record (J2).  Columns that a record lacks are empty.
    existing: question_id; records whose id is there already are left out (S16).

    Ids and uids find out what is new and what its anchors say; whole records are shuffled once, to meet that.
    """
    known = set(records.columns)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    plain = lambda name: text(F.col(name)) if name in known else F.lit("")
    head = lambda name: text(F.get(name, F.lit(0))) if name in known else F.lit("")
    wrong = F.filter("options", lambda o: ~F.coalesce(o.is_correct, F.lit(False)))
    first = records.withColumns({"__uid": head("anchor_uids"), "__id": plain("question_id")})
    keys = first.select("__id", "__uid")
    if existing is not None:
        keys = keys.join(existing.select(F.col("question_id").alias("__id")).distinct(), "__id", "left_anti")
    # records without a uid are dealt out, and meet no anchor
    salt = F.when(F.col("__uid") == "", F.pmod(F.xxhash64("__id"), F.lit(1024)) + 1).otherwise(F.lit(0))
    told = anchors.select(F.col("uid").alias("__uid"), F.lit(0).cast("long").alias("__salt"), F.col("chapter_num").alias("__chapter"), F.col("testable_fact").alias("__fact"))
    facts = keys.withColumn("__salt", salt).join(told, ["__uid", "__salt"], "left").groupBy("__id", "__uid").agg(F.first("__chapter").alias("__chapter"), F.first("__fact").alias("__fact"))
    joined = first.join(facts, ["__id", "__uid"])
    ids = F.create_map(*(F.lit(x) for pair in (domain_ids or {"": ""}).items() for x in map(str, pair)))
    columns = {name: plain(name) for name in PLAIN_COLUMNS} | {
        "question_type": F.coalesce("question_type", F.lit("single_choice")) if "question_type" in known else F.lit("single_choice"), "domain_id": text(F.try_element_at(ids, plain("domain_code"))),
        "correct_answer": plain("correct_answer_letter"), "chapter_num": text(F.col("__chapter")), "testable_fact": text(F.col("__fact")), "anchor_uid": F.col("__uid"),
        "anchor_point_id_v2": head("anchor_point_ids_v2"), "anchor_content_summary": head("anchor_content_summaries"),
        "tested_concept_id": text(F.col("tested_concept.concept_id")), "tested_concept_label": text(F.col("tested_concept.concept_label")), "knowledge_tested": text(F.col("tested_concept.knowledge_tested")),
    }
    for letter in "ABCD":
        columns |= {f"option_{letter.lower()}": by_letter(letter, "text"), f"explanation_{letter.lower()}": by_letter(letter, "explanation")}
    for kind in ("concept", "comparison", "nuance"):
        columns |= {f"flashcard_{kind}_{side}": text(F.try_element_at("flashcard_seeds", F.lit(kind))[side]) for side in ("front", "back")}
    for i in range(3):
        own = F.get(wrong, F.lit(i))
        columns |= {f"distractor_{i + 1}_{name}": text(own[field]) for name, field in (("letter", "letter"), ("level", "distractor_level"), ("misconception_type", "misconception_type"), ("concept_id", "concept_id"), ("misconception_id", "misconception_id"), ("confused_with", "confused_with"))}
    return joined.select(*(columns[name].alias(name) for name in EXPORT_COLUMNS))


def appended(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The rows that are there and the new ones whose id is not (S16): earlier rows are never changed.  Where they are
    in a file, wide_export can leave them out and the new ones be added to it."""
    return existing.select(*EXPORT_COLUMNS).unionByName(new.join(existing.select("question_id").distinct(), "question_id", "left_anti").select(*EXPORT_COLUMNS))
