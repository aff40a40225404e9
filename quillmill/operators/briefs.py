"""Briefs and vocabularies: validation, terms, discriminators, context, registry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.functions import text as T
from quillmill.operators.publish import first_failure

STRINGS = "array<string>"
#: The fields of a measurement target, those with text first, in the order of the check.
TARGET_FIELDS = ("competency_claim", "knower_state", "non_knower_state", "expected_correct_letter", "expected_correct_reasoning", "distractor_diagnoses", "discrimination_prediction_level", "discrimination_prediction_rationale")
TARGET_TEXTS = tuple(f for f in TARGET_FIELDS if f not in ("distractor_diagnoses", "discrimination_prediction_level"))
DIAGNOSIS_FIELDS = ("letter", "candidate_state", "diagnostic_meaning")
LEVELS = ("strong", "moderate", "weak")
TARGET = ", ".join(f"{f} string" for f in TARGET_FIELDS if f != "distractor_diagnoses") + ", distractor_diagnoses array<struct<letter: string, candidate_state: string, diagnostic_meaning: string>>"


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def usable(rows: DataFrame, tier: str = "difficulty_tier", failed: str = "_failed_validation", error: str = "_error") -> DataFrame:
    """Rows without a failed validation or an error, and with a tier."""
    return rows.where(~F.coalesce(F.col(failed), F.lit(False)) & F.col(error).isNull() & F.col(tier).isNotNull())


def discriminator_index(briefs: DataFrame, ord_col: str) -> DataFrame:
    """uid, discriminators: those not blank, of briefs that name themselves and have any;
    of briefs with one uid the last (S13)."""
    kept = F.filter("discriminators", lambda d: F.trim(d) != "")
    rows = briefs.select("uid", F.col(ord_col).alias("__at"), kept.alias("discriminators")).where(~_blank(F.col("uid")) & (F.size("discriminators") > 0))
    return rows.groupBy("uid").agg(F.max_by("discriminators", "__at").alias("discriminators"))


def attach_discriminators(questions: DataFrame, index: DataFrame) -> DataFrame:
    """Adds discriminators by the first anchor of a question, null without a hit."""
    return questions.withColumn("uid", F.get("anchor_uids", F.lit(0))).join(index, "uid", "left").drop("uid")


def labelled_pairs(discriminators: Column) -> Column:
    """The two sides of each "a_vs_b", with or without a suffix, where they differ."""
    shape = r"(?i)^([a-z][a-z0-9]*)_vs_([a-z][a-z0-9]*)(?:_[a-z][a-z0-9_]*)?$"
    side = lambda d, i: F.lower(F.regexp_extract(F.trim(d), shape, i))
    pairs = F.transform(discriminators, lambda d: F.struct(side(d, 1).alias("a"), side(d, 2).alias("b")))
    return F.filter(pairs, lambda p: (p.a != "") & (p.a != p.b))


def _joined(descriptions: Column, claims: Column, fact: Column) -> Column:
    every = F.concat(*(F.coalesce(x, F.array().cast(STRINGS)) for x in (descriptions, claims)), F.array(fact))
    return F.array_join(every, " ")  # nulls are left out


def brief_terms(descriptions: Column, claims: Column, fact: Column, most: int | None = None) -> Column:
    """The distinct words of six letters and more, the longest of them under a cap."""
    found = T.token_set(_joined(descriptions, claims, fact), 6, R.BASE_STOP + R.MODIFIERS)
    return found if most is None else T.sorted_by_length(found, most)


def cluster_terms(anchors: Column, each: int = 4) -> Column:
    """The longest terms of each anchor, none twice, longest first.
    anchors: array of descriptions, claims, fact."""
    own = F.transform(anchors, lambda a: T.sorted_by_length(T.token_set(_joined(a.descriptions, a.claims, a.fact), 6, R.FULL_STOP), each))
    return T.bound(F.array_distinct(F.flatten(own)), lambda x: T.sorted_by_length(x, F.size(x)))


def canonical_terms(domain_vocab: Column, brief_terms: Column) -> Column:
    """Both sets in lower case; empty where nothing is given, which switches the filter off."""
    every = F.concat(*(F.coalesce(x, F.array().cast(STRINGS)) for x in (domain_vocab, brief_terms)))
    return F.array_distinct(F.transform(F.filter(every, lambda w: w != ""), F.lower))


def vocab_failure() -> Column:
    """A vocabulary needs 3 concepts with id and label and 2 misconceptions with id, type
    and enough concepts: one if they are opposite in direction, else two (P14)."""
    least = lambda m: F.when(m.type == "opposite_direction", 1).otherwise(2)
    fault = lambda m: F.when(_blank(m.misconception_id) | _blank(m.type), "misconception_fields").when(F.coalesce(F.size(m.concepts_involved), F.lit(0)) < least(m), "concepts_involved")
    first = F.get(F.filter(F.transform("misconceptions", fault), lambda r: r.isNotNull()), F.lit(0))
    listed = first_failure((F.size("concepts") >= 3, "concepts"), (F.forall("concepts", lambda c: ~_blank(c.concept_id) & ~_blank(c.label)), "concept_fields"), (F.size("misconceptions") >= 2, "misconceptions"))
    return F.coalesce(listed, first)


def target_failure(json: Column) -> Column:
    """Why a measurement target, as JSON text, is not complete; null if it is.

    In this order: not_an_object, missing:<field>, empty:<field> (blank or no
    text), level, diagnoses (none), diagnosis:<position from 0>:<field>.
    """
    whole = F.try_parse_json(json)
    at = lambda v, f: F.try_variant_get(v, f"$.{f}", "variant")
    text = lambda v, f: F.coalesce((F.schema_of_variant(at(v, f)) == "STRING") & (F.trim(F.try_variant_get(v, f"$.{f}", "string")) != ""), F.lit(False))
    is_object = F.coalesce(F.startswith(F.schema_of_variant(whole), F.lit("OBJECT")), F.lit(False))
    diagnoses = F.coalesce(F.try_variant_get(whole, "$.distractor_diagnoses", "array<variant>"), F.array().cast("array<variant>"))
    fault = lambda d, i: F.coalesce(*(F.when(~text(d, f), F.concat(F.lit("diagnosis:"), i.cast("string"), F.lit(f":{f}"))) for f in DIAGNOSIS_FIELDS))
    return F.coalesce(
        F.when(~is_object, "not_an_object"),
        *(F.when(~F.array_contains(F.json_object_keys(json), f), f"missing:{f}") for f in TARGET_FIELDS),
        *(F.when(~text(whole, f), f"empty:{f}") for f in TARGET_TEXTS),
        F.when(~F.coalesce(F.try_variant_get(whole, "$.discrimination_prediction_level", "string").isin(*LEVELS), F.lit(False)), "level"),
        F.when(F.size(diagnoses) == 0, "diagnoses"),
        F.get(F.filter(F.transform(diagnoses, fault), lambda r: r.isNotNull()), F.lit(0)),
    )


def target_of(json: Column) -> Column:
    """A measurement target from JSON text: absent texts are empty, the level moderate,
    a diagnosis without a letter is "?" (P16); to_json is the way back."""
    t = F.from_json(json, TARGET)
    or_empty = lambda c, default="": F.coalesce(c, F.lit(default))
    diagnoses = F.transform(F.filter(t.distractor_diagnoses, lambda d: d.isNotNull()), lambda d: F.struct(or_empty(d.letter, "?").alias("letter"), or_empty(d.candidate_state).alias("candidate_state"), or_empty(d.diagnostic_meaning).alias("diagnostic_meaning")))
    return F.struct(
        *(or_empty(t[f], "moderate" if f == "discrimination_prediction_level" else "").alias(f) for f in TARGET_FIELDS if f != "distractor_diagnoses"),
        F.coalesce(diagnoses, F.array().cast("array<struct<letter:string,candidate_state:string,diagnostic_meaning:string>>")).alias("distractor_diagnoses"),
    )


def meaningful_change(a: str, b: str) -> Column:
    """Whether any of the six parts of two brief structs differs; absent and empty lists are
    equal (P18)."""
    same_list = lambda x, y: x.eqNullSafe(y) | ((F.coalesce(F.size(x), F.lit(0)) <= 0) & (F.coalesce(F.size(y), F.lit(0)) <= 0))
    lists = [same_list(F.col(f"{a}.{k}"), F.col(f"{b}.{k}")) for k in ("core_claims", "concepts", "misconceptions", "question_angles", "discriminators")]
    return ~reduce(lambda x, y: x & y, lists, F.col(f"{a}.concept_explanation").eqNullSafe(F.col(f"{b}.concept_explanation")))


def with_fallback(brief: str, vocab: str, use_brief: bool) -> Column:
    """The brief's concepts, misconceptions, claims and angles where it exists and briefs
    are in use, else the chapter's vocabulary without claims and angles (P09, S11)."""
    own = F.coalesce(F.col(f"{brief}.has_brief"), F.lit(False)) & F.lit(use_brief)
    pick = lambda f: F.when(own, F.col(f"{brief}.{f}")).otherwise(F.col(f"{vocab}.{f}"))
    only = lambda f: F.when(own, F.col(f"{brief}.{f}")).otherwise(F.array().cast(STRINGS))
    return F.struct(pick("concepts").alias("concepts"), pick("misconceptions").alias("misconceptions"), only("core_claims").alias("core_claims"), only("question_angles").alias("question_angles"), (own | (F.coalesce(F.size(f"{vocab}.concepts"), F.lit(0)) > 0)).alias("has_vocab"))


def gate_context(texts: list[str], lists: list[str], content_type: str = "pedagogical_content_type") -> Column:
    """The optional columns of a task where they hold anything, else null; the content
    type is unknown without one (P17)."""
    return F.struct(
        *(F.nullif(F.col(c), F.lit("")).alias(c) for c in texts), *(F.when(F.size(c) > 0, F.col(c)).alias(c) for c in lists),
        F.when(_blank(F.col(content_type)), "unknown").otherwise(F.col(content_type)).alias(content_type),
    )


def registry_stats(registered: DataFrame) -> DataFrame:
    """Canonical concepts and aliases in one row (A25).  registered: of corpus.first_seen."""
    return registered.agg(F.count_if("is_new").alias("total_concepts"), F.count_if(~F.col("is_new")).alias("total_aliases"))


def canonicalised(briefs: DataFrame, registered: DataFrame) -> DataFrame:
    """uid, concepts and misconceptions by canonical ids, n_new, n_aliased.

    briefs: uid, ord, concepts (ids; a concept is seen at ord + its position),
    misconceptions (arrays of ids).  registered: concept_id, canonical_id,
    first_ord, of corpus.first_seen over the same sightings.  Only a brief's own
    concepts rename the ids of its misconceptions.
    """
    own = briefs.select("uid", "ord", F.posexplode("concepts").alias("i", "concept_id")).join(registered.select("concept_id", "canonical_id", "first_ord"), "concept_id")
    moved = F.col("concept_id") != F.col("canonical_id")
    named = own.groupBy("uid").agg(
        F.array_sort(F.collect_list(F.struct("i", "canonical_id"))).alias("c"), F.collect_set(F.when(moved, F.struct("concept_id", "canonical_id"))).alias("m"),
        F.count_if(~moved & (F.col("first_ord") == F.col("ord") + F.col("i"))).alias("n_new"), F.count_if(moved).alias("n_aliased"),
    )
    ids = F.map_from_entries("m")
    remapped = F.transform("misconceptions", lambda xs: F.transform(xs, lambda x: F.coalesce(F.try_element_at(ids, x), x)))
    return briefs.join(named, "uid").select("uid", F.transform("c", lambda x: x.canonical_id).alias("concepts"), remapped.alias("misconceptions"), "n_new", "n_aliased")


def missing_blocks(used: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Keys in use that no block covers; a complete table gives no rows."""
    return used.select(key).distinct().join(blocks, key, "left_anti")
