"""Signals and verdicts out of a model's earlier answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions.text import strip_fence

#: What each detector asks for: the list's name, its entries' fields, the confidence of a finding.
DETECTORS = {"llm_ambiguity": ("defensible_alternatives", ("argument",), 0.6), "llm_fact_check": ("factual_errors", ("claim", "correction"), 0.7)}
NOTHING = {"llm_ambiguity": "no defensible alternatives found", "llm_fact_check": "no factual errors found"}


def answered_signals(questions: DataFrame, answers: DataFrame, detector: str) -> DataFrame:
    """question_id and a signal row for each finding of an answer, or one that says why there is none.

    answers: question_id, content, error.  A question that nobody answered has no client; an error, an
    answer that is no JSON object, and one with an empty list give one row that did not fire.  Findings are advisory.
    """
    name, fields, confidence = DETECTORS[detector]
    joined = questions.select("question_id").join(answers.select("question_id", "content", "error", F.lit(True).alias("asked")), "question_id", "left")
    parsed = F.try_parse_json(strip_fence(F.col("content")))
    is_object = F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))
    found = F.coalesce(F.try_variant_get("v", f"$.{name}", "array<variant>"), F.expr("cast(array() as array<variant>)"))
    entry = lambda x, f: F.coalesce(F.try_variant_get(x, f"$.{f}", "string"), F.lit(""))
    said = (lambda x: F.substring(entry(x, "argument"), 1, 200)) if detector == "llm_ambiguity" else (lambda x: F.concat(F.lit("factual error: '"), F.substring(entry(x, "claim"), 1, 80), F.lit("' — correction: "), F.substring(entry(x, "correction"), 1, 80)))
    entries = F.filter(F.col("found"), lambda x: F.coalesce(F.startswith(F.schema_of_variant(x), F.lit("OBJECT")), F.lit(False)))
    fired = F.transform(entries, lambda x: F.struct(F.try_variant_get(x, "$.letter", "string").alias("letter"), F.lit(True).alias("fired"), F.lit(confidence).alias("confidence"), F.lit(detector).alias("signature"), said(x).alias("reason"), F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*(entry(x, f) for f in fields))).alias("extra")))
    quiet = lambda reason, sure=0.0: F.array(F.struct(F.lit(None).cast("string").alias("letter"), F.lit(False).alias("fired"), F.lit(sure).alias("confidence"), F.lit(None).cast("string").alias("signature"), reason.alias("reason"), F.lit(None).cast("map<string,string>").alias("extra")))
    told = joined.withColumn("v", parsed).withColumn("found", found)
    rows = (
        F.when(F.col("asked").isNull(), quiet(F.lit(f"{detector}: no client"))).when(F.col("error").isNotNull(), quiet(F.concat(F.lit(f"{detector}: api_error: "), "error"))).when(~F.coalesce(is_object, F.lit(False)), quiet(F.lit(f"{detector}: parse_failed")))
        .when(F.size("found") == 0, quiet(F.lit(f"{detector}: {NOTHING[detector]}"), 1.0)).otherwise(fired)
    )
    signals = told.select("question_id", F.explode(rows).alias("s"))
    return signals.select("question_id", F.lit(detector).alias("detector_id"), "s.letter", "s.fired", "s.confidence", "s.signature", F.lit("advisory").alias("verdict_action"), F.lit(None).cast("string").alias("proposed_class"), "s.reason", "s.extra")


def eliminable(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """question_id, eliminable (letters), ok, reason: the gate of distractors that the stem alone refutes.

    questions: question_id, question_stem, options, gate_action, correction_strategy, note (of the policy's cell).
    answers: question_id, content, error: {"classifications": [{letter, class, contradicted_stem_fact, explanation}]}, or in the older form
    {"flagged_distractors": [...]}, all of which count.  Cells that the policy skips, questions without stem or options, and
    answers that are missing, failed or can't be read pass."""
    joined = questions.join(answers.select("question_id", "content", "error"), "question_id", "left").withColumn("v", F.when(F.col("error").isNull(), F.try_parse_json(strip_fence(F.col("content")))))
    listed = lambda name: F.coalesce(F.try_variant_get("v", f"$.{name}", "array<variant>"), F.expr("cast(array() as array<variant>)"))
    text = lambda x, f, default="": F.coalesce(F.try_variant_get(x, f"$.{f}", "string"), F.lit(default))
    found = F.when(F.size(listed("classifications")) > 0, F.filter(listed("classifications"), lambda c: text(c, "class") == "english_gap")).otherwise(listed("flagged_distractors"))
    skipped = F.coalesce(F.col("gate_action") == "skip", F.lit(False))
    asked = ~skipped & (F.coalesce("question_stem", F.lit("")) != "") & (F.coalesce(F.size("options"), F.lit(0)) > 0)
    told = joined.withColumn("hits", F.transform(F.when(asked, found), lambda c: F.struct(text(c, "letter", "?").alias("letter"), text(c, "contradicted_stem_fact").alias("fact"), text(c, "explanation").alias("why"))))
    hits = F.coalesce("hits", F.expr("cast(array() as array<struct<letter:string,fact:string,why:string>>)"))
    line = lambda h: F.concat(F.lit("distractor "), h.letter, F.lit(": contradicted by '"), h.fact, F.lit("'. "), h.why)
    reason = F.when(F.size(hits) > 0, F.concat(F.lit("[strategy="), F.coalesce("correction_strategy", F.lit("")), F.lit("] "), F.array_join(F.transform(hits, line), " | "))).when(skipped, F.concat(F.lit("policy=skip:"), F.coalesce("note", F.lit(""))))
    return told.select("question_id", F.transform(hits, lambda h: h.letter).alias("eliminable"), (F.size(hits) == 0).alias("ok"), reason.alias("reason"))
