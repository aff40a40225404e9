"""Rescue of stems by alternate templates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def candidate_templates(questions: DataFrame, templates: DataFrame, on: list[str], ord_col: str = "ord", template: str = "template", most: int = 3) -> DataFrame:
    """questions with an array of the first `most` templates of their cell, in registry order;
    empty where the cell has none.  Templates are one short list for each cell."""
    held = templates.groupBy(*on).agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct(ord_col, template))), lambda x: x[template]), 1, most).alias("candidates"))
    return questions.join(held, on, "left").withColumn("candidates", F.coalesce("candidates", F.array().cast("array<string>")))


def rescue_stems(questions: DataFrame, attempts: DataFrame, fixes: DataFrame) -> DataFrame:
    """questions with outcome, template, n_attempts, cost and the rescued question_stem and options.

    questions: question_id, question_stem, options, gap_letter (the first english_gap
    letter, null without one), candidates (an array, best first).  attempts: question_id, template, stem, error, still_gap,
    cost: the answer to each candidate and its re-audit.  fixes: question_id, text, explanation, cost.

    The first candidate whose rewrite succeeded and passed its re-audit wins.  Where none does, the flagged
    distractor of the last rewrite that could be read is fixed.  All candidates of a question
    are looked up by one equality join and judged by one aggregation over at
    most as many rows as there are candidates; attempts after the winner were never made, so they
    don't count.
    """
    asked = questions.where(F.col("gap_letter").isNotNull()).select("question_id", F.posexplode("candidates").alias("at", "template"))
    answers = asked.join(attempts, ["question_id", "template"], "left").select("question_id", "at", "template", F.when(F.col("error").isNull(), F.col("stem")).alias("stem"), (F.col("error").isNull() & F.col("stem").isNotNull() & ~F.coalesce("still_gap", F.lit(False))).alias("passes"), F.coalesce("cost", F.lit(0.0)).alias("cost"))
    tries = answers.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("at", "template", "stem", "passes", "cost"))).alias("tries"))
    joined = questions.join(tries, "question_id", "left").join(fixes.select("question_id", F.col("text").alias("__text"), F.col("explanation").alias("__why"), F.col("cost").alias("__cost")), "question_id", "left")
    won = F.get(F.filter("tries", lambda t: t.passes), F.lit(0))
    read = F.filter("tries", lambda t: t.stem.isNotNull())
    last = F.get(read, F.size(read) - 1)
    has_gap, has_cell = F.col("gap_letter").isNotNull(), F.size("candidates") > 0
    falls = has_gap & has_cell & won.isNull()
    fixed = falls & F.col("__text").isNotNull() & F.exists("options", lambda o: (o.letter == F.col("gap_letter")) & ~F.coalesce(o.is_correct, F.lit(False)))
    outcome = F.when(~has_gap, "no_english_gap").when(~has_cell, "no_template_for_cell").when(won.isNotNull(), "rewrote_stem").when(fixed, "stem_then_distractor_fix").otherwise("did_not_converge")
    made = F.filter("tries", lambda t: won.isNull() | (t.at <= won.at))
    stem = F.when(won.isNotNull(), won.stem).when(falls, F.coalesce(last.stem, F.col("question_stem"))).otherwise(F.col("question_stem"))
    options = F.transform("options", lambda o: F.when(fixed & (o.letter == F.col("gap_letter")), o.withField("text", F.col("__text")).withField("explanation", F.coalesce(F.col("__why"), o.explanation))).otherwise(o))
    spent = F.aggregate(F.transform(made, lambda t: t.cost), F.lit(0.0), lambda a, x: a + x) + F.when(falls, F.coalesce("__cost", F.lit(0.0))).otherwise(0.0)
    told = joined.withColumns({"outcome": outcome, "template": won.template, "n_attempts": F.coalesce(F.size(made), F.lit(0)), "spent": F.coalesce(spent, F.lit(0.0)), "new_stem": stem, "new_options": options})
    rest = [c for c in questions.columns if c not in ("question_stem", "options", "candidates", "gap_letter")]
    return told.select(*rest, F.col("new_stem").alias("question_stem"), F.col("new_options").alias("options"), "outcome", "template", F.greatest("n_attempts", F.lit(0)).alias("n_attempts"), F.round("spent", 4).alias("cost"))


def rescued_chapters(rescued: DataFrame, chapter: str = "chapter") -> DataFrame:
    """Questions, outcomes and cost of each chapter."""
    names = ("no_english_gap", "no_template_for_cell", "rewrote_stem", "stem_then_distractor_fix", "did_not_converge")
    return rescued.groupBy(chapter).agg(F.count("*").alias("n_questions"), *(F.count_if(F.col("outcome") == n).alias(n) for n in names), F.round(F.sum("cost"), 4).alias("cost"))
