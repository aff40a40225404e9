"""What an override would change, for many thresholds at once."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def override_simulation(questions: DataFrame, verdicts: DataFrame, signals: DataFrame, thresholds: list[float]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(totals, by tier, by signature), a row for each threshold (and tier or signature).

    questions: question_id, tier, failed.  verdicts: question_id, letter, class.
    signals: question_id, letter, signature, verdict_action, confidence.  A signal overrides at a
    threshold that its confidence reaches, unless the verdict is english_gap already;
    a letter without a verdict can be overridden.  Questions that failed take no part in overrides, but count
    among all and, having no english_gap, among the clean.

    What changes as the threshold falls only grows, so each question and each signal is
    counted once, at the highest threshold it reaches, and the counts are
    summed from the top.  Tables are read once, however many thresholds there are.
    """
    grid = sorted(set(thresholds))
    levels = F.explode(F.array(*(F.struct(F.lit(i).alias("level"), F.lit(float(x)).alias("threshold")) for i, x in enumerate(grid)))).alias("l")
    reached = lambda c: (F.size(F.filter(F.array(*map(F.lit, grid)), lambda t: t <= c)) - 1).alias("level")  # noqa: E731  -1: none
    gaps = verdicts.groupBy("question_id").agg(F.count_if(F.col("class") == "english_gap").alias("gaps"))
    known = questions.select("question_id", "tier", F.coalesce("failed", F.lit(False)).alias("failed")).join(gaps, "question_id", "left").withColumn("gaps", F.coalesce("gaps", F.lit(0)))
    fired = signals.where(F.col("verdict_action") == "override_to").join(verdicts.select("question_id", "letter", "class"), ["question_id", "letter"], "left").where(~F.coalesce(F.col("class") == "english_gap", F.lit(False)))
    events = fired.join(known.where(~F.col("failed")).select("question_id", "tier", "gaps"), "question_id").select("question_id", "tier", "gaps", "signature", reached(F.col("confidence"))).where("level >= 0")
    hit = events.groupBy("question_id", "tier", "gaps").agg(F.max("level").alias("level"), F.count("*").alias("n"))

    def summed(found: DataFrame, axis: list[str], values: DataFrame, counts: list[str]) -> DataFrame:
        """Counts at or above each level beside the values, which are few: a row for each tier or signature."""
        above = Window.partitionBy(*axis).orderBy(F.desc("level"))
        cells = values.select(*values.columns, levels).select(*values.columns, "l.*")
        of = found.select(*(F.col(c).alias(f"__{c}") for c in [*axis, "level"]), *counts)
        own = cells.join(of, reduce(and_, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in [*axis, "level"])), "left")
        return own.select(*values.columns, "threshold", *(F.coalesce(F.sum(F.coalesce(c, F.lit(0))).over(above), F.lit(0)).alias(c) for c in counts))

    by_question = hit.groupBy("tier", "level").agg(F.count("*").alias("with_override"), F.count_if(F.col("gaps") == 0).alias("newly_unclean"), F.count_if(F.col("gaps") > 0).alias("more_unclean"))
    by_event = events.groupBy("tier", "level").agg(F.count("*").alias("overrides"))
    cells = by_question.join(by_event, ["tier", "level"], "full")
    counts = ["overrides", "with_override", "newly_unclean", "more_unclean"]
    tiers = known.groupBy("tier").agg(F.count_if(~F.col("failed")).alias("questions"))
    tier_rows = summed(cells, ["tier"], tiers, counts).select("tier", "threshold", "questions", "overrides", "with_override")
    signature_rows = summed(events.groupBy("signature", "level").agg(F.count("*").alias("overrides")), ["signature"], events.select("signature").distinct(), ["overrides"])
    base = known.agg(F.count("*").alias("n_questions"), F.count_if(F.col("gaps") == 0).alias("baseline_clean"))
    totals = summed(cells.groupBy("level").agg(*(F.sum(c).alias(c) for c in counts)), [], base, counts)
    percent = lambda c: F.coalesce(F.round(c / F.nullif(F.col("n_questions"), F.lit(0)) * 100, 2), F.lit(0.0))
    projected = F.col("baseline_clean") - F.col("newly_unclean")
    return totals.select("threshold", "n_questions", "baseline_clean", *counts, projected.alias("projected_clean"), percent(F.col("baseline_clean")).alias("baseline_percent"), percent(projected).alias("projected_percent")), tier_rows, signature_rows
