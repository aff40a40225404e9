"""What gives a correct option away: its length (A10) and its marks of elaboration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.operators.questions import correct, distractors

LIMITS = (1.3, 1.5, 1.8, 2.0)
MARKS = tuple(R.ELABORATION)  # parens, semicolons, dashes, ie_eg


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(values), F.lit(0))


def length_ratios(questions: DataFrame) -> DataFrame:
    """question_id, ratio (longest by shortest option), to_mean (the correct one by the mean distractor), longest and
    much_longer (than 1.2 times the longest distractor).  An empty option makes a ratio infinite."""
    size = F.transform("options", lambda o: F.length(F.coalesce(o.text, F.lit(""))))
    wrong = F.transform(distractors(), lambda t: F.length(F.coalesce(t, F.lit(""))))
    own = F.length(F.coalesce(correct(), F.lit("")))
    by = lambda a, b: F.when(b == 0, float("inf")).otherwise(a / F.nullif(b, F.lit(0)))
    return questions.select("question_id", by(F.array_max(size), F.array_min(size)).alias("ratio"), by(own, _mean(wrong)).alias("to_mean"), (own == F.array_max(size)).alias("longest"), (own > F.array_max(wrong) * 1.2).alias("much_longer"))


def length_summary(ratios: DataFrame) -> DataFrame:
    """One row: mean, median and greatest ratio, questions above each limit, and how often the correct option stands out (A10)."""
    over = [F.count_if(F.col("ratio") > t).alias(f"over_{str(t).replace('.', '_')}") for t in LIMITS]
    return ratios.agg(
        F.count("*").alias("n"), F.avg("ratio").alias("mean_ratio"), F.median("ratio").alias("median_ratio"), F.max("ratio").alias("max_ratio"), *over,
        F.count_if("longest").alias("correct_longest"), F.count_if("much_longer").alias("correct_much_longer"), F.avg("to_mean").alias("mean_to_distractors"),
    )


def marks(text: Column) -> Column:
    """How often each mark stands in a text."""
    return F.struct(*(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(R.ELABORATION[m])).alias(m) for m in MARKS))


def marked_options(questions: DataFrame) -> DataFrame:
    """question_id, total (marks of the correct option), most and mean (of the distractors), over_most, over_mean, only (the
    marks that no distractor has) and strict: two marks or more, and none in any distractor (A11)."""
    counted = questions.select("question_id", marks(correct()).alias("own"), F.transform(distractors(), marks).alias("others"))
    total = lambda m: sum((m[k] for k in MARKS[1:]), m[MARKS[0]])
    rest = F.transform("others", total)
    one = lambda k: F.when((F.col("own")[k] >= 1) & (F.array_max(F.transform("others", lambda m: m[k])) == 0), k)
    told = counted.select("question_id", total(F.col("own")).alias("total"), F.array_max(rest).alias("most"), _mean(rest).alias("mean"), F.filter(F.array(*map(one, MARKS[:3])), lambda k: k.isNotNull()).alias("only"))
    return told.select("question_id", "total", "most", "mean", (F.col("total") > F.col("most")).alias("over_most"), (F.col("total") > F.col("mean")).alias("over_mean"), "only", ((F.col("total") >= 2) & (F.col("most") == 0)).alias("strict"))


def marks_summary(told: DataFrame) -> DataFrame:
    """One row: how many questions each of the tells hits."""
    only = [F.count_if(F.array_contains("only", k)).alias(f"{k}_only_correct") for k in MARKS[:3]]
    return told.agg(F.count("*").alias("n"), F.count_if("over_most").alias("over_most"), F.count_if("over_mean").alias("over_mean"), *only, F.count_if("strict").alias("strict"))
