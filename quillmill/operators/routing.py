"""Fixes routed by the signature of a signal, over text and explanation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.functions import text as T

QUANTIFIER = r"(?i)\b(?:" + "|".join(R.QUANTIFIERS) + r")\b"
RATIO = r"\b\d+:\d+\b"
SIGNAL = "array<struct<letter:string,signature:string,pair:array<string>>>"
REWRITE = "array<struct<letter:string,signature:string,text:string,explanation:string>>"
#: Fixer of each signature; other signatures are left to a rewrite of the whole question.
FIXERS = {
    "universal_quantifier": "universal_quantifier_fixer", "laterality": "laterality_fixer", "stage_timing": "stage_timing_fixer", "numeric_ratio": "numeric_ratio_fixer",
    "tier_a_brief": "schema_labeling_fixer", "tier_b_lexical": "schema_labeling_fixer",
}


def _new(text: Column, explanation: Column) -> Column:
    return F.struct(text.alias("text"), explanation.alias("explanation"))


def _rewrite(rewrites: Column, letter: Column, signature: Column, explanation: Column, *forbidden: str) -> Column:
    """The earlier answer of a model, unless it is blank or brings back what it should remove."""
    found = F.get(F.filter(rewrites, lambda r: (r.letter == letter) & (r.signature == signature) & (F.trim(r.text) != "")), F.lit(0))
    bad = F.lit(False)
    for pattern in forbidden:
        bad = bad | found.text.rlike(pattern)
    told = F.trim(F.coalesce(found.explanation, F.lit("")))
    return F.when(found.isNotNull() & ~bad, _new(F.trim(found.text), F.when(told != "", told).otherwise(explanation)))


def without_quantifier(text: Column, explanation: Column, rewrite: Column, least_words: int = 10) -> Column:
    """The first quantifier dropped where ten words remain, else a rewrite without any."""
    short = F.trim(F.regexp_replace(F.regexp_replace(text, r"(?s)^(.*?)" + QUANTIFIER, "$1"), r"\s+", " "))
    return F.when(text.rlike(QUANTIFIER), F.when(F.size(F.split(short, " ")) >= least_words, _new(short, explanation)).otherwise(rewrite))


def flipped(stem: Column, text: Column, explanation: Column, pairs: list[tuple[str, str]]) -> Column:
    """Of the first pair of which the stem has exactly one side, the other side is replaced in text and
    explanation, if the text has it (X03, X05)."""
    out = F.lit(None)
    for a, b in reversed(pairs):
        one = lambda keep, drop: F.when(T.has_word(text, drop), _new(T.replace_word(text, drop, keep), T.replace_word(explanation, drop, keep)))
        has_a, has_b = T.has_word(stem, a), T.has_word(stem, b)
        out = F.when(has_a & ~has_b, one(a, b)).when(has_b & ~has_a, one(b, a)).otherwise(out)
    return out


def relabelled(text: Column, explanation: Column, pair: Column, known: list[tuple[str, str]]) -> Column:
    """The matched pair's other side, if the text has exactly one; the explanation stays (X04).  Pairs are those that are known."""
    out = F.lit(None)
    for a, b in known:
        has_a, has_b = T.has_word(text, a), T.has_word(text, b)
        swap = F.when(has_a & ~has_b, _new(T.replace_word(text, a, b), explanation)).when(has_b & ~has_a, _new(T.replace_word(text, b, a), explanation))
        out = F.when(F.array_sort(F.transform(pair, F.lower)) == F.array(*map(F.lit, sorted((a.lower(), b.lower())))), swap).otherwise(out)
    return out


def rerouted(stem: Column, o: Column, s: Column, rewrites: Column) -> Column:
    """text and explanation of option o by signal s; null where nothing is to be changed."""
    text, why = F.coalesce(o.text, F.lit("")), F.coalesce(o.explanation, F.lit(""))
    ratio = F.when(stem.rlike(RATIO) & text.rlike(RATIO), _rewrite(rewrites, o.letter, s.signature, why, QUANTIFIER, RATIO))
    return (
        F.when(s.signature == "universal_quantifier", without_quantifier(text, why, _rewrite(rewrites, o.letter, s.signature, why, QUANTIFIER))).when(s.signature == "laterality", flipped(stem, text, why, R.LATERAL_PAIRS))
        .when(s.signature == "stage_timing", flipped(stem, text, why, R.STAGE_PAIRS)).when(s.signature.isin("tier_a_brief", "tier_b_lexical"), relabelled(text, why, s.pair, [*R.LABEL_PAIRS, *R.UPPERCASE_PAIRS])).when(s.signature == "numeric_ratio", ratio)
    )


def route_fixes(questions: DataFrame, signals: DataFrame, rewrites: DataFrame) -> DataFrame:
    """questions with options patched, attempted, by_fixer (a map of changes), patched and residual.

    questions: question_id, question_stem, options, flagged (letters).  signals: question_id, letter, signature, fired,
    pair.  rewrites: question_id, letter, signature, text, explanation, earlier answers of a model.

    Signals of a question are taken by letter and signature; each works on what the ones before it left, and none
    touches the correct option.  attempted counts fired signals that have a fixer; residual: flagged and nothing was changed.
    """
    fired = signals.where("fired").where(F.col("signature").isin(*FIXERS)).groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("letter", "signature", "pair"))).alias("__fired"))
    answers = rewrites.groupBy("question_id").agg(F.collect_list(F.struct("letter", "signature", "text", "explanation")).alias("__answers"))
    joined = questions.join(fired, "question_id", "left").join(answers, "question_id", "left")
    own = F.coalesce("__fired", F.expr(f"cast(array() as {SIGNAL})"))
    known = F.coalesce("__answers", F.expr(f"cast(array() as {REWRITE})"))
    kind = questions.schema["options"].dataType.simpleString()
    start = F.struct(F.col("options").alias("options"), F.expr("cast(array() as array<string>)").alias("log"))

    def step(acc: Column, s: Column) -> Column:
        def patched(o: Column) -> Column:
            mine = (o.letter == s.letter) & ~F.coalesce(o.is_correct, F.lit(False))
            return F.when(mine, T.bound(rerouted(F.col("question_stem"), o, s, known), lambda new: F.when(new.isNotNull(), o.withField("text", new.text).withField("explanation", F.when(new.explanation != "", new.explanation).otherwise(o.explanation))).otherwise(o))).otherwise(o)

        changed = lambda new: ~new.eqNullSafe(acc.options)
        return T.bound(F.transform(acc.options, patched), lambda new: F.struct(new.cast(kind).alias("options"), F.when(changed(new), F.concat(acc.log, F.array(s.signature))).otherwise(acc.log).alias("log")))

    made = joined.withColumn("__made", F.aggregate(own, start, step))
    fixers = F.create_map(*(F.lit(x) for pair in FIXERS.items() for x in pair))
    names = F.transform("__made.log", lambda x: F.element_at(fixers, x))
    counts = F.map_from_entries(F.transform(F.array_sort(F.array_distinct(names)), lambda n: F.struct(n, F.size(F.filter(names, _same(n))))))
    return made.select(
        *(F.col("__made.options").alias(c) if c == "options" else F.col(c) for c in questions.columns), F.size(own).alias("attempted"), counts.alias("by_fixer"), (F.size("__made.log") > 0).alias("patched"),
        ((F.size("__made.log") == 0) & (F.size(F.coalesce("flagged", F.array().cast("array<string>"))) > 0)).alias("residual"),
    )


def _same(n: Column) -> Callable[[Column], Column]:
    return lambda x: x == n


def routed_chapters(fixed: DataFrame, chapter: str = "chapter", usd_each: float = 0.005) -> DataFrame:
    """attempted, applied (questions patched), residual, cost and the changes of each fixer, by chapter."""
    names = sorted(set(FIXERS.values()))
    return fixed.groupBy(chapter).agg(
        F.sum("attempted").alias("attempted"), F.count_if("patched").alias("applied"), F.count_if("residual").alias("residual"), F.round(F.count_if("patched") * usd_each, 3).alias("cost"),
        *(F.sum(F.coalesce(F.element_at("by_fixer", n), F.lit(0))).alias(n) for n in names),
    )
