"""Fixers: rewrites of an option or stem, routed by the signature of a signal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.functions.text import has_word, replace_word


def drop_quantifier(text: Column, least_words: int = 10) -> Column:
    """Without its first quantifier, if ten words remain; else null, for a rewrite."""
    short = F.trim(F.regexp_replace(F.regexp_replace(text, r"(?is)^(.*?)\b(?:" + "|".join(R.QUANTIFIERS) + r")\b\s*", "$1"), " +", " "))
    return F.when(F.size(F.split(short, r"\s+")) >= least_words, short)


def swap_pair(stem: Column, text: Column, pairs: list[tuple[str, str]]) -> Column:
    """text with the label that the stem contradicts put right: the first pair of which
    the stem has exactly one side decides (X03, X04, X05)."""
    out = text
    for a, b in reversed(pairs):
        out = F.when(has_word(stem, a) & ~has_word(stem, b), replace_word(text, b, a)).when(has_word(stem, b) & ~has_word(stem, a), replace_word(text, a, b)).otherwise(out)
    return out


def middle_age(instrument: Column) -> Column:
    """The middle of an instrument's range, two years inside its edges, rounded half to even."""
    out = F.lit(None).cast("int")
    for name, (low, high) in R.INSTRUMENT_AGES.items():
        middle = F.bround(F.lit((low + 2 + high - 2) / 2)).cast("int")
        out = F.when(F.lower(instrument) == name, middle).otherwise(out)
    return out


def set_stem_age(stem: Column, age: Column) -> Column:
    """The stem's first age replaced, in each of its three forms."""
    forms = [r"^((?s:.)*?\b)\d+(-year-old\b)", r"(?i)^((?s:.)*?\bage\s+)\d+()", r"(?i)^((?s:.)*?\b)\d+( years old\b)"]
    out = stem
    for pattern in reversed(forms):  # two groups only, so digits after $1 are text
        out = F.when(stem.rlike(pattern), F.regexp_replace(stem, F.lit(pattern), F.concat(F.lit("$1"), age.cast("string"), F.lit("$2")))).otherwise(out)
    return out


def route(signature: Column, stem: Column, text: Column) -> Column:
    """The rewritten text by signature; null where a model has to rewrite."""
    return (
        F.when(signature == "universal_quantifier", drop_quantifier(text))
        .when(signature == "laterality", swap_pair(stem, text, R.LATERAL_PAIRS))
        .when(signature == "stage_timing", swap_pair(stem, text, R.STAGE_PAIRS))
        .when(signature == "schema_labeling", swap_pair(stem, text, R.LABEL_PAIRS))
    )


def dispatch(questions: DataFrame, signals: DataFrame) -> DataFrame:
    """Questions with their fired signals' fixes applied in order, patches adding up,
    and how many each fixer made (X09)."""
    fired = signals.where("fired").groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("letter", "signature"))).alias("__fired"))
    joined = questions.join(fired, "question_id", "left")

    def patched(o: Column) -> Column:
        own = F.filter(F.coalesce("__fired", F.array().cast("array<struct<letter:string,signature:string>>")), lambda s: s.letter == o.letter)
        text = F.aggregate(own, o.text, lambda t, s: F.coalesce(route(s.signature, F.col("question_stem"), t), t))
        return o.withField("text", text)

    fixed = joined.withColumn("__old", F.col("options")).withColumn("options", F.transform("options", patched))
    changed = F.size(F.filter(F.arrays_zip("__old", "options"), lambda z: z["__old"]["text"] != z["options"]["text"]))
    return fixed.withColumn("n_fixed", changed).drop("__old", "__fired")
