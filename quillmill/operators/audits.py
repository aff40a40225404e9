"""Offline audits of a question: each a struct (metric, flag); null where exempt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.functions import text as T
from quillmill.operators.questions import all_texts, correct, distractors


def _content(text: Column) -> Column:
    return T.tokens(text, 4, R.COGNITIVE_STOP)


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(values), F.lit(0))


def _told(metric: Column, flag: Column) -> Column:
    return F.struct(metric.cast("double").alias("metric"), F.coalesce(flag, F.lit(False)).alias("flag"))


def _not_except(told: Column) -> Column:
    return F.when(~F.col("question_stem").rlike(R.EXCEPT_AUDIT), told)


def median(values: Column) -> Column:
    """Of an array: the middle value or the mean of the two."""
    ordered, n = F.array_sort(values), F.size(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    return (low + F.get(ordered, F.floor(n / 2).cast("int"))) / 2


def length_bias() -> Column:
    """The correct option is the longest, or over 15 % above the distractors' median (Q01)."""
    sizes = F.transform(distractors(), F.length)
    over = (F.length(correct()) - median(sizes)) / F.nullif(median(sizes), F.lit(0.0)) * 100
    return _told(over, (F.length(correct()) > F.array_max(sizes)) | (over > 15))


def except_oddness() -> Column:
    """EXCEPT stems: distractors like each other, the correct one unlike them (Q02)."""
    sets = F.transform(distractors(), lambda t: F.array_distinct(_content(t)))
    n = F.size(sets)
    index = F.sequence(F.lit(0), n - 1)
    pairs = F.flatten(F.transform(index, lambda i: F.transform(F.filter(index, lambda j: j > i), lambda j: T.jaccard(F.get(sets, i), F.get(sets, j)))))
    own = F.array_distinct(_content(correct()))
    between, to_correct = _mean(pairs), _mean(F.transform(sets, lambda s: T.jaccard(own, s)))
    return F.when(F.col("question_stem").rlike(R.EXCEPT_AUDIT) & (n >= 2), _told(between - to_correct, (between - to_correct > 0.20) & (between > 0.30)))


def term_mismatch() -> Column:
    """Stem and answer have one of two opposites, every distractor only the other (Q03)."""
    whole = lambda t, w: F.lower(t).rlike(rf"\b{w}\b")
    hits = F.lit(0)
    for a, b in R.ANTONYM_PAIRS:
        for x, y in ((a, b), (b, a)):
            only = F.forall(distractors(), _only(whole, x, y))
            hits = hits + (whole(F.col("question_stem"), x) & whole(correct(), x) & only).cast("int")
    return _told(hits, hits > 0)


def _only(whole, x: str, y: str):
    return lambda t: whole(t, y) & ~whole(t, x)


def synonym_uniqueness() -> Column:
    """Words of five letters and more that only the answer has (Q04)."""
    others = F.array_union(F.array_distinct(_content(F.col("question_stem"))), F.array_distinct(F.flatten(F.transform(distractors(), _content))))
    own = F.filter(F.array_except(F.array_distinct(_content(correct())), others), lambda w: F.length(w) >= 5)
    return _told(F.size(own), F.size(own) >= 3)


def keyword_concentration(keywords: Column) -> Column:
    """The answer holds two keywords, distractors hardly any (Q05)."""
    hits = lambda t: F.size(F.filter(keywords, lambda k: F.contains(F.lower(t), F.lower(k))))
    mean = _mean(F.transform(distractors(), lambda t: hits(t).cast("double")))
    return F.when(F.size(keywords) > 0, _told(hits(correct()), (hits(correct()) >= 2) & (mean < 0.5)))


def stem_keyword_in_correct_only() -> Column:
    """Stem words that the answer repeats and no distractor does (Q06)."""
    stem, texts = F.array_distinct(_content(F.col("question_stem"))), F.transform(distractors(), F.lower)
    own = F.filter(stem, lambda w: F.contains(F.lower(correct()), w) & ~T.appears_in(w, texts))
    return _not_except(F.when(F.size(stem) > 0, _told(F.size(own), F.size(own) >= 2)))


def option_self_reference() -> Column:
    """Options that announce themselves (Q07)."""
    hits = F.aggregate(F.transform(all_texts(), lambda t: F.size(F.regexp_extract_all(t, F.lit(R.SELF_REFERENCE), 0))), F.lit(0), lambda a, x: a + x)
    return _told(hits, hits > 0)


def irrelevant_option() -> Column:
    """Options that share no word with any sibling (Q08)."""
    sets = F.transform(all_texts(), lambda t: F.array_distinct(_content(t)))
    alone = F.filter(F.transform(sets, lambda s, i: F.struct(s.alias("s"), i.alias("i"))), lambda x: (F.size(x.s) > 0) & ~F.exists(F.transform(sets, lambda s, i: F.struct(s.alias("s"), i.alias("i"))), lambda y: (y.i != x.i) & F.arrays_overlap(x.s, y.s)))
    return _not_except(_told(F.size(alone), F.size(alone) > 0))


def option_fragment() -> Column:
    """Options of fewer than four content words (Q09)."""
    short = F.filter(all_texts(), lambda t: (t != "") & (F.size(_content(t)) < 4))
    return _told(F.size(short), F.size(short) > 0)


AUDITS = {
    "length_bias": length_bias, "except_oddness": except_oddness, "term_mismatch": term_mismatch, "synonym_uniqueness": synonym_uniqueness,
    "stem_keyword_in_correct_only": stem_keyword_in_correct_only, "option_self_reference": option_self_reference, "irrelevant_option": irrelevant_option, "option_fragment": option_fragment,
}


def audit(questions: DataFrame) -> DataFrame:
    """question_id and one struct per audit."""
    return questions.select("question_id", "difficulty_tier", *(build().alias(name) for name, build in AUDITS.items()))


def flag_rollup(audited: DataFrame, names: list[str] = list(AUDITS)) -> DataFrame:
    """How many questions each flag hits, and how many any does."""
    flags = F.filter(F.array(*(F.when(F.col(f"{n}.flag"), n) for n in names)), lambda x: x.isNotNull())
    hit = audited.select(flags.alias("f")).select(F.explode(F.when(F.size("f") > 0, F.concat("f", F.array(F.lit("any_flag")))).otherwise(F.col("f"))).alias("flag"))
    return hit.groupBy("flag").agg(F.count("*").alias("n"))


def rewrite_stem(flagged: Column, wrong: Column, share: float = 0.5) -> Column:
    """Whether so many distractors are flagged that the stem has to change (Q10)."""
    return F.coalesce(flagged / F.nullif(wrong, F.lit(0)) >= share, F.lit(False))
