"""Topic keywords of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.functions import text as T

WORD, BLANK = r"\p{L}\p{N}_", r"[\s\x1c-\x1f\x85\p{Z}]+"
PAIR_PATTERN = rf"(?<![{WORD}])[a-z]{{3,}}{BLANK}[a-z]{{3,}}(?![{WORD}])"
WORD_PATTERN = rf"(?<![{WORD}])[a-z]{{4,}}(?![{WORD}])"


def filled(pairs: Column, words: Column, most: int, top_pairs: int) -> Column:
    """The first pairs, then each word in turn that is no part of what was chosen before, up to `most`.

    A word depends on all choices before it, so the words are folded; pairs and words: arrays of text, best first."""
    start = F.slice(pairs, 1, top_pairs)
    add = lambda chosen, w: F.when((F.size(chosen) < most) & ~F.contains(F.array_join(chosen, " "), w), F.concat(chosen, F.array(w))).otherwise(chosen)
    return F.slice(F.aggregate(words, start, add), 1, most)


def topic_keywords(rows: DataFrame, id_col: str, content: str, labels: str, *, most: int = 5, top_pairs: int = 3, enough_labels: int = 3, least_chars: int = 20, boost: int = 3) -> DataFrame:
    """id_col, topic_keywords: array, one row for each row; ids are unique.

    With three labels or more, the first five of them.  Else the three most
    frequent pairs of neighbouring words (read without overlap, neither a stop word), then single
    words, boosted terms counting three times, that no keyword so far contains; ties go to what stands first.
    A null text, or one of under 20 characters, gives none.  Terms are counted before
    they are shuffled; what meets in one task is the distinct terms of one text.
    """
    stop = set(R.KEYWORD_STOP)
    own = F.size(F.coalesce(labels, F.array().cast("array<string>"))) >= enough_labels
    open_ = rows.where(~own & (F.length(content) >= least_chars)).select(F.col(id_col).alias("id"), F.lower(content).alias("low"))
    clean = lambda p: F.forall(F.split(p, " "), lambda w: ~w.isin(*stop))
    pairs = F.transform(F.regexp_extract_all("low", F.lit(PAIR_PATTERN), 0), lambda p: F.regexp_replace(p, BLANK, " "))
    words = F.regexp_extract_all("low", F.lit(WORD_PATTERN), 0)
    terms = F.concat(F.transform(pairs, lambda p, i: F.struct(F.lit(0).alias("kind"), p.alias("term"), i.alias("at"))), F.transform(words, lambda w, i: F.struct(F.lit(1).alias("kind"), w.alias("term"), i.alias("at"))))
    counted = open_.select("id", F.explode(terms).alias("t")).select("id", "t.*").groupBy("id", "kind", "term").agg(F.count("*").alias("n"), F.min("at").alias("at")).where(clean(F.col("term")))
    weight = F.when((F.col("kind") == 1) & F.col("term").isin(*R.KEYWORD_BOOST), F.col("n") * boost).otherwise(F.col("n"))
    ranked = counted.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("kind", (-weight).alias("w"), "at", "term"))).alias("r"))
    of = lambda kind: F.transform(F.filter("r", lambda x: x.kind == kind), lambda x: x.term)
    found = ranked.select("id", T.bound(of(0), lambda p: filled(p, of(1), most, top_pairs)).alias("found"))
    joined = rows.select(F.col(id_col).alias("__id"), F.when(own, F.slice(labels, 1, most)).alias("own")).join(found, F.col("__id") == F.col("id"), "left")
    return joined.select(F.col("__id").alias(id_col), F.coalesce("own", "found", F.array().cast("array<string>")).alias("topic_keywords"))
