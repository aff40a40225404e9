"""Mining of opposed terms in texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillmill.functions import refdata as R


def reject_reason(a: Column, b: Column) -> Column:
    """Why two terms are no pair, by the first rule that holds; null for a pair."""
    either = lambda words: a.isin(*words) | b.isin(*words)
    known = sorted({"|".join(sorted(w.lower() for w in p)) for p in [*R.LABEL_PAIRS, *R.UPPERCASE_PAIRS]})
    return (
        F.when(a == b, "same_token").when((F.length(a) < 3) | (F.length(b) < 3), "too_short").when(either(R.DIRECTIONAL_NOISE), "directional_noise").when(either(R.GENERIC_NOISE), "generic_noise")
        .when(either(R.LABEL_QUANTIFIERS), "universal_quantifier").when(F.concat_ws("|", F.least(a, b), F.greatest(a, b)).isin(*known), "already_known")
    )


def found_pairs(texts: DataFrame, id_col: str, text: str, patterns: dict[str, str] = R.PAIR_PATTERNS) -> DataFrame:
    """id_col, at (pattern and match, in order), pattern, first, second, reason, snippet: a row for each match.

    The snippet runs from 50 characters before the first place of the first term to 100 after it."""
    match = lambda name, number, p: lambda m, i: F.struct(F.struct(F.lit(number).alias("p"), i.alias("i")).alias("at"), F.lit(name).alias("pattern"), F.lower(F.regexp_extract(m, p, 1)).alias("a"), F.lower(F.regexp_extract(m, p, 2)).alias("b"))
    found = F.concat(*(F.transform(F.regexp_extract_all(F.col(text), F.lit(p), 0), match(name, k, p)) for k, (name, p) in enumerate(patterns.items())))
    rows = texts.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"), F.explode(found).alias("m"))
    start = F.call_function("locate", F.col("m.a"), F.lower("__text")) - 1
    begin = F.greatest(start - 50, F.lit(0))
    snippet = F.btrim(F.substring("__text", begin + 1, start + F.length("m.a") + 100 - begin), F.lit(" \t\n\x0b\x0c\r"))
    return rows.select(F.col("__id").alias(id_col), F.col("m.at").alias("at"), F.col("m.pattern").alias("pattern"), F.col("m.a").alias("first"), F.col("m.b").alias("second"), reject_reason(F.col("m.a"), F.col("m.b")).alias("reason"), snippet.alias("snippet"))


def mined(found: DataFrame, id_col: str, least: int = 3, near: int = 2, examples: int = 3) -> DataFrame:
    """a, b, n, patterns (a map of counts), examples (the first snippets), status: surfaced from `least` matches on,
    near_miss from `near` on; rarer pairs are left out.

    Matches are counted before they are shuffled, by pair and pattern; of the snippets only the first few of
    each task are shuffled, so a pair that is everywhere is no large group."""
    pair = [F.least("first", "second").alias("a"), F.greatest("first", "second").alias("b")]
    kept = found.where(F.col("reason").isNull())
    counts = kept.groupBy(*pair, "pattern").agg(F.count("*").alias("n"))
    whole = counts.groupBy("a", "b").agg(F.sum("n").alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("pattern", "n")))).alias("patterns")).where(F.col("n") >= near)
    order = Window.partitionBy("a", "b").orderBy(id_col, "at")
    first = kept.select(*pair, id_col, "at", "snippet").withColumn("k", F.row_number().over(order)).where(F.col("k") <= examples)
    shown = first.groupBy("a", "b").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "snippet"))), lambda x: x.snippet).alias("examples"))
    return whole.join(shown, ["a", "b"]).select("a", "b", "n", "patterns", "examples", F.when(F.col("n") >= least, "surfaced").otherwise("near_miss").alias("status"))


def rejections(found: DataFrame) -> DataFrame:
    """Matches by the reason that rejected them."""
    return found.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n"))
