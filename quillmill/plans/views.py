"""Table access, and the SQL forms of the derived views for the oracle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from quillmill.operators.questions import OPTION_PHRASES, STEM_PHRASES, from_documents


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """rows over all cores, where the file has fewer parts than there are cores: a
    file of one row group is read by one task, and all that follows would be too.
    A table of many parts is left as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_documents(spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")))


def sql_list(items: Iterable[str]) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


#: The question view: texts in order A to D, `pos` the correct one's position from 1.
SQL_QUESTIONS = r"""
d AS (SELECT doc_id, lang, source, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS w FROM documents),
dk AS (SELECT doc_id, lang, source, w[k * 65 + 1:k * 65 + 65] AS w, k FROM (SELECT *, unnest(range(0, (len(w) + 5) // 65)) AS k FROM d WHERE len(w) >= 60)),
q0 AS (
  SELECT doc_id, 'QZ-' || upper(lang) || '-' || doc_id || '-' || k AS question_id, lang AS domain, source AS chapter,
    ((doc_id + k) % 4 + 1)::INTEGER AS difficulty_tier, {STEM}[(doc_id + k) % {N_STEM} + 1] || array_to_string(w[1:20], ' ') AS stem,
    [{OPTION}[(doc_id + 3 * k + 0) % {N_OPTION} + 1] || array_to_string(w[21:30], ' '), {OPTION}[(doc_id + 3 * k + 7) % {N_OPTION} + 1] || array_to_string(w[31:40], ' '), {OPTION}[(doc_id + 3 * k + 14) % {N_OPTION} + 1] || array_to_string(w[41:50], ' '), {OPTION}[(doc_id + 3 * k + 21) % {N_OPTION} + 1] || array_to_string(w[51:60], ' ')] AS texts,
    [array_to_string(w[26:35], ' '), array_to_string(w[36:45], ' '), array_to_string(w[46:55], ' '), array_to_string(w[56:65], ' ')] AS explanations,
    ((doc_id // 4 + k) % 4 + 1)::INTEGER AS pos
  FROM dk),
q AS (
  SELECT *, texts[pos] AS correct, list_filter(texts, lambda t, i: i <> pos) AS wrong,
    list_filter(['A', 'B', 'C', 'D'], lambda t, i: i <> pos) AS wrong_letters FROM q0)
""".replace("{STEM}", sql_list(STEM_PHRASES)).replace("{N_STEM}", str(len(STEM_PHRASES))).replace("{OPTION}", sql_list(OPTION_PHRASES)).replace("{N_OPTION}", str(len(OPTION_PHRASES)))


def sql_tokens(text: str, least: int = 4, stop: Iterable[str] = ()) -> str:
    stop = [*stop]
    rest = f" AND NOT list_contains({sql_list(stop)}, w)" if stop else ""
    return rf"list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '[^\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-zà-öø-ÿ]{{{least},}}'){rest})"


def sql_set(text: str, least: int = 4, stop: Iterable[str] = ()) -> str:
    return f"list_distinct({sql_tokens(text, least, stop)})"


def sql_jaccard(a: str, b: str) -> str:
    return f"coalesce(len(list_intersect({a}, {b})) / nullif(len(list_distinct(list_concat({a}, {b}))), 0)::DOUBLE, 0.0)"
