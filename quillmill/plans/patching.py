"""Queries of critiques, rescues, rubric audits, name sweeps and whole records, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import refdata
from quillmill.operators import assembly, patches, sweeps
from quillmill.plans.flows import _chapter_questions, drawn, sql_drawn
from quillmill.plans.more import _NAMED, _cited
from quillmill.plans.views import SQL_QUESTIONS, questions, sql_list

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register


def _q(sql: str) -> str:
    return f"WITH {SQL_QUESTIONS.rstrip()}{sql}"


def _joined(field: str) -> Column:
    return F.array_join(F.transform("options", lambda o: o[field]), "|").alias(f"{field}s")


def _json(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


# --- critiques


def _critiqued(spark: SparkSession, d: str) -> DataFrame:
    """Answers planted by a checksum: most revise; some keep, fail, say nothing, or try to make another option the correct one."""
    rows = _chapter_questions(spark, d)
    h, q = drawn(F.col("question_id"), "critique"), F.col("question_id")
    wrong = F.transform(F.filter("options", lambda o: ~o.is_correct), lambda o: o.letter)
    asked = rows.withColumn("flagged", F.filter(wrong, lambda x: drawn(q, x, "flagged") < 60))
    stem = F.when(h % 3 == 0, "  ").otherwise(F.concat(F.lit("Revised "), q))
    new = _json('{"revised": true, "rationale": "since", "question": {"question_stem": "', stem, '", "options": [{"letter": "A", "text": "a of ', q, '", "is_correct": true}, {"letter": "B", "explanation": "b of ', q, '", "is_correct": false}, {"letter": "C", "text": 5}, {"letter": "D", "text": ""}]}}')
    content = F.when(h < 20, "no json").when(h < 80, '{"revised": false, "rationale": "fine"}').otherwise(F.concat(F.lit("```json\n"), new, F.lit("\n```")))
    return patches.self_critique(asked, rows.where(h < 240).select(q, content.alias("content"), F.when((h >= 20) & (h < 30), "late").alias("error")))


_CRITIQUED = f""",
h AS (SELECT *, {sql_drawn("question_id", "'critique'")} AS h, len(list_filter(wrong_letters, lambda l: {sql_drawn("question_id", "l", "'flagged'")} < 60)) AS n FROM q),
c AS (SELECT *, CASE WHEN n = 0 THEN 'skipped' WHEN h < 30 OR h >= 240 THEN 'failed' WHEN h < 80 THEN 'kept' ELSE 'revised' END AS outcome FROM h)"""


@query(_q(f"""{_CRITIQUED}
SELECT question_id, outcome, CASE WHEN outcome = 'failed' THEN CASE WHEN h < 20 THEN 'parse_failed' WHEN h < 30 THEN 'api_error: late' ELSE 'no_answer' END END AS error, CASE outcome WHEN 'kept' THEN 'fine' WHEN 'revised' THEN 'since' END AS rationale,
  CASE WHEN outcome = 'revised' AND h % 3 > 0 THEN 'Revised ' || question_id ELSE stem END AS question_stem, substring('ABCD', pos, 1) AS correct,
  CASE WHEN outcome = 'revised' THEN 'a of ' || question_id || '|' || texts[2] || '|' || texts[3] || '|' ELSE array_to_string(texts, '|') END AS texts,
  CASE WHEN outcome = 'revised' THEN explanations[1] || '|b of ' || question_id || '|' || explanations[3] || '|' || explanations[4] ELSE array_to_string(explanations, '|') END AS explanations FROM c"""))
def critiqued_questions(spark: SparkSession, d: str) -> DataFrame:
    right = F.get(F.filter("options", lambda o: o.is_correct), F.lit(0)).letter
    return _critiqued(spark, d).select("question_id", "outcome", "error", "rationale", "question_stem", right.alias("correct"), _joined("text"), _joined("explanation"))


@query(_q(f"""{_CRITIQUED}
SELECT doc_id AS chapter, count(*) FILTER (outcome <> 'skipped') AS attempted, count(*) FILTER (outcome = 'revised') AS revised, count(*) FILTER (outcome = 'failed') AS failed,
  round(coalesce(sum(h) FILTER (outcome <> 'skipped' AND h < 240), 0) * 6 / 10000.0, 4)::DOUBLE AS cost FROM c GROUP BY doc_id"""))
def critique_chapters(spark: SparkSession, d: str) -> DataFrame:
    done, h = _critiqued(spark, d), drawn(F.col("question_id"), "critique")
    usage = questions(spark, d).where(h < 240).select("question_id", (h * 20).alias("tokens_in"), (h * 4).alias("tokens_out"))
    return patches.critique_summary(done, usage)


# --- rescues

_GATES = [*patches.GATE_STRATEGIES, "length_balance"]


@query(_q(f""",
h AS (SELECT *, {sql_list(_GATES)}[{sql_drawn("question_id", "'gate'")} % {len(_GATES)} + 1] AS gate, {sql_drawn("question_id", "'rescue'")} AS h, {sql_drawn("question_id", "'right'")} < 10 AS wrongs FROM q),
e AS (SELECT *, CASE WHEN gate = 'length_balance' THEN 'no_strategy' WHEN wrongs THEN 'no_correct_option' WHEN h >= 240 THEN 'no_answer' WHEN h BETWEEN 20 AND 29 THEN 'late' WHEN h < 20 THEN 'no_parsed'
  WHEN h < 60 THEN CASE gate WHEN 'apply_identity' THEN 'missing_text_in_response' WHEN 'option_claim' THEN 'missing_options_in_response' ELSE 'missing_distractors_in_response' END END AS error FROM h),
o AS (SELECT question_id, gate, error, i, CASE WHEN error IS NOT NULL THEN 0 WHEN gate = 'apply_identity' THEN CASE WHEN i = pos THEN 1 ELSE 0 END WHEN gate = 'option_claim' THEN CASE WHEN i IN (1, 3) THEN 2 ELSE 0 END WHEN i IN (1, 2) AND i <> pos THEN 3 ELSE 0 END AS how, texts[i] AS text, explanations[i] AS why
  FROM e, range(1, 5) t(i) WHERE NOT (wrongs AND i = pos))
SELECT question_id, CASE WHEN any_value(error) = 'no_strategy' THEN NULL ELSE any_value(gate) END AS strategy, count(error) = 0 AS rescued, any_value(error) AS error,
  string_agg(CASE how WHEN 0 THEN text WHEN 1 THEN 'mechanism of ' || question_id WHEN 2 THEN 'claim ' || i ELSE 'other ' || i END, '|' ORDER BY i) AS texts,
  string_agg(CASE WHEN how = 0 THEN why WHEN how = 1 THEN 'it is' WHEN how = 2 AND i = 3 THEN 'moved' ELSE why END, '|' ORDER BY i) AS explanations FROM o GROUP BY question_id"""))
def gate_rescues(spark: SparkSession, d: str) -> DataFrame:
    rows, q = _chapter_questions(spark, d), F.col("question_id")
    h = drawn(q, "rescue")
    gate = F.element_at(F.array(*map(F.lit, _GATES)), drawn(q, "gate") % len(_GATES) + 1)
    failures = rows.select(q, gate.alias("gate"), F.filter("options", lambda o: ~(o.is_correct & (drawn(q, "right") < 10))).alias("options"))
    whole = _json('{"text": "mechanism of ', q, '", "explanation": "it is", "distractors": [{"letter": "A", "text": "other 1"}, {"letter": "B", "text": "other 2"}, {"letter": "D", "text": "", "explanation": "unused"}], "options": [{"letter": "A", "text": "claim 1"}, {"letter": "C", "text": "claim 3", "explanation": "moved"}]}')
    content = F.when(h < 20, "no json").when(h < 60, '{"note": "nothing"}').otherwise(whole)
    done = patches.rescue_by_gate(failures, rows.where(h < 240).select(q, content.alias("content"), F.when((h >= 20) & (h < 30), "late").alias("error")))
    return done.select("question_id", "strategy", "rescued", "error", _joined("text"), _joined("explanation"))


# --- rubric audits

_SAID = ["clean", "minor", "major", "awful"]
_RUBRIC = f",\nh AS (SELECT *, {sql_drawn('question_id', chr(39) + 'rubric' + chr(39))} AS h FROM q), r AS (SELECT *, {sql_list(_SAID)}[h % 4 + 1] AS said, CASE WHEN h >= 240 THEN 'no_answer' WHEN h < 10 THEN 'parse_failed' WHEN h < 30 THEN 'api_error: late' END AS broken FROM h)"


def _verdicts(spark: SparkSession, d: str, field: str, unknown_as: str | None) -> DataFrame:
    rows, q = questions(spark, d), F.col("question_id")
    h = drawn(q, "rubric")
    content = F.when(h < 10, "no json").otherwise(_json(f'{{"{field}": "', F.element_at(F.array(*map(F.lit, _SAID)), h % 4 + 1), '", "issues": [', F.array_join(F.array_repeat(F.lit('{"dimension": "stem"}'), h % 5), ","), '], "summary": "of ', q, '"}'))
    answers = rows.where(h < 240).select(q, content.alias("content"), F.when((h >= 10) & (h < 30), "late").alias("error"))
    return patches.rubric_verdicts(rows, answers, field, patches.EDITORIAL_CLASSES, unknown_as)


@query(_q(f"{_RUBRIC} SELECT question_id, CASE WHEN broken IS NULL THEN CASE said WHEN 'awful' THEN 'clean' ELSE said END END AS class, CASE WHEN broken IS NULL THEN h % 5 ELSE 0 END::INTEGER AS n_issues, CASE WHEN broken IS NOT NULL THEN '' WHEN said = 'awful' THEN 'unrecognized class ''awful''; coerced to clean' ELSE 'of ' || question_id END AS summary, broken AS error FROM r"))
def editorial_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return _verdicts(spark, d, "editorial_class", "clean")


@query(_q(f"{_RUBRIC} SELECT difficulty_tier, count(*) AS n, count(*) FILTER (broken IS NULL AND said = 'clean') AS clean, count(*) FILTER (broken IS NULL AND said = 'minor') AS minor, count(*) FILTER (broken IS NULL AND said = 'major') AS major, count(*) FILTER (broken IS NOT NULL OR said = 'awful') AS errors FROM r GROUP BY difficulty_tier"))
def diagnostic_counts(spark: SparkSession, d: str) -> DataFrame:
    told = _verdicts(spark, d, "diagnostic_quality_class", None).join(questions(spark, d).select("question_id", "difficulty_tier"), "question_id")
    return patches.rubric_counts(told, ["difficulty_tier"], patches.EDITORIAL_CLASSES)


# --- name sweeps

_BUCKETS = ("anchor", "passage", "brief")
_WHITELIST = ["Lashley", "The", "And"]
_SWEEP = f"""WITH {_NAMED},
k AS (SELECT doc_id, name, unnest(['year', 'according_to', 'et_al', 'possessive', 'bare_multi', 'bare_single', 'year']) AS kind FROM n),
g AS (SELECT doc_id, CASE kind WHEN 'bare_multi' THEN name || ' and ' || name ELSE name END AS name, kind FROM k WHERE kind NOT LIKE 'bare%' OR NOT list_contains({sql_list(refdata.NOT_NAMES)}, name) UNION ALL SELECT doc_id, 'Lashley', 'year' FROM n),
s AS (SELECT name, count(*) AS total, count(*) FILTER (doc_id % 3 = 0) AS in_anchor, count(*) FILTER (doc_id % 3 = 1) AS in_passage, count(*) FILTER (doc_id % 3 = 2) AS in_brief, count(*) FILTER (kind = 'year') AS as_year, count(*) FILTER (kind = 'et_al') AS as_et_al,
  count(*) FILTER (kind = 'according_to') AS as_according_to, count(*) FILTER (kind = 'possessive') AS as_possessive, list_contains({sql_list(_WHITELIST)}, name) AS whitelisted FROM g GROUP BY name)"""


def _swept(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts with citations behind them, one of them of two authors, one of whom all texts cite."""
    name = F.initcap(F.regexp_extract(F.lower("x"), "([a-z]{3,})", 1))
    bucket = F.element_at(F.array(*map(F.lit, _BUCKETS)), (F.pmod("doc_id", F.lit(3)) + 1).cast("int"))
    hits = sweeps.name_hits(_cited(spark, d), F.concat("x", F.lit(" "), name, F.lit(" & Lashley (1950) did.")), bucket)
    return sweeps.swept_names(hits, _BUCKETS, _WHITELIST)


@query(f"{_SWEEP} SELECT * FROM s")
def name_sweep(spark: SparkSession, d: str) -> DataFrame:
    return _swept(spark, d)


@query(f"{_SWEEP}, t AS (SELECT sum(total)::BIGINT AS instances, count(*) AS names, count(*) FILTER (whitelisted) AS listed_names, coalesce(sum(total) FILTER (whitelisted), 0)::BIGINT AS listed FROM s) SELECT *, round(listed * 100.0 / greatest(instances, 1), 1)::DOUBLE AS listed_percent, names - listed_names AS unlisted_names, instances - listed AS unlisted, round((instances - listed) * 100.0 / greatest(instances, 1), 1)::DOUBLE AS unlisted_percent FROM t")
def name_sweep_summary(spark: SparkSession, d: str) -> DataFrame:
    return sweeps.sweep_summary(_swept(spark, d))


@query(f"{_SWEEP} SELECT name, total FROM s WHERE NOT whitelisted ORDER BY total DESC, name LIMIT 40")
def unlisted_names(spark: SparkSession, d: str) -> DataFrame:
    return sweeps.top_names(_swept(spark, d), unlisted_only=True).select("name", "total")


# --- whole records


@query(_q(f""",
h AS (SELECT *, {sql_drawn("question_id", "'record'")} AS h FROM q),
e AS (SELECT *, CASE WHEN h % 3 = 0 THEN 'planned' WHEN h % 3 = 1 THEN 'written' END AS concept, CASE WHEN h % 3 = 2 THEN 'missing tested_concept' WHEN h % 7 = 0 THEN 'distractor count mismatch' END AS error FROM h),
o AS (SELECT question_id, i, substring('ABCD', i, 1) || ' ' || texts[i] || ' ' || explanations[i] || ' ' || CASE WHEN i = pos THEN concept || ' - - -' ELSE 'c' || k || ' ' || least(k, 2) || ' ' || concept || ' ' || CASE WHEN k = 2 THEN 'm2' ELSE 's' || k END END AS shown FROM (SELECT *, CASE WHEN i > pos THEN i - 1 ELSE i END AS k FROM e, range(1, 5) t(i) WHERE error IS NULL))
SELECT question_id, any_value(error) AS error, string_agg(shown, '|' ORDER BY i) AS options, coalesce(any_value(concept), '') AS concept, 'knows' AS knowledge, CASE WHEN any_value(h) % 2 = 0 THEN 'own front' ELSE 'What is it? What are its key characteristics and functions?' END || '/back' AS card,
  CASE WHEN any_value(h) % 5 = 0 THEN 'template' ELSE 'said,twice' END AS keywords, any_value(chapter) || '/' || CASE WHEN any_value(h) % 4 = 0 THEN any_value(chapter) ELSE any_value(domain) END || '/' || CASE WHEN any_value(h) % 11 = 0 THEN '' ELSE any_value(domain) END AS book
FROM e LEFT JOIN o USING (question_id) GROUP BY question_id"""))
def question_records(spark: SparkSession, d: str) -> DataFrame:
    """The questions taken apart and put together as whole records; some lack a concept, a wrong option or what templates fill in."""
    rows, text = questions(spark, d), lambda c: F.lit(c).cast("string")
    h = drawn(F.col("question_id"), "record")
    wrong = F.transform(F.filter("options", lambda o: ~o.is_correct), lambda o, i: F.struct(o.text, o.explanation, F.concat(F.lit("c"), i + 1).alias("concept_id"), text(None).alias("concept_label"), F.concat(F.lit("m"), i + 1).alias("misconception_id"), text(None).alias("misconception_label"), text(None).alias("misconception_type")))
    slots = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct(F.least(i, F.lit(2)).alias("distractor_level"), F.when(i == 2, "").otherwise(F.concat(F.lit("s"), i)).alias("misconception_id"), text(None).alias("misconception_label"), text(None).alias("misconception_type")))
    right = F.get(F.filter("options", lambda o: o.is_correct), F.lit(0))
    concept = lambda i, name: F.struct(F.when(h % 3 == i, name).alias("concept_id"), text(None).alias("concept_label"), (F.lit("knows") if i else text(None)).alias("knowledge_tested"))
    parts = rows.select(
        "question_id", F.col("chapter").alias("chapter_title"), F.when(h % 4 == 0, "").otherwise(F.col("domain")).alias("section_title"), F.when(h % 11 > 0, F.col("domain")).alias("anchor_label"), right.letter.alias("target_position"), F.struct(right.text.alias("text"), right.explanation.alias("explanation")).alias("correct"),
        F.slice(wrong, F.lit(1), F.when(h % 7 == 0, 2).otherwise(3)).alias("distractors"), slots.alias("slots"), concept(0, "planned").alias("pre_tested"), concept(1, "written").alias("tested_concept"),
        F.create_map(F.lit("concept"), F.struct(F.when(h % 2 == 0, "own front").otherwise("").alias("front"), F.lit("back").alias("back"))).alias("flashcard_seeds"), assembly.flashcard_fronts(F.lit("it"), F.array(F.lit("a-b"))).alias("flashcard_fronts"),
        F.when(h % 5 > 0, F.array(F.lit("said"), F.lit("twice"))).alias("topic_keywords"), F.array(F.lit("template")).alias("own_keywords"),
    )
    none = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    shown = F.transform("options", lambda o: F.concat_ws(" ", o.letter, o.text, o.explanation, o.concept_id, none(o.distractor_level), none(o.confused_with), none(o.misconception_id)))
    card = F.element_at("flashcard_seeds", F.lit("concept"))
    return assembly.question_record(parts).select("question_id", "error", F.array_join(shown, "|").alias("options"), F.coalesce("tested_concept.concept_id", F.lit("")).alias("concept"), F.col("tested_concept.knowledge_tested").alias("knowledge"), F.concat_ws("/", card.front, card.back).alias("card"), F.array_join("topic_keywords", ",").alias("keywords"), F.concat_ws("/", "book_reference.chapter", "book_reference.section", "book_reference.anchor").alias("book"))
