"""Queries of routed fixes, of judges' answers and of the wide export, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.operators import judges, publish, routing, tells
from quillmill.operators.questions import from_documents
from quillmill.plans.flows import _chapter_questions, _wrong_letters, drawn, sql_drawn
from quillmill.plans.more import _folder
from quillmill.plans.views import SQL_QUESTIONS, questions, spread, sql_list, table
from quillmill.sources import files
from quillmill.sources.stages import released, stored

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = f"WITH {SQL_QUESTIONS.rstrip()}{sql}"
        return f

    return register


# --- fixes by signature

SIGNATURES = ["universal_quantifier", "laterality", "stage_timing", "tier_b_lexical", "numeric_ratio", "imperative_lead"]
PAIRS = [("agonist", "antagonist"), ("between", "within"), ("encoding", "retrieval")]


def _fixed(spark: SparkSession, d: str) -> DataFrame:
    rows = _chapter_questions(spark, d)
    letters = _wrong_letters(rows)
    h = drawn(F.col("question_id"), F.col("letter"), "signature")
    pair = F.element_at(F.array(*(F.array(F.lit(a), F.lit(b)) for a, b in PAIRS)), h % 3 + 1)
    signals = letters.select("question_id", "letter", F.element_at(F.array(*map(F.lit, SIGNATURES)), h % 6 + 1).alias("signature"), (h < 230).alias("fired"), pair.alias("pair"))
    g = drawn(F.col("question_id"), F.col("letter"), "answer")
    text = F.when(g < 40, "  ").when(g < 60, "now all of it").when(g < 80, "now 4:1 of it").otherwise(F.concat(F.lit(" New "), "letter"))
    rewrites = signals.where(F.col("signature").isin("universal_quantifier", "numeric_ratio")).select("question_id", "letter", "signature", text.alias("text"), F.when(g % 2 == 0, "So it is").alias("explanation"))
    flagged = F.filter(F.transform("options", lambda o: o.letter), lambda x: drawn(F.col("question_id"), x, "flag") < 60)
    stem = F.concat(F.when(drawn(F.col("question_id"), "age") < 128, "LEFT and Seen in Childhood, 3:2: ").otherwise(""), "question_stem")
    options = F.transform("options", lambda o: o.withField("explanation", F.concat(o.explanation, F.lit(" Right or adulthood"))).withField("text", F.concat(o.text, F.lit(" antagonist 7:2 Right"))))
    return routing.route_fixes(rows.select("question_id", "chapter", stem.alias("question_stem"), options.alias("options"), flagged.alias("flagged")), signals, rewrites)


_CLEAN = lambda t: rf"regexp_replace({t}, '[\x{{C0}}-\x{{24F}}]', 'x', 'g')"
_HAS = lambda t, w: rf"regexp_matches({_CLEAN(t)}, '(?i)\b{w}\b')"
_SWAP = lambda t, old, new: rf"regexp_replace(regexp_replace({t}, '\b{old[0].upper()}(?i:{old[1:]})\b', '{new[0].upper() + new[1:]}', 'g'), '\b{old[0].lower()}(?i:{old[1:]})\b', '{new}', 'g')"
_UQ = r"'(?i)\b(?:" + "|".join(R.QUANTIFIERS) + r")\b'"


def _sql_flip(pairs: list[tuple[str, str]]) -> str:
    cases = []
    for a, b in pairs:
        for keep, drop, test in ((a, b, f"{_HAS('stem', a)} AND NOT {_HAS('stem', b)}"), (b, a, f"{_HAS('stem', b)} AND NOT {_HAS('stem', a)}")):
            cases.append(f"WHEN {test} THEN CASE WHEN {_HAS('text', drop)} THEN [{_SWAP('text', drop, keep)}, {_SWAP('why', drop, keep)}] END")
    return f"CASE {' '.join(cases)} END"


def _sql_relabel() -> str:
    cases = [f"WHEN h % 3 = {i} THEN CASE WHEN {_HAS('text', a)} AND NOT {_HAS('text', b)} THEN [{_SWAP('text', a, b)}, why] WHEN {_HAS('text', b)} AND NOT {_HAS('text', a)} THEN [{_SWAP('text', b, a)}, why] END" for i, (a, b) in enumerate(PAIRS)]
    return f"CASE {' '.join(cases)} END"


_ROUTED = rf""",
o AS (
  SELECT question_id, doc_id AS chapter, CASE WHEN {sql_drawn("question_id", "'age'")} < 128 THEN 'LEFT and Seen in Childhood, 3:2: ' ELSE '' END || stem AS stem, i, substring('ABCD', i, 1) AS letter, texts[i] || ' antagonist 7:2 Right' AS text, explanations[i] || ' Right or adulthood' AS why, i = pos AS is_correct
  FROM q, range(1, 5) t(i)),
s AS (
  SELECT *, {sql_list(SIGNATURES)}[h % 6 + 1] AS signature, CASE WHEN g < 40 THEN NULL WHEN g < 60 THEN 'now all of it' WHEN g < 80 THEN 'now 4:1 of it' ELSE 'New ' || letter END AS answer, CASE WHEN g % 2 = 0 THEN 'So it is' ELSE why END AS answer_why,
    regexp_split_to_array({_CLEAN('text')}, {_UQ})[1] AS head, regexp_extract({_CLEAN('text')}, {_UQ}) AS uq
  FROM (SELECT *, {sql_drawn("question_id", "letter", "'signature'")} AS h, {sql_drawn("question_id", "letter", "'answer'")} AS g FROM o)),
n AS (
  SELECT *, regexp_replace(trim(left(text, length(head)) || substr(text, length(head) + length(uq) + 1)), '\s+', ' ', 'g') AS short FROM s),
f AS (
  SELECT *, CASE WHEN is_correct OR h >= 230 THEN NULL
    WHEN signature = 'universal_quantifier' THEN CASE WHEN uq <> '' THEN CASE WHEN len(string_split(short, ' ')) >= 10 THEN [short, why] WHEN NOT regexp_matches(answer, {_UQ}) THEN [answer, answer_why] END END
    WHEN signature = 'laterality' THEN {_sql_flip(R.LATERAL_PAIRS)} WHEN signature = 'stage_timing' THEN {_sql_flip(R.STAGE_PAIRS)} WHEN signature = 'tier_b_lexical' THEN {_sql_relabel()}
    WHEN signature = 'numeric_ratio' THEN CASE WHEN regexp_matches(stem, '\b\d+:\d+\b') AND regexp_matches(text, '\b\d+:\d+\b') AND NOT regexp_matches(answer, {_UQ}) AND NOT regexp_matches(answer, '\b\d+:\d+\b') THEN [answer, answer_why] END END AS new FROM n),
w AS (
  SELECT question_id, any_value(chapter) AS chapter, string_agg(coalesce(new[1], text), '|' ORDER BY i) AS texts, string_agg(coalesce(new[2], why), '|' ORDER BY i) AS explanations, count(*) FILTER (NOT is_correct AND h < 230 AND signature <> 'imperative_lead') AS attempted,
    list_sort(list(signature) FILTER (new IS NOT NULL AND (new[1] <> text OR new[2] <> why))) AS changed, count(*) FILTER ({sql_drawn("question_id", "letter", "'flag'")} < 60) AS flagged FROM f GROUP BY question_id)"""


@query(f"{_ROUTED} SELECT question_id, texts, explanations, attempted::INTEGER AS attempted, coalesce(array_to_string(changed, ','), '') AS changed, flagged > 0 AND coalesce(len(changed), 0) = 0 AS residual FROM w")
def dispatched_fixes(spark: SparkSession, d: str) -> DataFrame:
    joined = lambda field: F.array_join(F.transform("options", lambda o: o[field]), "|").alias(f"{field}s")
    by = {v: k for k, v in routing.FIXERS.items()} | {"schema_labeling_fixer": "tier_b_lexical"}
    names = F.create_map(*(F.lit(x) for pair in by.items() for x in pair))
    changed = F.array_join(F.array_sort(F.flatten(F.transform(F.map_entries("by_fixer"), lambda e: F.array_repeat(F.element_at(names, e.key), e.value)))), ",")
    return _fixed(spark, d).select("question_id", joined("text"), joined("explanation"), "attempted", changed.alias("changed"), "residual")


@query(f"{_ROUTED} SELECT chapter, sum(attempted)::BIGINT AS attempted, count(*) FILTER (len(changed) > 0) AS applied, count(*) FILTER (flagged > 0 AND coalesce(len(changed), 0) = 0) AS residual, round(count(*) FILTER (len(changed) > 0) * 0.005, 3) AS cost, "
       + ", ".join(f"sum(len(list_filter(coalesce(changed, []), lambda c: c = '{s}')))::BIGINT AS {f}" for s, f in sorted(routing.FIXERS.items(), key=lambda x: x[1]) if s != "tier_a_brief") + " FROM w GROUP BY chapter")
def dispatch_summary(spark: SparkSession, d: str) -> DataFrame:
    return routing.routed_chapters(_fixed(spark, d))


# --- judges


def _findings(spark: SparkSession, d: str, detector: str) -> DataFrame:
    rows = _chapter_questions(spark, d)
    name, fields, _ = judges.DETECTORS[detector]
    h = drawn(F.col("question_id"), detector)
    one = lambda letter: F.concat(F.lit('{"letter": "'), letter, F.lit('"'), *(x for f in fields for x in (F.lit(f', "{f}": "'), F.lit(f"{f} of "), F.col("question_id"), F.lit(" "), letter, F.lit('"'))), F.lit("}"))
    wrong = F.transform(F.filter("options", lambda o: ~o.is_correct), lambda o: o.letter)
    listed = F.array_join(F.transform(F.filter(wrong, lambda x: drawn(F.col("question_id"), x, detector) < 90), one), ", ")
    content = F.when(h < 20, "no json").when(h < 30, "[1]").otherwise(F.concat(F.lit(f'```json\n{{"{name}": ['), listed, F.lit("]}\n```")))
    answers = rows.where(h < 240).select("question_id", content.alias("content"), F.when((h >= 30) & (h < 45), "TimeoutError: late").alias("error"))
    told = judges.answered_signals(rows, answers, detector)
    return told.select("question_id", "detector_id", "letter", "fired", "confidence", "reason", F.array_join(F.transform(F.map_entries("extra"), lambda e: F.concat_ws("=", e.key, e.value)), ";").alias("extra"))


def _sql_findings(detector: str) -> str:
    fields, confidence = judges.DETECTORS[detector][1:]
    said = lambda f: f"'{f} of ' || question_id || ' ' || letter"
    reason = f"left({said('argument')}, 200)" if detector == "llm_ambiguity" else f"'factual error: ''' || left({said('claim')}, 80) || ''' — correction: ' || left({said('correction')}, 80)"
    extra = " || ';' || ".join(f"'{f}=' || {said(f)}" for f in fields)
    return f""",
a AS (SELECT question_id, {sql_drawn("question_id", f"'{detector}'")} AS h, list_filter(wrong_letters, lambda l: {sql_drawn("question_id", "l", f"'{detector}'")} < 90) AS hits FROM q)
SELECT question_id, '{detector}' AS detector_id, letter, TRUE AS fired, {confidence}::DOUBLE AS confidence, {reason} AS reason, {extra} AS extra FROM (SELECT question_id, unnest(hits) AS letter FROM a WHERE h >= 45 AND h < 240)
UNION ALL SELECT question_id, '{detector}', NULL, FALSE, CASE WHEN h >= 45 AND h < 240 THEN 1.0 ELSE 0.0 END, '{detector}: ' || CASE WHEN h >= 240 THEN 'no client' WHEN h < 30 THEN 'parse_failed' WHEN h < 45 THEN 'api_error: TimeoutError: late' ELSE '{judges.NOTHING[detector]}' END, NULL FROM a WHERE h < 45 OR h >= 240 OR len(hits) = 0"""


@query(_sql_findings("llm_ambiguity"))
def llm_ambiguity(spark: SparkSession, d: str) -> DataFrame:
    return _findings(spark, d, "llm_ambiguity")


@query(_sql_findings("llm_fact_check"))
def llm_fact_check(spark: SparkSession, d: str) -> DataFrame:
    return _findings(spark, d, "llm_fact_check")


@query(f""",
a AS (SELECT *, {sql_drawn("question_id", "'elim'")} AS h, list_filter(['A', 'B', 'C', 'D'], lambda l: l <> substring('ABCD', pos, 1) AND {sql_drawn("question_id", "l", "'elim'")} < 50) AS gaps FROM q),
b AS (SELECT *, CASE WHEN h % 4 = 0 OR h < 30 OR h >= 240 THEN [] ELSE gaps END AS hits FROM a)
SELECT question_id, array_to_string(hits, ',') AS eliminable, len(hits) = 0 AS ok, CASE WHEN len(hits) > 0 THEN '[strategy=judgment_error] ' || array_to_string(list_transform(hits, lambda l: 'distractor ' || l || ': contradicted by ''fact ' || l || '''. ' || CASE WHEN h % 2 = 0 THEN 'why' ELSE '' END), ' | ') WHEN h % 4 = 0 THEN 'policy=skip:defined' END AS reason FROM b""")
def gate_stem_eliminable(spark: SparkSession, d: str) -> DataFrame:
    rows = _chapter_questions(spark, d)
    h = drawn(F.col("question_id"), "elim")
    asked = rows.withColumns({"gate_action": F.when(h % 4 == 0, "skip").otherwise("strict"), "correction_strategy": F.lit("judgment_error"), "note": F.lit("defined")})
    wrong = F.transform(F.filter("options", lambda o: ~o.is_correct), lambda o: o.letter)
    gap = lambda x: drawn(F.col("question_id"), x, "elim") < 50
    fact = lambda x: F.concat(F.lit(', "contradicted_stem_fact": "fact '), x, F.when(h % 2 == 0, '", "explanation": "why"}').otherwise('"}'))
    classes = F.array_join(F.transform(wrong, lambda x: F.concat(F.lit('{"letter": "'), x, F.lit('", "class": "'), F.when(gap(x), "english_gap").otherwise("clean"), F.lit('"'), fact(x))), ", ")
    older = F.array_join(F.transform(F.filter(wrong, gap), lambda x: F.concat(F.lit('{"letter": "'), x, F.lit('"'), fact(x))), ", ")
    content = F.when(h < 20, "no json").when(h % 3 == 0, F.concat(F.lit('{"flagged_distractors": ['), older, F.lit("]}"))).otherwise(F.concat(F.lit('{"classifications": ['), classes, F.lit("]}")))
    answers = rows.where(h < 240).select("question_id", content.alias("content"), F.when((h >= 20) & (h < 30), "late").alias("error"))
    return judges.eliminable(asked, answers).select("question_id", F.array_join("eliminable", ",").alias("eliminable"), "ok", "reason")


# --- export


_DOMAINS = {"en": 3, "de": 5}
#: Parts of the documents whose questions are appended one after another.
EXPORT_PARTS = 3


@query(f""",
r AS (SELECT *, [lower(w) for w in string_split(correct, ' ')] AS cw, {sql_drawn("question_id", "'old'")} < 100 AS old, {sql_drawn("question_id", "'uid'")} AS u FROM q),
a AS (SELECT doc_id AS uid, source AS chapter_num, lang || ', "' || source || '"' AS fact FROM documents WHERE doc_id % 3 > 0)
SELECT question_id, 'single_choice' AS question_type, CASE WHEN old THEN 'old' ELSE domain END AS domain_code, CASE domain WHEN 'en' THEN '3' WHEN 'de' THEN '5' ELSE '' END AS domain_id, '' AS domain_name,
  CASE WHEN u < 200 THEN coalesce(a.chapter_num, '') ELSE '' END AS chapter_num, '' AS chapter_title, '' AS chapter_file, '' AS section_title, '' AS chapter_uuid, '' AS anchor_uuid, chapter AS anchor_label,
  difficulty_tier::VARCHAR AS difficulty_tier, '' AS difficulty_label, '' AS blooms_primary, '' AS blooms_secondary, '' AS stem_pattern, '' AS source_type, '' AS variant, stem AS question_stem,
  texts[1] AS option_a, texts[2] AS option_b, texts[3] AS option_c, texts[4] AS option_d, substring('ABCD', pos, 1) AS correct_answer, explanations[1] AS explanation_a, explanations[2] AS explanation_b, explanations[3] AS explanation_c, explanations[4] AS explanation_d,
  cw[1] AS tested_concept_id, '' AS tested_concept_label, 'knows, "' || cw[2] || '"' AS knowledge_tested, CASE WHEN u < 200 THEN doc_id::VARCHAR ELSE '' END AS anchor_uid, '' AS anchor_point_id_v2, CASE WHEN u < 200 THEN cw[3] ELSE '' END AS anchor_content_summary,
  'front' AS flashcard_concept_front, 'back ' || pos AS flashcard_concept_back, '' AS flashcard_comparison_front, '' AS flashcard_comparison_back, 'n' AS flashcard_nuance_front, '' AS flashcard_nuance_back,
  wrong_letters[1] AS distractor_1_letter, '1' AS distractor_1_level, 'similar_name' AS distractor_1_misconception_type, wrong_letters[2] AS distractor_2_letter, '2' AS distractor_2_level, 'similar_name' AS distractor_2_misconception_type,
  wrong_letters[3] AS distractor_3_letter, '3' AS distractor_3_level, 'similar_name' AS distractor_3_misconception_type, 'c' || wrong_letters[1] AS distractor_1_concept_id, 'm' || wrong_letters[1] AS distractor_1_misconception_id, '' AS distractor_1_confused_with,
  'c' || wrong_letters[2] AS distractor_2_concept_id, 'm' || wrong_letters[2] AS distractor_2_misconception_id, '' AS distractor_2_confused_with, 'c' || wrong_letters[3] AS distractor_3_concept_id, 'm' || wrong_letters[3] AS distractor_3_misconception_id, '' AS distractor_3_confused_with,
  '' AS generation_batch, 'quill' AS generated_by, CASE WHEN u < 200 THEN coalesce(a.fact, '') ELSE '' END AS testable_fact
FROM r LEFT JOIN a ON a.uid = r.doc_id""")
def export_rows(spark: SparkSession, d: str) -> DataFrame:
    """All questions written as CSV, in two runs: the second one appends what the first one has not.  It does so by
    parts of the documents, as the shuffle files of a part can go before the next one begins."""
    anchors = table(spark, d, "documents").where("doc_id % 3 > 0").select(F.col("doc_id").cast("string").alias("uid"), F.col("source").alias("chapter_num"), F.concat("lang", F.lit(', "'), "source", F.lit('"')).alias("testable_fact"))
    path, schema = f"{_folder(spark)}/export", ", ".join(f"{c} string" for c in publish.EXPORT_COLUMNS)
    read = lambda: spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"').na.fill("")
    records = _export_records(questions(spark, d))
    first = publish.wide_export(records.where(drawn(F.col("question_id"), "old") < 100), anchors, _DOMAINS).withColumn("domain_code", F.lit("old"))  # to be seen not to change
    files.write_csv(first, path, publish.EXPORT_COLUMNS, compression="gzip")
    there = stored(read().select("question_id"))
    documents = table(spark, d, "documents").select("doc_id", "lang", "source", "text")
    for part in range(EXPORT_PARTS):
        own = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(EXPORT_PARTS)) == part)
        files.write_csv(publish.wide_export(_export_records(from_documents(spread(own))), anchors, _DOMAINS, there), path, publish.EXPORT_COLUMNS, mode="append", compression="gzip")
        released(spark)
    return read()


def _export_records(rows: DataFrame) -> DataFrame:
    right = F.get(F.filter("options", lambda o: o.is_correct), F.lit(0))
    words = F.transform(F.split(right.text, " "), F.lower)
    wrong = F.filter("options", lambda o: ~o.is_correct)
    level = lambda o: F.array_position(F.transform(wrong, lambda w: w.letter), o.letter)
    only = lambda o, c: F.when(~o.is_correct, c)
    options = F.transform("options", lambda o: F.struct(o.letter, o.text, o.is_correct, o.explanation, only(o, level(o)).alias("distractor_level"), only(o, F.lit("similar_name")).alias("misconception_type"), F.concat(F.lit("c"), o.letter).alias("concept_id"), only(o, F.concat(F.lit("m"), o.letter)).alias("misconception_id"), F.lit(None).cast("string").alias("confused_with")))
    card = lambda f, b: F.struct(f.alias("front"), b.alias("back"))
    has = drawn(F.col("question_id"), "uid") < 200
    return rows.select(
        "question_id", F.col("domain").alias("domain_code"), F.col("chapter").alias("anchor_label"), "difficulty_tier", "question_stem", F.lit("quill").alias("generated_by"), right.letter.alias("correct_answer_letter"), options.alias("options"),
        F.struct(words[0].alias("concept_id"), F.lit(None).cast("string").alias("concept_label"), F.concat(F.lit('knows, "'), words[1], F.lit('"')).alias("knowledge_tested")).alias("tested_concept"),
        F.when(has, F.array(F.col("doc_id").cast("string"), F.lit("other"))).alias("anchor_uids"), F.when(has, F.slice(words, 3, 1)).otherwise(F.array().cast("array<string>")).alias("anchor_content_summaries"),
        F.create_map(F.lit("concept"), card(F.lit("front"), F.concat(F.lit("back "), F.array_position(F.transform("options", lambda o: o.letter), right.letter).cast("string"))), F.lit("nuance"), card(F.lit("n"), F.lit(None).cast("string"))).alias("flashcard_seeds"),
    )


# --- tells


@query("""
SELECT count(*) AS n, round(avg(r), 6) AS mean_ratio, round(median(r), 6) AS median_ratio, round(max(r), 6) AS max_ratio, count(*) FILTER (r > 1.3) AS over_1_3, count(*) FILTER (r > 1.5) AS over_1_5, count(*) FILTER (r > 1.8) AS over_1_8, count(*) FILTER (r > 2.0) AS over_2_0,
  count(*) FILTER (length(correct) = longest) AS correct_longest, count(*) FILTER (length(correct) > other * 1.2) AS correct_much_longer, round(avg(length(correct) / mean), 6) AS mean_to_distractors
FROM (SELECT *, list_max(list_transform(texts, lambda t: length(t))) AS longest, list_max(list_transform(wrong, lambda t: length(t))) AS other, list_avg(list_transform(wrong, lambda t: length(t))) AS mean, list_max(list_transform(texts, lambda t: length(t))) / list_min(list_transform(texts, lambda t: length(t)))::DOUBLE AS r FROM q)""")
def length_tells(spark: SparkSession, d: str) -> DataFrame:
    told = tells.length_summary(tells.length_ratios(questions(spark, d)))
    return told.select(*(F.round(c, 6).alias(c) if dict(told.dtypes)[c] == "double" else c for c in told.columns))


_MARKED = ["", " (so it is)", "; and more", " — that", " -- or this", " e.g. one", " (one); (two)", " i.e. this"]
_COUNT = lambda t, p: f"len(regexp_extract_all({t}, '{p}'))"
_MARKS_SQL = f""",
u AS (SELECT *, list_transform([1, 2, 3, 4], lambda i: texts[i] || {sql_list(_MARKED)}[CASE WHEN {sql_drawn("question_id", "substring('ABCD', i, 1)", "'many'")} < 150 THEN 0 ELSE {sql_drawn("question_id", "substring('ABCD', i, 1)", "'mark'")} % 8 END + 1]) AS t FROM q),
c AS (SELECT *, list_transform(t, lambda x: [{", ".join(_COUNT(_CLEAN("x"), p) for p in R.ELABORATION.values())}]) AS m FROM u),
k AS (SELECT question_id, list_sum(m[pos]) AS total, list_transform(list_filter(m, lambda x, i: i <> pos), lambda x: list_sum(x)) AS rest, m[pos] AS own, list_filter(m, lambda x, i: i <> pos) AS others FROM c),
w AS (SELECT question_id, total::INTEGER AS total, list_max(rest)::INTEGER AS most, round(list_avg(rest), 6) AS mean, total > list_max(rest) AS over_most, total > list_avg(rest) AS over_mean,
  list_filter([1, 2, 3], lambda i: own[i] >= 1 AND list_max(list_transform(others, lambda x: x[i])) = 0) AS alone, total >= 2 AND list_max(rest) = 0 AS strict FROM k)"""


def _marked(spark: SparkSession, d: str) -> DataFrame:
    end = lambda o: F.element_at(F.array(*map(F.lit, _MARKED)), F.when(drawn(F.col("question_id"), o.letter, "many") < 150, 0).otherwise(drawn(F.col("question_id"), o.letter, "mark") % 8) + 1)
    return tells.marked_options(questions(spark, d).withColumn("options", F.transform("options", lambda o: o.withField("text", F.concat(o.text, end(o))))))


@query(f"{_MARKS_SQL} SELECT question_id, total, most, mean, over_most, over_mean, array_to_string(list_transform(alone, lambda i: {sql_list(list(R.ELABORATION)[:3])}[i]), ',') AS alone, strict FROM w")
def marked_options(spark: SparkSession, d: str) -> DataFrame:
    return _marked(spark, d).withColumn("alone", F.array_join("only", ",")).drop("only").withColumn("mean", F.round("mean", 6))


@query(f"{_MARKS_SQL} SELECT count(*) AS n, count(*) FILTER (over_most) AS over_most, count(*) FILTER (over_mean) AS over_mean, count(*) FILTER (list_contains(alone, 1)) AS parens_only_correct, count(*) FILTER (list_contains(alone, 2)) AS semicolons_only_correct, count(*) FILTER (list_contains(alone, 3)) AS dashes_only_correct, count(*) FILTER (strict) AS strict FROM w")
def marks_summary(spark: SparkSession, d: str) -> DataFrame:
    return tells.marks_summary(_marked(spark, d))
