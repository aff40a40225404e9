"""Queries over questions: gates, detectors, audits, fixers, verdicts, exports."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.functions import text as T
from quillmill.operators import audits, detectors, fixers, gates, planning, publish, verdicts
from quillmill.operators.questions import correct, distractors
from quillmill.plans.views import SQL_QUESTIONS, questions, sql_jaccard, sql_list, sql_set, sql_tokens, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = f"WITH {SQL_QUESTIONS.rstrip()} {sql}"
        return f

    return register


def _gate(spark: SparkSession, d: str, gate) -> DataFrame:
    return questions(spark, d).select("question_id", gate.alias("g")).select("question_id", F.col("g.ok").alias("ok"), F.round("g.metric", 6).alias("metric"))


def _pattern(p: str) -> str:
    """A pattern as SQL text; word boundaries are written out, as the oracle's know ASCII only."""
    p = re.sub(r"\\b(?=\||$)", r"(?:[^\\p{L}\\p{N}_]|$)", p)
    p = re.sub(r"\\b", r"(?:^|[^\\p{L}\\p{N}_])", p)
    return "'" + p.replace("'", "''") + "'"


def _sum(xs: str) -> str:
    return f"coalesce(list_sum({xs}), 0)"


@query("SELECT question_id, doc_id % 5 > 0 AND doc_id % 7 > 0 AND doc_id % 11 > 0 AS ok, CASE WHEN doc_id % 11 = 0 THEN CASE WHEN doc_id % 7 = 0 THEN 3.0 ELSE 4.0 END WHEN doc_id % 7 = 0 AND pos = 4 THEN 0.0 ELSE 1.0 END::DOUBLE AS metric FROM q")
def gate_structure(spark, d):
    """On questions of which some lack their stem or an option, or have nothing but correct ones."""
    options = F.transform("options", lambda o: o.withField("is_correct", o.is_correct | (F.col("doc_id") % 11 == 0)))
    rows = questions(spark, d).withColumn("question_stem", F.when(F.col("doc_id") % 5 > 0, F.col("question_stem"))).withColumn("options", F.slice(options, 1, F.when(F.col("doc_id") % 7 == 0, 3).otherwise(4)))
    return rows.select("question_id", gates.structure().alias("g")).select("question_id", "g.ok", "g.metric")


_RATIO = "(list_max(list_transform(texts, lambda t: length(t))) / nullif(list_min(list_transform(texts, lambda t: length(t))), 0)::DOUBLE)"
_LONGER = "(length(correct) / nullif(list_max(list_transform(wrong, lambda t: length(t))), 0)::DOUBLE)"


@query(f"SELECT question_id, NOT (list_min(list_transform(texts, lambda t: length(t))) > 0 AND ({_RATIO} > 1.7 OR {_LONGER} > 1.2)) AS ok, round({_RATIO}, 6) AS metric FROM q")
def gate_length_balance(spark, d):
    return _gate(spark, d, gates.length_balance())


# The brief's concepts of a question: named by the first two words of its options.
_BRIEF = "list_transform(texts, lambda t: lower(array_to_string(string_split(t, ' ')[1:2], '-')))"
_NAMED = lambda ids, text: f"len(list_filter({ids}, lambda c: len(list_filter(string_split(c, '-'), lambda t: length(t) >= 4 AND contains({text}, t))) > 0))"


def _brief() -> Column:
    return F.transform("options", lambda o: F.lower(F.array_join(F.slice(F.split(o.text, " "), 1, 2), "-")))


@query(rf"""SELECT question_id, NOT ((difficulty_tier = 3 AND a = 0) OR (difficulty_tier = 4 AND n < 2)) AS ok, CASE difficulty_tier WHEN 4 THEN n ELSE a END::DOUBLE AS metric
  FROM (SELECT *, len(list_intersect(list_distinct(regexp_split_to_array(lower(correct), '[^\p{{L}}\p{{N}}_]+')), {sql_list(R.APPLY_INDICATORS)})) + contains(lower(correct), 'rather than')::INTEGER AS a,
    {_NAMED(f"list_distinct({_BRIEF})", "lower(concat_ws(' ', stem, correct, explanations[pos]))")} AS n FROM q)""")
def gate_blooms(spark, d):
    return _gate(spark, d, gates.apply_level(_brief()))


_HITS = lambda t: f"len(list_filter(labels, lambda s: len(list_filter(s, lambda w: contains(lower({t}), w))) > 0))"


@query(f"""SELECT question_id, NOT (own >= 2 AND short > 0) AS ok, short::DOUBLE AS metric FROM (
  SELECT question_id, own, len(list_filter(wrong, lambda t: {_HITS("t")} < CASE WHEN own <= 2 THEN own ELSE own - 1 END)) AS short FROM (
  SELECT *, {_HITS("correct")} AS own FROM (SELECT *, list_transform(texts, lambda x: {sql_tokens("array_to_string(string_split(lower(x), ' ')[4:7], ' ') || ' ' || array_to_string(string_split(lower(texts[1]), ' ')[1:2], ' ')", 4)}) AS labels FROM q)))""")
def gate_scope_match(spark, d):
    """Labels: words of an option and the first two of option A, so that some are shared."""
    words = lambda t, a, n: F.array_join(F.slice(F.split(F.lower(t), " "), a, n), " ")
    labels = F.map_from_entries(F.transform("options", lambda o: F.struct(o.letter, F.concat_ws(" ", words(o.text, 4, 4), words(F.get("options", F.lit(0)).text, 1, 2)))))
    return _gate(spark, d, gates.scope_match(F.lit("comparison"), labels))


@query("SELECT question_id, NOT list_contains(string_split(correct, ' '), string_split(stem, ' ')[1]) IS FALSE AS ok, NULL::DOUBLE AS metric FROM q")
def gate_anchor_grounding(spark, d):
    """The tested concept: a question's first word; the brief's: the answer's words."""
    return _gate(spark, d, gates.anchor_grounding(F.get(F.split("question_stem", " "), F.lit(0)), F.split(correct(), " ")))


@query("SELECT question_id, NOT (a OR b OR c) AS ok, (a::INTEGER + b::INTEGER + 2 * c::INTEGER)::DOUBLE AS metric FROM (SELECT question_id, doc_id % 3 = 0 AS a, doc_id % 5 = 0 AS b, doc_id % 7 = 0 AS c FROM q)")
def gate_attribution(spark, d):
    """Citations written into whole stems and explanations: a strange one, one on the list, two kinds at once."""
    cited = F.concat(F.when(F.col("doc_id") % 3 == 0, "Squire (2004) found it. ").otherwise("Piaget (1936) found it. "), F.col("question_stem"), F.when(F.col("doc_id") % 5 == 0, ". Per Smith it did.").otherwise(""))
    told = F.transform("options", lambda o: o.withField("explanation", F.concat(o.explanation, F.when((o.letter == "C") & (F.col("doc_id") % 7 == 0), ", so Weber's theory held, and Jones et al. agreed").otherwise(""))))
    rows = questions(spark, d).withColumn("question_stem", cited).withColumn("options", told)
    return rows.select("question_id", gates.attribution(["Piaget"]).alias("g")).select("question_id", "g.ok", "g.metric")


@query(f"SELECT question_id, NOT (difficulty_tier = 1 AND (s OR v)) AS ok, (s::INTEGER + v::INTEGER)::DOUBLE AS metric FROM (SELECT *, regexp_matches(stem, {_pattern(R.SCENARIO_CASED)}) OR regexp_matches(stem, {_pattern(R.REMEMBER_SCENARIO)}) AS s, list_contains({sql_list(R.FORWARD_VERBS)}, regexp_extract(lower(trim(correct)), '^([a-z]+)', 1)) AS v FROM q)")
def gate_remember(spark, d):
    return _gate(spark, d, gates.remember_identity())


@query(rf"SELECT question_id, NOT (difficulty_tier = 2 AND (length(stem) > 280 OR m > 40 OR regexp_matches(stem, {_pattern(R.EVALUATIVE)}))) AS ok, m::DOUBLE AS metric FROM (SELECT *, len(regexp_split_to_array(trim(stem), '\s+')) AS m FROM q)")
def gate_understand(spark, d):
    return _gate(spark, d, gates.understand_identity())


@query()
def gate_apply(spark, d):
    return _gate(spark, d, gates.apply_identity())


@query(f"SELECT question_id, NOT (difficulty_tier = 4 AND NOT (m >= 2 OR regexp_matches(stem, {_pattern(R.CONJUNCTIVE)}) OR regexp_matches(stem, {_pattern(R.COMPETING)}))) AS ok, m::DOUBLE AS metric FROM (SELECT *, length(stem) - length(translate(stem, '.?!', '')) AS m FROM q)")
def gate_evaluate(spark, d):
    return _gate(spark, d, gates.evaluate_identity())


TERMS = ["tion", "ment", "heit", "ción", "ing"]


@query(f"SELECT question_id, NOT (difficulty_tier >= 3 AND m < 2) AS ok, m::DOUBLE AS metric FROM (SELECT *, len(list_filter({sql_list(TERMS)}, lambda t: contains(lower(correct || ' ' || explanations[pos]), t))) AS m FROM q)")
def gate_domain_expertise(spark, d):
    return _gate(spark, d, gates.domain_expertise(T.words_array(TERMS)))


@query(f"SELECT question_id, m = 0 AS ok, m::DOUBLE AS metric FROM (SELECT *, len(list_filter(texts, lambda t: regexp_matches(t, {_pattern(R.REASONING)}))) AS m FROM q)")
def gate_option_claim(spark, d):
    return _gate(spark, d, gates.option_claim())


_NG = lambda w: f"CASE WHEN len({w}) >= 5 THEN list_distinct(list_transform(range(1, len({w}) - 3), lambda k: array_to_string({w}[k:k + 4], ' '))) ELSE [] END"


@query(f"SELECT question_id, coalesce(m, 0.0) < 0.5 AS ok, round(m, 6) AS metric FROM (SELECT question_id, len(list_intersect(a, b)) / nullif(len(a), 0)::DOUBLE AS m FROM (SELECT question_id, {_NG('s')} AS a, {_NG('p')} AS b FROM (SELECT question_id, {sql_tokens("concat(stem, ' ', array_to_string(list_reverse(string_split(correct, ' ')), ' '))", 1, R.LIGHT_STOP)} AS s, {sql_tokens("concat(stem, ' ', array_to_string(list_transform([1, 2, 3, 4], lambda i: texts[i] || ' ' || explanations[i]), ' '))", 1, R.LIGHT_STOP)} AS p FROM q)))")
def gate_originality(spark, d):
    """The source: the stem, which the question repeats, and the answer backwards, which it doesn't."""
    return _gate(spark, d, gates.originality(F.concat_ws(" ", "question_stem", F.array_join(F.reverse(F.split(correct(), " ")), " "))))


_TR = f"""(SELECT *, {sql_set('stem', 4, R.FULL_STOP)} AS realm, {sql_set('correct', 4, R.FULL_STOP)} AS own, list_filter(list_transform(wrong, lambda t: {sql_set('t', 4, R.FULL_STOP)}), lambda s: len(s) >= 5) AS valid FROM q),
tr AS (SELECT *, list_avg(list_transform(valid, lambda s: len(list_intersect(s, realm)) / len(s)::DOUBLE)) AS mean FROM t0),
tg AS (SELECT *, CASE WHEN len(realm) >= 3 AND len(own) >= 5 AND len(valid) >= 3 AND NOT regexp_matches(stem, {_pattern(R.EXCEPT_GATE)}) THEN len(list_intersect(own, realm)) / len(own)::DOUBLE - mean END AS gap FROM tr)"""


@query(f", t0 AS {_TR} SELECT question_id, NOT coalesce(mean < 0.5 AND gap >= [0.5, 0.4, 0.3, 0.25][difficulty_tier], false) AS ok, round(gap, 6) AS metric FROM tg")
def gate_topic_realm(spark, d):
    return _gate(spark, d, gates.topic_realm())


@query(f"SELECT question_id, NOT (len(k) >= [3, 3, 2, 2][difficulty_tier] AND NOT regexp_matches(stem, {_pattern(R.EXCEPT_GATE)})) AS ok, len(k)::DOUBLE AS metric FROM (SELECT *, list_filter({sql_set('stem', 5, R.FULL_STOP)}, lambda w: length(w) >= [5, 5, 7, 7][difficulty_tier] AND contains(lower(correct), w) AND NOT contains(lower(array_to_string(wrong, '|')), w) AND (difficulty_tier < 3 OR NOT list_contains({sql_list(R.GENERIC_WORDS)}, w))) AS k FROM q)")
def gate_stem_keywords(spark, d):
    return _gate(spark, d, gates.stem_keywords())


@query(f"SELECT question_id, NOT (len(k) >= [5, 4, 3, 3][difficulty_tier] AND NOT regexp_matches(stem, {_pattern(R.EXCEPT_GATE)})) AS ok, len(k)::DOUBLE AS metric FROM (SELECT *, list_filter({sql_set('correct', 5, R.FULL_STOP)}, lambda w: length(w) >= [5, 5, 7, 7][difficulty_tier] AND NOT contains(lower(array_to_string(wrong, '|')), w)) AS k FROM q)")
def gate_keywords(spark, d):
    return _gate(spark, d, gates.answer_keywords())


@query(r"SELECT question_id, NOT ((b AND NOT u AND ou) OR (u AND NOT b AND ob)) AS ok, NULL::DOUBLE AS metric FROM (SELECT *, regexp_matches(stem, '(?i)\bbilateral(?:ly)?\b') AS b, regexp_matches(stem, '(?i)\bunilateral(?:ly)?\b') AS u, len(list_filter(wrong, lambda t: regexp_matches(t, '(?i)\bunilateral(?:ly)?\b'))) > 0 AS ou, len(list_filter(wrong, lambda t: regexp_matches(t, '(?i)\bbilateral(?:ly)?\b'))) > 0 AS ob FROM q)")
def gate_laterality(spark, d):
    return _gate(spark, d, gates.laterality())


@query()
def gate_universal_denial(spark, d):
    return _gate(spark, d, gates.universal_denial())


@query()
def gate_pipeline(spark, d):
    return gates.run_gates(questions(spark, d)).select("question_id", F.size("failures").cast("long").alias("n_failures"), F.array_join(F.transform("failures", lambda f: f.gate), ",").alias("gates"))


@query("SELECT question_id, doc_id NOT IN (SELECT doc_id FROM labels) AS ok FROM q")
def gate_uniqueness(spark, d):
    """Already there: the questions of labelled documents."""
    own = questions(spark, d)
    return gates.uniqueness(own.select("question_id"), own.join(table(spark, d, "labels"), "doc_id", "left_semi").select("question_id")).select("question_id", "ok")


# --- detectors


@query()
def detector_signals(spark, d):
    found = detectors.scan(questions(spark, d))
    return found.groupBy("detector_id", "verdict_action").agg(F.count("*").alias("rows"), F.count_if("fired").alias("fired"), F.round(F.max("confidence"), 2).alias("confidence"))


@query(f"SELECT question_id, regexp_matches(stem, {_pattern(R.META_TOKENS)}) AS fired FROM q")
def detector_meta_evaluative(spark, d):
    return questions(spark, d).select("question_id", F.get(detectors.meta_evaluative(), F.lit(0)).fired.alias("fired"))


@query(f"SELECT question_id, unnest(wrong_letters) AS letter, regexp_matches(unnest(wrong), {_pattern(R.IMPERATIVE_LEAD)}) AS fired FROM q")
def detector_imperative_lead(spark, d):
    return questions(spark, d).select("question_id", F.explode(detectors.imperative_lead()).alias("s")).select("question_id", "s.letter", "s.fired")


_SHAPE = r"""CASE WHEN trim(t) = '' THEN 'EMPTY' WHEN regexp_matches(trim(t), '(?i)^(the|a|an)\s+') THEN 'DEF_ART_NP' WHEN regexp_matches(trim(t), '^(?i:when|if)(?:[^\p{L}\p{N}_]|$)') THEN 'WHEN_IF'
WHEN regexp_matches(regexp_extract(trim(t), '^(\S+)', 1), '(?i)^[a-z]+ing$') THEN 'VERB_ING' WHEN regexp_matches(regexp_extract(trim(t), '^(\S+)', 1), '(?i)^[a-z]+ed$') THEN 'VERB_PAST' WHEN regexp_matches(trim(t), '^[A-Z][a-z]+\s+[A-Z]') THEN 'PROPER_NP' ELSE 'NP' END"""


@query(f"SELECT question_id, array_to_string(list_sort(list_distinct(list_transform(texts, lambda t: {_SHAPE}))), ',') AS shapes FROM q")
def detector_lead_forms(spark, d):
    return questions(spark, d).select("question_id", F.array_join(F.array_sort(F.array_distinct(F.transform("options", lambda o: T.lead_shape(o.text)))), ",").alias("shapes"))


@query()
def detector_defensible_alternative(spark, d):
    return questions(spark, d).select("question_id", F.get(detectors.defensible_alternative(), F.lit(0)).alias("s")).select("question_id", "s.fired", "s.reason")


@query()
def detector_label_pairs(spark, d):
    """The pair classifier on texts made of its own labels, as documents never hold them."""
    words = table(spark, d, "documents").select("doc_id", F.element_at(F.array(*(F.lit(f"the {a} and the {b} here") for a, b in R.LABEL_PAIRS)), (F.col("doc_id") % len(R.LABEL_PAIRS) + 1).cast("int")).alias("stem"), F.element_at(F.array(*(F.lit(f"all {a}") for a, _ in R.LABEL_PAIRS)), (F.col("doc_id") % 11 + 1).cast("int")).alias("t"))
    s = detectors.label_pair(F.col("stem"), F.col("t"))
    return words.select("doc_id", s.pair.alias("pair"), s.blocked.alias("blocked"))


@query("SELECT question_id, letter, CASE WHEN tier <= 2 THEN 'override_to' ELSE 'advisory' END AS action, CASE WHEN a <> b THEN 'numeric_ratio' END AS signature FROM (SELECT question_id, difficulty_tier AS tier, unnest(wrong_letters) AS letter, doc_id % 3 AS a, doc_id % 5 AS b FROM q)")
def detector_ratio(spark, d):
    """Ratios written into stems and distractors: which differ, and whether they override."""
    rows = questions(spark, d).withColumn("a", F.col("doc_id") % 3).withColumn("b", F.col("doc_id") % 5)
    wrong = F.filter("options", lambda o: ~o.is_correct)
    found = rows.select("question_id", "difficulty_tier", F.explode(F.transform(wrong, lambda o: F.struct(o.letter.alias("letter"), detectors.first_signature(F.concat_ws(":", F.lit("ratio 1"), "a"), F.concat_ws(":", F.lit("1"), "b")).alias("s")))).alias("x"))
    strong = F.element_at(F.array(*(F.lit(R.OVERRIDE_THRESHOLD[i]) for i in range(1, 5))), F.col("difficulty_tier")) <= 0.80
    return found.select("question_id", "x.letter", F.when(strong, "override_to").otherwise("advisory").alias("action"), F.col("x.s.signature").alias("signature"))


# --- audits


def _audit(spark: SparkSession, d: str, told) -> DataFrame:
    return questions(spark, d).select("question_id", told.alias("a")).select("question_id", F.round("a.metric", 6).alias("metric"), F.col("a.flag").alias("flag"))


_MD = "median(x)"


@query("SELECT question_id, round((c - m) / nullif(m, 0) * 100, 6) AS metric, c > mx OR (c - m) / nullif(m, 0) * 100 > 15 AS flag FROM (SELECT question_id, length(correct) AS c, list_max(list_transform(wrong, lambda t: length(t))) AS mx, list_median(list_transform(wrong, lambda t: length(t))) AS m FROM q)")
def audit_length_bias(spark, d):
    return _audit(spark, d, audits.length_bias())


@query(f"SELECT question_id, len(u)::DOUBLE AS metric, len(u) >= 3 AS flag FROM (SELECT question_id, list_filter({sql_set('correct', 5, R.COGNITIVE_STOP)}, lambda w: NOT list_contains({sql_set('stem', 4, R.COGNITIVE_STOP)}, w) AND NOT list_contains({sql_tokens('array_to_string(wrong, chr(32))', 4, R.COGNITIVE_STOP)}, w)) AS u FROM q)")
def audit_synonym_uniqueness(spark, d):
    return _audit(spark, d, audits.synonym_uniqueness())


@query(f"SELECT question_id, CASE WHEN x THEN len(u)::DOUBLE END AS metric, CASE WHEN x THEN len(u) >= 2 END AS flag FROM (SELECT question_id, NOT regexp_matches(stem, {_pattern(R.EXCEPT_AUDIT)}) AND len({sql_set('stem', 4, R.COGNITIVE_STOP)}) > 0 AS x, list_filter({sql_set('stem', 4, R.COGNITIVE_STOP)}, lambda w: contains(lower(correct), w) AND NOT contains(lower(array_to_string(wrong, '|')), w)) AS u FROM q)")
def audit_stem_keyword(spark, d):
    return _audit(spark, d, audits.stem_keyword_in_correct_only())


@query(f"SELECT question_id, {_sum(f'list_transform(texts, lambda t: len(regexp_extract_all(t, {_pattern(R.SELF_REFERENCE)})))')}::DOUBLE AS metric, {_sum(f'list_transform(texts, lambda t: len(regexp_extract_all(t, {_pattern(R.SELF_REFERENCE)})))')} > 0 AS flag FROM q")
def audit_self_reference(spark, d):
    return _audit(spark, d, audits.option_self_reference())


_CW = f"list_transform(texts, lambda t: {sql_set('t', 4, R.COGNITIVE_STOP)})"


@query(f"SELECT question_id, CASE WHEN x THEN n::DOUBLE END AS metric, CASE WHEN x THEN n > 0 END AS flag FROM (SELECT question_id, x, len(list_filter([1, 2, 3, 4], lambda i: len(s[i]) > 0 AND NOT list_has_any(s[i], list_concat(list_concat(s[i % 4 + 1], s[(i + 1) % 4 + 1]), s[(i + 2) % 4 + 1])))) AS n FROM (SELECT question_id, NOT regexp_matches(stem, {_pattern(R.EXCEPT_AUDIT)}) AS x, {_CW} AS s FROM q))")
def audit_irrelevant_option(spark, d):
    return _audit(spark, d, audits.irrelevant_option())


@query(f"SELECT question_id, len(list_filter(texts, lambda t: len({sql_tokens('t', 4, R.COGNITIVE_STOP)}) < 4))::DOUBLE AS metric, len(list_filter(texts, lambda t: len({sql_tokens('t', 4, R.COGNITIVE_STOP)}) < 4)) > 0 AS flag FROM q")
def audit_fragment(spark, d):
    return _audit(spark, d, audits.option_fragment())


@query(f"SELECT question_id, CASE WHEN regexp_matches(stem, {_pattern(R.EXCEPT_AUDIT)}) THEN round(b - c, 6) END AS metric, CASE WHEN regexp_matches(stem, {_pattern(R.EXCEPT_AUDIT)}) THEN b - c > 0.20 AND b > 0.30 END AS flag FROM (SELECT question_id, stem, ({sql_jaccard('w[1]', 'w[2]')} + {sql_jaccard('w[1]', 'w[3]')} + {sql_jaccard('w[2]', 'w[3]')}) / 3 AS b, ({sql_jaccard('o', 'w[1]')} + {sql_jaccard('o', 'w[2]')} + {sql_jaccard('o', 'w[3]')}) / 3 AS c FROM (SELECT question_id, stem, {sql_set('correct', 4, R.COGNITIVE_STOP)} AS o, list_transform(wrong, lambda t: {sql_set('t', 4, R.COGNITIVE_STOP)}) AS w FROM q))")
def audit_except_oddness(spark, d):
    return _audit(spark, d, audits.except_oddness())


KEYWORDS = ["the", "tion", "que", "der", "los"]


@query(f"SELECT question_id, h::DOUBLE AS metric, h >= 2 AND list_avg(m) < 0.5 AS flag FROM (SELECT question_id, len(list_filter({sql_list(KEYWORDS)}, lambda k: contains(lower(correct), k))) AS h, list_transform(wrong, lambda t: len(list_filter({sql_list(KEYWORDS)}, lambda k: contains(lower(t), k)))) AS m FROM q)")
def audit_keyword_concentration(spark, d):
    return _audit(spark, d, audits.keyword_concentration(T.words_array(KEYWORDS)))


@query()
def audit_term_mismatch(spark, d):
    return _audit(spark, d, audits.term_mismatch())


@query()
def flag_rollup(spark, d):
    return audits.flag_rollup(audits.audit(questions(spark, d)))


@query(f"SELECT count(*) AS n, round(avg(r), 6) AS mean, round(median(r), 6) AS median, round(max(r), 6) AS most, count(*) FILTER (WHERE r > 1.3) AS over13, count(*) FILTER (WHERE r > 1.5) AS over15, count(*) FILTER (WHERE length(correct) = mx) AS correct_longest FROM (SELECT *, {_RATIO} AS r, list_max(list_transform(texts, lambda t: length(t))) AS mx FROM q)")
def length_stats(spark, d):
    sizes = F.transform("options", lambda o: F.length(o.text))
    rows = questions(spark, d).select((F.array_max(sizes) / F.array_min(sizes)).alias("r"), (F.length(correct()) == F.array_max(sizes)).alias("longest"))
    return rows.agg(F.count("*").alias("n"), F.round(F.avg("r"), 6).alias("mean"), F.round(F.median("r"), 6).alias("median"), F.round(F.max("r"), 6).alias("most"), F.count_if(F.col("r") > 1.3).alias("over13"), F.count_if(F.col("r") > 1.5).alias("over15"), F.count_if("longest").alias("correct_longest"))


@query("SELECT question_id, array_to_string(list_transform(texts, lambda t: (len(regexp_extract_all(t, '\\([^)]+\\)')) + len(regexp_extract_all(t, ';')) + len(regexp_extract_all(t, '—|--')))::VARCHAR), ',') AS marks FROM q".replace("\\\\", "\\"))
def elaboration_markers(spark, d):
    count = lambda t: F.regexp_count(t, F.lit(R.ELABORATION["parens"])) + F.regexp_count(t, F.lit(";")) + F.regexp_count(t, F.lit(R.ELABORATION["dashes"]))
    return questions(spark, d).select("question_id", F.array_join(F.transform("options", lambda o: count(o.text).cast("string")), ",").alias("marks"))


# --- verdicts

_PASSES = "v AS (SELECT user_id, event_id % 3 AS pass, event_id % 4 AS letter, CASE event_type WHEN 'error' THEN 'english_gap' WHEN 'click' THEN 'content_gap' WHEN 'purchase' THEN 'soft_flag' ELSE 'clean' END AS class FROM events)"


def _passes(spark: SparkSession, d: str) -> DataFrame:
    cls = F.when(F.col("event_type") == "error", "english_gap").when(F.col("event_type") == "click", "content_gap").when(F.col("event_type") == "purchase", "soft_flag").otherwise("clean")
    return table(spark, d, "events").select("user_id", (F.col("event_id") % 3).alias("pass"), (F.col("event_id") % 4).alias("letter"), cls.alias("class"))


@query(f", {_PASSES}, n AS (SELECT user_id, letter, class, count(*) AS votes, min(pass) AS first_pass FROM v GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, letter ORDER BY class = 'soft_flag' DESC, votes DESC, CASE class WHEN 'english_gap' THEN 0 WHEN 'content_gap' THEN 1 WHEN 'soft_flag' THEN 2 ELSE 3 END, first_pass) AS k FROM n) SELECT user_id, letter, class, votes, first_pass FROM r WHERE k = 1")
def quorum_vote(spark, d):
    return verdicts.quorum_vote(_passes(spark, d), ["user_id", "letter"])


_AB = "a AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'clean' WHEN 'de' THEN 'content_gap' ELSE 'soft_flag' END AS class, doc_id % 11 = 0 AS o FROM documents), b AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'english_gap' WHEN doc_id % 3 = 0 THEN 'content_gap' ELSE 'clean' END AS class, doc_id % 13 = 0 AS o FROM labels)"


@query(f", {_AB} SELECT doc_id, CASE WHEN b.class IS NULL OR a.class = b.class THEN a.class WHEN a.o THEN a.class WHEN b.o THEN b.class WHEN a.class = 'english_gap' OR b.class = 'english_gap' THEN 'english_gap' ELSE 'soft_flag' END AS class, coalesce(a.class <> b.class AND NOT a.o AND NOT b.o, false)::INTEGER AS disagreement FROM a LEFT JOIN b USING (doc_id)")
def cross_model(spark, d):
    """One judge goes by the language, the other by the labels, which some documents lack."""
    a = table(spark, d, "documents").select("doc_id", F.when(F.col("lang") == "en", "clean").when(F.col("lang") == "de", "content_gap").otherwise("soft_flag").alias("class"), (F.col("doc_id") % 11 == 0).alias("structural_override"))
    b = table(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "english_gap").when(F.col("doc_id") % 3 == 0, "content_gap").otherwise("clean").alias("class"), (F.col("doc_id") % 13 == 0).alias("structural_override"))
    return verdicts.reconcile(a, b, ["doc_id"]).select("doc_id", "class", "disagreement")


@query(", a AS (SELECT source AS chapter, doc_id, coalesce(toxic, 0) AS flagged, 3 AS wrong, doc_id % 211 = 0 AS failed, quality = 0 AS major FROM documents LEFT JOIN labels USING (doc_id)), g AS (SELECT chapter, count(*) AS questions, sum(flagged)::BIGINT AS flagged, greatest(sum(wrong), 1) AS wrong, count(*) FILTER (WHERE failed) AS failed, count(*) FILTER (WHERE major) AS major FROM a GROUP BY chapter), r AS (SELECT *, CASE WHEN failed > 0 THEN 'parse_error' WHEN flagged / wrong::DOUBLE > 0.02 THEN 'english_gap' WHEN major > 5 THEN 'editorial_major' END AS why FROM g) SELECT chapter, questions, flagged, CASE WHEN w IS NULL THEN 'ready' ELSE 'review' END AS status, CASE WHEN w IS NULL THEN CASE WHEN flagged = 0 THEN 'audit_only' ELSE 'tolerance' END END AS ready_via, w AS review_reason FROM (SELECT *, CASE WHEN failed > 0 THEN 'parse_error' WHEN flagged / wrong::DOUBLE > 0.02 THEN 'english_gap' WHEN major > 0 THEN 'editorial_major' END AS w FROM r)")
def chapter_status(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    audit = rows.select(F.col("source").alias("chapter"), F.col("doc_id").alias("question_id"), F.coalesce("toxic", F.lit(0)).alias("flagged"), F.lit(3).alias("wrong"), (F.col("doc_id") % 211 == 0).alias("failed"), (F.col("quality") == 0).alias("major"))
    return verdicts.chapter_status(audit, 0.02)


@query(", s AS (SELECT source AS chapter, count(*)::VARCHAR AS source_hash FROM documents GROUP BY 1), m AS (SELECT source AS chapter, (count(*) + CASE WHEN source LIKE '%1' THEN 1 ELSE 0 END)::VARCHAR AS h, 'ready' AS st FROM documents GROUP BY 1) SELECT chapter, source_hash = h AS reused, CASE WHEN source_hash = h THEN st END AS status FROM s LEFT JOIN m USING (chapter)")
def manifest_reuse(spark, d):
    counts = table(spark, d, "documents").groupBy(F.col("source").alias("chapter")).count()
    sources = counts.select("chapter", F.col("count").cast("string").alias("source_hash"), F.lit("v1").alias("config"))
    manifest = counts.select("chapter", (F.col("count") + F.when(F.col("chapter").endswith("1"), 1).otherwise(0)).cast("string").alias("source_hash"), F.lit("v1").alias("config"), F.lit("ready").alias("status"))
    return verdicts.reuse_or_recompute(sources, manifest).select("chapter", "reused", "status")


@query(", g AS (SELECT source, count(*) AS n, sum(n_chars)::BIGINT AS chars, count(*) FILTER (WHERE n_chars > 2000) AS long FROM documents GROUP BY 1) SELECT count(*) AS chapters, sum(n)::BIGINT AS questions, sum(chars)::BIGINT AS chars, sum(long)::BIGINT AS long, count(*) FILTER (WHERE long > 10) AS heavy FROM g")
def manifest_summary(spark, d):
    chapters = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.count_if(F.col("n_chars") > 2000).alias("long"))
    return chapters.agg(F.count("*").alias("chapters"), F.sum("n").alias("questions"), F.sum("chars").alias("chars"), F.sum("long").alias("long"), F.count_if(F.col("long") > 10).alias("heavy"))


# --- export and rewriting


@query("SELECT question_id, domain, chapter, difficulty_tier, stem AS question_stem, texts[1] AS option_a, texts[2] AS option_b, texts[3] AS option_c, texts[4] AS option_d, explanations[1] AS explanation_a, explanations[2] AS explanation_b, explanations[3] AS explanation_c, explanations[4] AS explanation_d, substring('ABCD', pos, 1) AS correct_answer, wrong_letters[1] AS distractor_1_letter, wrong_letters[2] AS distractor_2_letter, wrong_letters[3] AS distractor_3_letter FROM q")
def flatten_document(spark, d):
    return publish.flatten(questions(spark, d))


@query()
def strip_reasoning(spark, d):
    rows = questions(spark, d).withColumn("options", F.transform("options", lambda o: o.withField("text", F.when(o.letter == "B", F.concat(o.text, F.lit(" because of "), o.explanation)).otherwise(o.text))))
    return publish.strip_reasoning(rows).select("question_id", F.array_join(F.transform("options", lambda o: o.text), "|").alias("texts"))


@query("SELECT question_id, array_to_string(list_transform([1, 2, 3, 4], lambda i: substring('ABCD', i, 1) || ') ' || texts[i]), chr(10)) AS block FROM q")
def prompt_block(spark, d):
    return questions(spark, d).select("question_id", publish.rendered().alias("block"))


@query("SELECT question_id, array_to_string(list_transform([1, 2, 3, 4], lambda i: CASE WHEN i = doc_id % 4 + 1 AND doc_id % 3 > 0 THEN 'new ' || i ELSE texts[i] END), '|') AS texts FROM q")
def rewrite_by_letter(spark, d):
    rows = questions(spark, d)
    at = (F.col("doc_id") % 4 + 1).cast("int")
    new = rows.select("question_id", F.substring(F.lit("ABCD"), at, F.lit(1)).alias("letter"), F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("new "), at.cast("string"))).otherwise(" ").alias("text"))
    return publish.rewrite_by_letter(rows, new).select("question_id", F.array_join(F.transform("options", lambda o: o.text), "|").alias("texts"))


@query()
def fix_laterality(spark, d):
    stem, text = F.concat(F.lit("Left side of "), "question_stem"), F.concat(F.lit("Right then right, "), F.get(distractors(), F.lit(0)))
    return questions(spark, d).select("question_id", fixers.swap_pair(stem, text, R.LATERAL_PAIRS).alias("text"))


@query("SELECT doc_id, CASE WHEN length(text) <= 2000 THEN text ELSE left(text, 1000) || ' … ' || right(text, 800) END AS text FROM documents")
def truncated_prompt(spark, d):
    return table(spark, d, "documents").select("doc_id", publish.truncated(F.col("text"), 2000, 1000, 800).alias("text"))


@query("SELECT question_id, CASE WHEN length(id) <= 64 THEN id ELSE left(id, 57) || '_' || left(md5(id), 6) END AS short FROM (SELECT question_id, repeat(question_id || '-', 1 + doc_id::INTEGER % 9) AS id FROM q)")
def short_ids(spark, d):
    return questions(spark, d).select("question_id", planning.short_id(F.repeat(F.concat("question_id", F.lit("-")), (F.col("doc_id") % 9 + 1).cast("int"))).alias("short"))


@query("SELECT doc_id % 7 AS chapter, count(*) FILTER (WHERE toxic = 0 AND quality = 1) AS clean, count(*) FILTER (WHERE toxic = 0 AND quality = 0) AS major, count(*) FILTER (WHERE toxic = 1) AS error FROM labels GROUP BY 1")
def class_tally(spark, d):
    rows = table(spark, d, "labels").select((F.col("doc_id") % 7).alias("chapter"), F.when(F.col("quality") == 1, "clean").otherwise("major").alias("class"), F.when(F.col("toxic") == 1, "x").alias("error"))
    return verdicts.class_tally(rows, ["chapter"], ["clean", "major"])


@query("SELECT doc_id % 4 AS tier, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS clean_before, count(*) FILTER (WHERE toxic = 0) AS clean_after, floor(100 * count(*) FILTER (WHERE quality = 1) / count(*))::BIGINT AS percent_before, floor(100 * count(*) FILTER (WHERE toxic = 0) / count(*))::BIGINT AS percent_after FROM labels GROUP BY 1")
def cohort_report(spark, d):
    labels = table(spark, d, "labels").withColumn("tier", F.col("doc_id") % 4)
    before = labels.select("doc_id", "tier", F.when(F.col("quality") == 1, "clean").otherwise("english_gap").alias("class"))
    after = labels.select("doc_id", F.when(F.col("toxic") == 0, "clean").otherwise("english_gap").alias("class"))
    return verdicts.cohort_report(before, after, "doc_id", ["tier"])
