"""Queries of briefs, assembly, rotation, fixers, overrides and audit files, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.functions import text as T
from quillmill.operators import assembly, briefs, corpus, fixers, planning, publish, replay, verdicts
from quillmill.plans.more import _folder
from quillmill.plans.views import SQL_QUESTIONS, questions, sql_set, sql_tokens, table
from quillmill.sources import files
from quillmill.streaming import events as streams

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register


def _every(k: int, key: str = "p_partkey"):
    return F.col(key) % k == 0


# --- briefs and vocabularies


@query("SELECT event_id, event_id % 5 AS difficulty_tier FROM events WHERE event_type <> 'error' AND value <= 400 AND event_id % 5 <> 0")
def usable_rows(spark, d):
    rows = table(spark, d, "events").select("event_id", (F.col("event_type") == "error").alias("_failed_validation"), F.when(F.col("value") > 400, "x").alias("_error"), F.nullif(F.col("event_id") % 5, F.lit(0)).alias("difficulty_tier"))
    return briefs.usable(rows).select("event_id", "difficulty_tier")


@query("SELECT o_orderkey, b.d AS discriminators FROM orders LEFT JOIN (SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE ' ' END, CASE WHEN c_custkey % 3 = 0 THEN 'left_vs_right' ELSE '' END], lambda t: trim(t) <> ''), '|') AS d FROM customer WHERE c_custkey % 7 <> 0) b ON c_custkey = o_custkey AND b.d <> ''")
def attached_discriminators(spark, d):
    own = F.array(F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise(" "), F.when(_every(3, "c_custkey"), "left_vs_right").otherwise(""))
    known = table(spark, d, "customer").select(F.when(~_every(7, "c_custkey"), F.concat(F.lit("A"), "c_custkey")).alias("uid"), own.alias("discriminators"), "c_custkey")
    asked = table(spark, d, "orders").select("o_orderkey", F.array(F.concat(F.lit("A"), "o_custkey"), F.lit("A0")).alias("anchor_uids"))
    return briefs.attach_discriminators(asked, briefs.discriminator_index(known, "c_custkey")).select("o_orderkey", F.array_join("discriminators", "|").alias("discriminators"))


_NAME = "split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b"


@query(f"SELECT p_partkey, CASE WHEN a <> b THEN a || '/' || b || ',' || b || '/' || a ELSE '' END AS pairs FROM (SELECT p_partkey, {_NAME} FROM part)")
def labelled_pairs(spark, d):
    a, b = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    given = F.array(F.concat(a, F.lit("_vs_"), b), F.concat(a, F.lit("_vs_"), a), F.concat(F.lit("level_of_"), a), F.concat(F.lit(" "), F.upper(b), F.lit("_vs_"), a, F.lit("_timing")))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.transform(briefs.labelled_pairs(given), lambda p: F.concat(p.a, F.lit("/"), p.b)), ",").alias("pairs"))


_BRIEF_STOP = R.BASE_STOP + R.MODIFIERS


@query(f"SELECT doc_id, len(w)::BIGINT AS n, md5(array_to_string(list_sort(w), ',')) AS terms FROM (SELECT doc_id, {sql_set(chr(39) + 'integrated retrieval ' + chr(39) + ' || coalesce(text, ' + chr(39) * 2 + ')', 6, _BRIEF_STOP)} AS w FROM documents)")
def brief_terms(spark, d):
    found = briefs.brief_terms(F.array(F.lit("Integrated"), F.lit(None).cast("string")), F.array("text"), F.lit("retrieval"))
    return table(spark, d, "documents").select("doc_id", found.alias("w")).select("doc_id", F.size("w").cast("long").alias("n"), F.md5(F.array_join(F.array_sort("w"), ",")).alias("terms"))


def _sql_longest(t: str, most: str = "") -> str:
    return f"list_transform(list_sort(list_transform(list_distinct({t}), lambda w: {{'n': -length(w), 'i': list_position({t}, w), 't': w}})){most}, lambda x: x.t)"


@query(f"SELECT item_id, array_to_string({_sql_longest('m')}, ',') AS terms FROM (SELECT item_id, list_concat({_sql_longest('a', '[1:4]')}, {_sql_longest('b', '[1:4]')}) AS m FROM (SELECT item_id, {sql_tokens('text', 6, R.FULL_STOP)} AS a, {sql_tokens(chr(39) + 'encoding retrieval ' + chr(39) + ' || text', 6, R.FULL_STOP)} AS b FROM benchmark))")
def cluster_terms(spark, d):
    none = F.array().cast("array<string>")
    anchors = F.array(F.struct(none.alias("descriptions"), F.array("text").alias("claims"), F.lit(None).cast("string").alias("fact")), F.struct(F.array(F.lit("encoding")).alias("descriptions"), F.array(F.lit("retrieval")).alias("claims"), F.col("text").alias("fact")))
    return table(spark, d, "benchmark").select("item_id", F.array_join(briefs.cluster_terms(anchors), ",").alias("terms"))


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct([lower(p_brand), lower(p_type)])), ',') AS terms FROM part")
def canonical_terms(spark, d):
    found = briefs.canonical_terms(F.array(F.col("p_brand"), F.lit(None).cast("string"), F.col("p_type")), F.array(F.lower("p_type"), F.lit("")))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(found), ",").alias("terms"))


@query("SELECT count(DISTINCT lower(p_name)) AS total_concepts, count(*) - count(DISTINCT lower(p_name)) AS total_aliases FROM part")
def registry_stats(spark, d):
    return briefs.registry_stats(corpus.first_seen(table(spark, d, "part"), "p_partkey", "p_name", "p_partkey"))


@query("""WITH s AS (SELECT p_partkey AS k, 'c' || p_partkey AS id, lower(p_name) AS label, 2 * p_partkey AS place FROM part UNION ALL SELECT p_partkey, 'd' || p_partkey % 40, 'label ' || p_partkey % 20, 2 * p_partkey + 1 FROM part),
f AS (SELECT id, any_value(label) AS label, min(place) AS earliest FROM s GROUP BY id), g AS (SELECT *, first_value(id) OVER (PARTITION BY label ORDER BY earliest) AS canon FROM f),
x AS (SELECT k, id, place, canon, earliest FROM s JOIN g USING (id))
SELECT 'B' || k AS uid, string_agg(canon, ',' ORDER BY place) AS concepts, string_agg(canon, '+' ORDER BY place) || '|zz+' || arg_max(canon, place) AS misconceptions, count(*) FILTER (WHERE canon = id AND place = earliest) AS n_new, count(*) FILTER (WHERE canon <> id) AS n_aliased FROM x GROUP BY k""")
def canonical_briefs(spark, d):
    c, other = F.concat(F.lit("c"), "p_partkey"), F.concat(F.lit("d"), F.col("p_partkey") % 40)
    rows = table(spark, d, "part").select(F.concat(F.lit("B"), "p_partkey").alias("uid"), (2 * F.col("p_partkey")).alias("ord"), F.array(c, other).alias("concepts"), F.array(F.array(c, other), F.array(F.lit("zz"), other)).alias("misconceptions"), F.array("p_name", F.concat(F.lit("Label "), F.col("p_partkey") % 20)).alias("labels"))
    seen = rows.select("ord", F.posexplode(F.arrays_zip("concepts", "labels")).alias("i", "c")).select((F.col("ord") + F.col("i")).alias("at"), F.col("c.concepts").alias("concept_id"), F.col("c.labels").alias("label"))
    told = briefs.canonicalised(rows, corpus.first_seen(seen, "concept_id", "label", "at"))
    return told.select("uid", F.array_join("concepts", ",").alias("concepts"), F.array_join(F.transform("misconceptions", lambda m: F.array_join(m, "+")), "|").alias("misconceptions"), "n_new", "n_aliased")


@query("SELECT p_partkey, (p_partkey % 3 = 0 AND p_name <> p_brand) OR p_partkey % 5 = 0 AS differs FROM part")
def brief_changes(spark, d):
    def brief(claim, explanation, none):
        lists = [F.array(claim).alias("core_claims"), *(none.alias(k) for k in ("concepts", "misconceptions", "question_angles", "discriminators"))]
        return F.struct(*lists, explanation.alias("concept_explanation"))

    empty, absent = F.array().cast("array<string>"), F.lit(None).cast("array<string>")
    rows = table(spark, d, "part").select("p_partkey", brief(F.col("p_name"), F.lit("x"), empty).alias("a"), brief(F.when(_every(3), F.col("p_brand")).otherwise(F.col("p_name")), F.when(_every(5), "y").otherwise("x"), absent).alias("b"))
    return rows.select("p_partkey", briefs.meaningful_change("a", "b").alias("differs"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 < 3 THEN 'concepts' WHEN p_partkey % 7 = 0 THEN 'concept_fields' WHEN p_partkey % 4 < 2 THEN 'misconceptions' WHEN p_partkey % 11 = 0 THEN 'misconception_fields' WHEN p_partkey % 3 < CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 2 END THEN 'concepts_involved' END AS reason FROM part")
def vocab_validation(spark, d):
    key = F.col("p_partkey")
    concept = F.struct(F.lit("c").alias("concept_id"), F.when(_every(7), "").otherwise("label").alias("label"))
    wrong = F.struct(F.when(_every(11), "").otherwise("m").alias("misconception_id"), F.when(_every(2), "opposite_direction").otherwise("mixed").alias("type"), F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), (key % 3).cast("int")).alias("concepts_involved"))
    rows = table(spark, d, "part").select("p_partkey", F.array_repeat(concept, (key % 5).cast("int")).alias("concepts"), F.array_repeat(wrong, (key % 4).cast("int")).alias("misconceptions"))
    return rows.select("p_partkey", briefs.vocab_failure().alias("reason"))


def _targets(spark, d):
    every = lambda k: _every(k, "event_id")
    said = lambda i: F.struct(F.when(~every(29), "B").alias("letter"), F.when(every(17) & F.lit(i == 1), "").otherwise("state").alias("candidate_state"), F.lit("means").alias("diagnostic_meaning"))
    text = lambda name: F.lit("text").alias(name)
    target = F.struct(
        F.when(every(5), " ").otherwise("claim").alias("competency_claim"), F.when(~every(7), "k").alias("knower_state"), text("non_knower_state"), F.lit("A").alias("expected_correct_letter"), text("expected_correct_reasoning"),
        F.when(every(13), F.array().cast("array<struct<letter:string,candidate_state:string,diagnostic_meaning:string>>")).otherwise(F.array(said(0), said(1))).alias("distractor_diagnoses"),
        F.when(every(11), "odd").when(~every(3), "weak").otherwise("strong").alias("discrimination_prediction_level"), text("discrimination_prediction_rationale"),
    )
    json = F.when(every(19), F.replace(F.to_json(target), F.lit('_letter":"A"'), F.lit('_letter":5'))).otherwise(F.to_json(target))
    return table(spark, d, "events").select("event_id", F.when(every(23), "[1]").otherwise(json).alias("json"))


@query("SELECT event_id, CASE WHEN event_id % 23 = 0 THEN 'not_an_object' WHEN event_id % 7 = 0 THEN 'missing:knower_state' WHEN event_id % 5 = 0 THEN 'empty:competency_claim' WHEN event_id % 19 = 0 THEN 'empty:expected_correct_letter' WHEN event_id % 11 = 0 THEN 'level' WHEN event_id % 13 = 0 THEN 'diagnoses' WHEN event_id % 29 = 0 THEN 'diagnosis:0:letter' WHEN event_id % 17 = 0 THEN 'diagnosis:1:candidate_state' END AS reason FROM events")
def target_validation(spark, d):
    return _targets(spark, d).select("event_id", briefs.target_failure(F.col("json")).alias("reason"))


@query("SELECT event_id, CASE WHEN event_id % 23 = 0 OR event_id % 7 = 0 THEN '' ELSE 'k' END AS knower_state, CASE WHEN event_id % 23 = 0 THEN 'moderate' WHEN event_id % 11 = 0 THEN 'odd' WHEN event_id % 3 > 0 THEN 'weak' ELSE 'strong' END AS level, CASE WHEN event_id % 23 = 0 OR event_id % 13 = 0 THEN '' WHEN event_id % 29 = 0 THEN '?,?' ELSE 'B,B' END AS letters FROM events")
def target_round_trip(spark, d):
    """Read, written and read again."""
    once = _targets(spark, d).select("event_id", F.to_json(briefs.target_of(F.col("json"))).alias("json"))
    return once.select("event_id", briefs.target_of(F.col("json")).alias("t")).select("event_id", "t.knower_state", F.col("t.discrimination_prediction_level").alias("level"), F.array_join(F.transform("t.distractor_diagnoses", lambda x: x.letter), ",").alias("letters"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS domain_code, CASE WHEN p_partkey % 3 > 0 THEN p_type END AS vocab, CASE WHEN p_partkey % 5 > 0 THEN 'fact' ELSE 'unknown' END AS content_type FROM part")
def task_context(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.when(_every(2), F.col("p_brand")).otherwise("").alias("domain_code"), F.slice(F.array("p_type"), F.lit(1), F.when(_every(3), 0).otherwise(1)).alias("domain_vocab"), F.when(~_every(5), "fact").alias("pedagogical_content_type"))
    told = rows.select("p_partkey", briefs.gate_context(["domain_code"], ["domain_vocab"]).alias("c"))
    return told.select("p_partkey", "c.domain_code", F.get("c.domain_vocab", F.lit(0)).alias("vocab"), F.col("c.pedagogical_content_type").alias("content_type"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END AS concept, (p_partkey % 2 = 0)::INTEGER AS n_claims, p_partkey % 2 = 0 OR p_partkey % 3 > 0 AS has_vocab FROM part")
def brief_or_vocab(spark, d):
    one = lambda c: F.array(c)
    brief = F.when(_every(2), F.struct(F.lit(True).alias("has_brief"), one("p_name").alias("concepts"), one("p_brand").alias("misconceptions"), one("p_name").alias("core_claims"), one("p_name").alias("question_angles")))
    vocab = F.struct(F.when(_every(3), F.array().cast("array<string>")).otherwise(one("p_type")).alias("concepts"), one("p_brand").alias("misconceptions"))
    told = table(spark, d, "part").select("p_partkey", "p_type", brief.alias("brief"), vocab.alias("vocab")).select("p_partkey", "p_type", briefs.with_fallback("brief", "vocab", True).alias("c"))
    return told.select("p_partkey", F.coalesce(F.get("c.concepts", F.lit(0)), "p_type").alias("concept"), F.size("c.core_claims").alias("n_claims"), "c.has_vocab")


# --- rotation, templates, assembly


_POOL = '[{"misconception_id":"m1","concepts_involved":["a"]},{"misconception_id":"m2","concepts_involved":["b"]},{"misconception_id":"m1","concepts_involved":["a","b"]},{"misconception_id":"m3","concepts_involved":["c"]},{"misconception_id":"m4","concepts_involved":["a"]}]'


@query(f"""WITH r AS (SELECT p_partkey, p_partkey % 5 + 1 AS v, p_partkey % 4 + 1 AS tier, ['a', 'b', 'z'][p_partkey % 3 + 1] AS tested, from_json('{_POOL}', '[{{"misconception_id":"VARCHAR","concepts_involved":["VARCHAR"]}}]')[1:p_partkey % 6] AS pool FROM part),
c AS (SELECT *, CASE WHEN p_partkey % 2 = 0 AND len(list_filter(pool, lambda m: list_has_any(m.concepts_involved, ['a', 'c']))) >= 3 THEN list_filter(pool, lambda m: list_has_any(m.concepts_involved, ['a', 'c'])) ELSE pool END AS p FROM r),
i AS (SELECT *, list_concat(list_transform(list_filter(p, lambda m: list_contains(m.concepts_involved, tested)), lambda m: m.misconception_id), list_transform(list_filter(p, lambda m: NOT list_contains(m.concepts_involved, tested)), lambda m: m.misconception_id)) AS ids FROM c),
t AS (SELECT *, list_concat(ids[((v - 1) * 3 + tier - 1) % greatest(len(ids), 1) + 1:], ids[1:((v - 1) * 3 + tier - 1) % greatest(len(ids), 1)]) AS turned FROM i),
u AS (SELECT *, list_filter(turned, lambda x, j: list_position(turned, x) = j) AS taken, [[1, 2, 3], [1, 2, 3], [2, 3, 4], [3, 4, 4]][tier] AS levels FROM t)
SELECT p_partkey, CASE WHEN len(pool) < 3 THEN 'open' ELSE 'focused' END AS mode, array_to_string(list_transform([1, 2, 3], lambda j: levels[j] || CASE WHEN len(pool) < 3 THEN '' ELSE coalesce(taken[j], turned[j]) END), ',') AS slots FROM u""")
def distractor_slots(spark, d):
    key = F.col("p_partkey")
    pool = F.slice(F.from_json(F.lit(_POOL), "array<struct<misconception_id:string,concepts_involved:array<string>>>"), F.lit(1), (key % 6).cast("int"))
    tested = F.element_at(F.array(*map(F.lit, "abz")), (key % 3 + 1).cast("int"))
    allowed = F.when(_every(2), F.array(F.lit("a"), F.lit("c")))
    rows = table(spark, d, "part").select("p_partkey", pool.alias("pool"), tested.alias("tested"), allowed.alias("allowed"), (key % 5 + 1).alias("variant"), (key % 4 + 1).alias("tier"))
    told = rows.select("p_partkey", planning.distractor_slots(F.col("pool"), F.col("tested"), F.col("allowed"), F.col("variant"), F.col("tier")).alias("s"))
    return told.select("p_partkey", F.get("s", F.lit(0))["mode"].alias("mode"), F.array_join(F.transform("s", lambda x: F.concat(x.level, F.coalesce(x.misconception_id, F.lit("")))), ",").alias("slots"))


@query("SELECT doc_id, CASE WHEN lang = 'en' AND doc_id % 4 = 3 THEN 'special' WHEN lang = 'en' THEN 'english' WHEN doc_id % 4 = 3 THEN 'third' END AS template FROM documents")
def template_lookup(spark, d):
    templates = spark.createDataFrame([("en", 3, "special", 1), ("en", None, "english", 2), (None, 3, "third", 3)], "lang string, tier bigint, template string, ord int")
    return planning.template_for(table(spark, d, "documents").select("doc_id", "lang", (F.col("doc_id") % 4).alias("tier")), templates, ["lang", "tier"]).select("doc_id", "template")


@query("WITH g AS (SELECT n_name AS anchor, unnest([3, 2, 1, 4]) AS tier FROM nation), v AS (SELECT *, unnest(range(1, 6))::INTEGER AS variant FROM g) SELECT anchor, tier, variant FROM v WHERE variant <> 1 AND tier <> 4")
def remaining_tasks(spark, d):
    key = lambda t: t.withColumn("task", F.concat_ws("-", "anchor", "tier", "variant"))
    grid = key(planning.task_grid(table(spark, d, "nation").select(F.col("n_name").alias("anchor"))))
    return planning.remaining(grid, grid.where("variant = 1"), grid.where("tier = 4"), on="task").select("anchor", "tier", "variant")


@query("SELECT 'QZ-BPSY-' || replace(p_brand, '#', '') || '-' || ['E', 'M', 'H', 'X'][p_partkey % 4 + 1] || '-0' || (p_partkey % 5 + 1) AS question_id, replace(p_name, ' ', '-') || '.html' AS chapter_file, CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_name END AS section_title, left(repeat(p_name, 20), 120) AS anchor_label, ['easy', 'medium', 'hard', 'expert'][p_partkey % 4 + 1] AS difficulty_label, ['remember', 'understand', 'apply', 'evaluate'][p_partkey % 4 + 1] AS blooms_primary, ['understand', 'apply', 'analyze', 'analyze'][p_partkey % 4 + 1] AS blooms_secondary FROM part")
def question_metadata(spark, d):
    tasks = table(spark, d, "part").select(
        F.lit("BPSY").alias("domain_code"), F.col("p_name").alias("chapter_title"), F.when(_every(3), F.col("p_type")).otherwise("").alias("section_title"), F.col("p_brand").alias("anchor_uid"),
        F.replace("p_brand", F.lit("#"), F.lit("")).alias("anchor_id_v2"), F.repeat("p_name", F.lit(20)).alias("verbatim_anchor"), (F.col("p_partkey") % 4 + 1).alias("tier"), (F.col("p_partkey") % 5 + 1).alias("variant"),
    )
    return assembly.metadata(tasks).select("question_id", "chapter_file", "section_title", "anchor_label", "difficulty_label", "blooms_primary", "blooms_secondary")


@query("SELECT p_partkey, 'What is ' || p_type || '? What are its key characteristics and functions?' AS concept_front, CASE WHEN p_partkey % 2 = 0 THEN array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(substring(w, 2))), ' ') || ' vs. Axis-2B Rest — what are the key differences between these concepts?' ELSE 'How does ' || p_type || ' differ from its most commonly confused concept?' END AS comparison_front FROM part".replace("Axis-2B", "Axis 2B"))
def flashcard_fronts(spark, d):
    involved = F.slice(F.array(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("axis-2b-rest")), F.lit(1), F.when(_every(2), 2).otherwise(1))
    return table(spark, d, "part").select("p_partkey", assembly.flashcard_fronts(F.col("p_type"), involved).alias("f")).select("p_partkey", "f.concept_front", "f.comparison_front")


@query(f"WITH {SQL_QUESTIONS.rstrip()} SELECT question_id, CASE WHEN doc_id % 9 > 0 THEN array_to_string(list_transform([1, 2, 3, 4], lambda i: substring('ABCD', i, 1) || CASE WHEN i = pos THEN '+' ELSE (CASE WHEN i > pos THEN i - 1 ELSE i END)::VARCHAR END || texts[i]), '|') END AS options, CASE WHEN doc_id % 9 = 0 THEN 'distractor count mismatch' END AS error FROM q")
def assembled_questions(spark, d):
    """The questions taken apart and put together again; a ninth of them lacks a wrong option."""
    wrong = F.transform(F.filter("options", lambda o: ~o.is_correct), lambda o: F.struct(o.text.alias("text"), o.explanation.alias("explanation")))
    right = F.get(F.filter("options", lambda o: o.is_correct), F.lit(0))
    slots = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct(i.alias("level"), F.concat(F.lit("m"), i).alias("misconception_id")))
    parts = questions(spark, d).select("question_id", F.struct(right.text.alias("text"), right.explanation.alias("explanation")).alias("correct"), F.slice(wrong, F.lit(1), F.when(F.col("doc_id") % 9 == 0, 2).otherwise(3)).alias("distractors"), slots.alias("slots"), right.letter.alias("target_position"))
    shown = F.transform("options", lambda o: F.concat(o.letter, F.coalesce(o.distractor_level.cast("string"), F.lit("+")), o.text))
    return assembly.assembled(parts).select("question_id", F.array_join(shown, "|").alias("options"), "error")


@query("SELECT 'QZ-BPSY-AP-D7-' || event_id || '-' || substring('EMHXQ', (event_id % 5 + 1)::INTEGER, 1) || '-01' AS question_id, 'BPSY' AS domain_code, (event_id % 5 + 1)::INTEGER % 5 AS difficulty_tier, CASE WHEN event_id % 5 < 4 THEN 'D7-' || event_id ELSE '' END AS anchor, event_type AS original_gate FROM events")
def rebuilt_failures(spark, d):
    letter = F.substring(F.lit("EMHXQ"), (F.col("event_id") % 5 + 1).cast("int"), F.lit(1))
    log = table(spark, d, "events").select(F.concat(F.lit("QZ-BPSY-AP-D7-"), "event_id", F.lit("-"), letter, F.lit("-01")).alias("question_id"), F.lit(None).cast("string").alias("question_stem"), F.concat("event_type", F.lit(": it failed")).alias("reason"))
    return assembly.rebuilt(log).select("question_id", "domain_code", "difficulty_tier", F.array_join("anchor_uids", ",").alias("anchor"), "original_gate")


@query("SELECT 'RE-' || p_partkey AS question_id, p_brand AS domain_code, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE '' END AS question_stem, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'A' || p_type || '+,B-' END AS options FROM part")
def artefact_questions(spark, d):
    options = F.array(F.struct(F.lit("A").alias("letter"), F.col("p_type").alias("text"), F.lit(True).alias("is_correct")), F.struct(F.lit("B").alias("letter"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("boolean").alias("is_correct")))
    records = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("source_qid"), F.col("p_brand").alias("domain"), F.lit(1).alias("tier"), F.when(_every(2), F.col("p_name")).alias("generated_stem_preview"), F.when(~_every(3), options).alias("generated_options"))
    shown = F.transform("options", lambda o: F.concat(o.letter, o.text, F.when(o.is_correct, "+").otherwise("-")))
    return assembly.from_artefact(records, "RE-").select("question_id", "domain_code", "question_stem", F.array_join(shown, ",").alias("options"))


@query("SELECT p_partkey, '’' || p_name || '—' AS text, '“' || p_brand || chr(160) AS inner_text FROM part")
def repaired_texts(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.struct(F.concat(F.lit("â€™"), "p_name", F.lit("â€”")).alias("text"), F.array(F.struct(F.concat(F.lit("â€œ"), "p_brand", F.lit("Â\xa0")).alias("x"))).alias("list")).alias("q"))
    told = rows.select("p_partkey", T.repair_mojibake_deep(F.col("q"), rows.schema["q"].dataType).alias("q"))
    return told.select("p_partkey", "q.text", F.get("q.list", F.lit(0)).x.alias("inner_text"))


# --- samples and stamps


@query("SELECT doc_id FROM documents WHERE doc_id % 4 = 3 AND coalesce(nullif(doc_id % 7, 0), 5) < 5 ORDER BY doc_id LIMIT 6")
def flagged_first(spark, d):
    rows = table(spark, d, "documents").where("doc_id % 4 = 3").select("doc_id", (F.col("doc_id") % 7).alias("ambiguity"))
    return planning.first_flagged(rows, "ambiguity", 5, "doc_id", 6).select("doc_id")


@query("WITH a AS (SELECT o_orderkey, 0 AS step FROM orders WHERE o_totalprice > 300000 ORDER BY o_orderkey LIMIT 4), b AS (SELECT o_orderkey, 1 AS step FROM orders WHERE o_totalprice > 250000 AND o_orderkey NOT IN (SELECT o_orderkey FROM a) QUALIFY row_number() OVER (ORDER BY o_orderkey) <= 8 - (SELECT count(*) FROM a)), c AS (SELECT o_orderkey, 2 AS step FROM orders WHERE o_orderstatus = 'P' AND o_orderkey NOT IN (SELECT o_orderkey FROM a UNION SELECT o_orderkey FROM b) QUALIFY row_number() OVER (ORDER BY o_orderkey) <= 10 - (SELECT count(*) FROM a) - (SELECT count(*) FROM b)) SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c")
def representative_sample(spark, d):
    steps = [(F.col("o_totalprice") > 300000, 4), (F.col("o_totalprice") > 250000, 8), (F.col("o_orderstatus") == "P", 10)]
    return assembly.representative(table(spark, d, "orders"), "o_orderkey", steps, "o_orderkey").select("o_orderkey", "step")


@query("SELECT source, arg_min(lang, doc_id) AS lang FROM documents GROUP BY source")
def first_of_chapter(spark, d):
    return assembly.first_of_group(table(spark, d, "documents"), "source", "lang", "doc_id")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 25")
def run_limit(spark, d):
    return assembly.run_limit(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 25)


@query("SELECT user_id, strftime(min(ts), '%Y-%m-%dT%H:%M:%SZ') AS started, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS latency_ms FROM events GROUP BY user_id")
def stamps(spark, d):
    runs = table(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return runs.select("user_id", assembly.utc_stamp(F.col("a")).alias("started"), assembly.latency_ms(F.col("a"), F.col("b")).alias("latency_ms"))


@query("SELECT event_id, event_type IN ('click', 'error') AS known FROM events")
def known_classes(spark, d):
    return table(spark, d, "events").select("event_id", assembly.known(F.col("event_type"), ["click", "error"]).alias("known"))


@query("SELECT DISTINCT event_type AS flavor FROM events WHERE event_type NOT IN ('click', 'view')")
def missing_blocks(spark, d):
    blocks = spark.createDataFrame([("click",), ("view",)], "flavor string")
    return briefs.missing_blocks(table(spark, d, "events").select(F.col("event_type").alias("flavor")), blocks, "flavor")


# --- verdicts and fixers


@query("WITH h AS (SELECT DISTINCT doc_id FROM documents), c AS (SELECT l.doc_id, CASE WHEN toxic = 1 THEN 'english_gap' ELSE 'clean' END AS class, h.doc_id IS NOT NULL AND l.doc_id % 2 = 0 AS fired FROM labels l LEFT JOIN h USING (doc_id)), x AS (SELECT *, CASE WHEN class = 'english_gap' AND fired AND doc_id % 3 = 0 THEN 'content_gap' ELSE class END AS k FROM c) SELECT doc_id, CASE WHEN k <> 'english_gap' AND fired AND doc_id % 5 = 0 THEN 'english_gap' ELSE k END AS class, k <> 'english_gap' AND fired AND doc_id % 5 = 0 AS overridden FROM x")
def override_chain(spark, d):
    judged = table(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "english_gap").otherwise("clean").alias("class"))
    every = lambda k: _every(k, "doc_id")
    signals = table(spark, d, "documents").select("doc_id", every(2).alias("fired"), F.when(every(3), "schema_labeling").otherwise("laterality").alias("detector_id"), F.when(every(5), "override_to").otherwise("note").alias("verdict_action"), F.lit("english_gap").alias("proposed_class"))
    return verdicts.english_gap_override(verdicts.schema_override(judged, signals, ["doc_id"]), signals, ["doc_id"]).select("doc_id", "class", "overridden")


@query("WITH v AS (SELECT user_id, event_id % 4 AS letter, CASE WHEN max(event_id) % 2 = 0 THEN 'english_gap' ELSE 'clean' END AS class FROM events WHERE event_id % 3 > 0 GROUP BY ALL), s AS (SELECT DISTINCT user_id, event_id % 4 AS letter FROM events WHERE event_type = 'click') SELECT user_id, count(*) FILTER (WHERE class IS DISTINCT FROM 'english_gap') AS disagreements FROM s LEFT JOIN v USING (user_id, letter) GROUP BY user_id")
def signal_disagreements(spark, d):
    log = table(spark, d, "events").withColumn("letter", F.col("event_id") % 4)
    judged = log.where("event_id % 3 > 0").groupBy("user_id", "letter").agg(F.when(F.max("event_id") % 2 == 0, "english_gap").otherwise("clean").alias("class"))
    return verdicts.signal_disagreements(log.select("user_id", "letter", (F.col("event_type") == "click").alias("fired")), judged, ["user_id", "letter"])


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'legacy' WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS flagged FROM part")
def derived_flagged(spark, d):
    row = lambda cls, text: F.struct(cls.alias("class"), text.alias("text"))
    told = F.when(~_every(3), F.array(row(F.when(_every(2), "english_gap").otherwise("clean"), F.col("p_brand")), row(F.lit("clean"), F.lit("x"))))
    found = verdicts.derive_flagged(told, F.array(row(F.lit("english_gap"), F.lit("legacy"))))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.transform(found, lambda x: x.text), ",").alias("flagged"))


@query("SELECT p_partkey, ['One two three four five six seven eight nine ten ' || p_partkey, 'The right side of part ' || p_partkey, 'Seen in adulthood by part ' || p_partkey, 'The antagonist part ' || p_partkey][p_partkey % 4 + 1] AS text FROM part")
def routed_fixes(spark, d):
    at = (F.col("p_partkey") % 4 + 1).cast("int")
    pick = lambda *xs: F.concat(F.element_at(F.array(*map(F.lit, xs)), at), F.col("p_partkey").cast("string"))
    stem = pick("No side here ", "Right lesion of part ", "In adulthood, part ", "An antagonist for part ")
    text = pick("One two always three four five six seven eight nine ten ", "The left side of part ", "Seen in childhood by part ", "The agonist part ")
    rows = table(spark, d, "part").select("p_partkey", pick("", "", "", "").alias("x"), stem.alias("stem"), text.alias("text"), F.element_at(F.array(*map(F.lit, ("universal_quantifier", "laterality", "stage_timing", "schema_labeling"))), at).alias("signature"))
    return rows.select("p_partkey", fixers.route(F.col("signature"), F.col("stem"), F.col("text")).alias("text"))


_AGES = {name: round((low + high) / 2) for name, (low, high) in R.INSTRUMENT_AGES.items() if name in ("wisc-v", "wais-iv")}


@query(f"SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'A ' || a || '-year-old, then 7 years old.' WHEN 1 THEN 'Tested at age ' || a || ' in part.' ELSE 'She is ' || a || ' years old.' END AS stem FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN {_AGES['wisc-v']} ELSE {_AGES['wais-iv']} END AS a FROM part)")
def fixed_ages(spark, d):
    stem = F.element_at(F.array(*map(F.lit, ("A 3-year-old, then 7 years old.", "Tested at age 99 in part.", "She is 5 years old."))), (F.col("p_partkey") % 3 + 1).cast("int"))
    rows = table(spark, d, "part").select("p_partkey", stem.alias("stem"), F.when(_every(2), "WISC-V").otherwise("wais-iv").alias("instrument"))
    return rows.select("p_partkey", fixers.set_stem_age(F.col("stem"), fixers.middle_age(F.col("instrument"))).alias("stem"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 1 THEN 1 ELSE 2 END AS attempt, CASE WHEN event_id % 6 = 0 THEN 'x,y' ELSE '' END AS failures FROM events")
def two_attempts(spark, d):
    failing = lambda rule, why: F.when(rule, F.array(*map(F.lit, why))).otherwise(F.array().cast("array<string>"))
    first = lambda t: t.withColumn("attempt", F.lit(1)).withColumn("failures", failing(_every(2, "event_id"), "x"))
    again = lambda t: t.withColumn("attempt", F.lit(2)).withColumn("failures", failing(_every(3, "event_id"), "xy"))
    return replay.two_attempts(table(spark, d, "events").select("event_id"), first, again).select("event_id", "attempt", F.array_join("failures", ",").alias("failures"))


# --- files and streams


@query("SELECT doc_id, toxic = 1 AS flagged, 'v1' AS judge, CASE WHEN toxic = 1 THEN 'fixed' ELSE 'kept' END AS state FROM labels")
def audit_files(spark, d):
    path = _folder(spark)
    rows = table(spark, d, "labels").select("doc_id", (F.col("toxic") == 1).alias("flagged"))
    files.write_audit(rows, rows.select("doc_id", F.when(F.col("flagged"), "fixed").otherwise("kept").alias("state")), {"judge": "v1"}, f"{path}/batch")
    audit = spark.read.schema("doc_id bigint, flagged boolean, metadata struct<judge:string>").json(f"{path}/batch.audit.json")
    fixed = spark.read.schema("doc_id bigint, state string").json(f"{path}/batch.fixed.json")
    return audit.join(fixed, "doc_id").select("doc_id", "flagged", "metadata.judge", "state")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_once_per_key(spark, d):
    source, path = table(spark, d, "events"), _folder(spark)
    stream = spark.readStream.schema(source.schema).parquet(d.rstrip("/"), pathGlobFilter="events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    once = streams.once_per_key(stream, ["user_id", "event_type"], "ts", "3650 days").select("user_id", "event_type")
    once.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("WITH s AS (SELECT source AS path, count(*) AS n FROM documents GROUP BY 1) SELECT path, n::VARCHAR AS source_hash, 2 * n AS work FROM s UNION ALL SELECT path, (n + 1)::VARCHAR, 2 * (n + 1) FROM s WHERE n % 2 = 0")
def stream_changed_only(spark, d):
    """A second batch in which every second source has changed; the others are not computed again."""
    path = _folder(spark)
    counted = table(spark, d, "documents").groupBy(F.col("source").alias("path")).agg(F.count("*").alias("n"))
    run = streams.reprocess_changed(f"{path}/manifest", lambda t: t.select("path", "source_hash", (2 * F.col("source_hash").cast("long")).alias("work")))
    for number, n in enumerate((F.col("n"), F.when(F.col("n") % 2 == 0, F.col("n") + 1).otherwise(F.col("n")))):
        run(counted.select("path", n.cast("string").alias("source_hash")), number)
    return spark.read.parquet(f"{path}/manifest")


@query(f"WITH {SQL_QUESTIONS.rstrip()} SELECT question_id, 'because' AS marker, 'A long enough head of words' AS text_b, texts[1] AS text_a FROM q")
def stripped_reasons(spark, d):
    """Questions whose second option ends in a reason, which goes to the explanation."""
    rows = questions(spark, d).select("question_id", F.transform("options", lambda o: o.withField("text", F.when(o.letter == "B", "A long enough head of words because it is so").when(o.letter == "A", o.text).otherwise("short"))).alias("options"))
    told = publish.strip_reasoning(rows.withColumn("a", F.get("options", F.lit(0)).text).withColumn("options", F.transform("options", lambda o: o.withField("text", F.when(o.letter == "A", "short too").otherwise(o.text)))))
    b = F.get("options", F.lit(1))
    return told.select("question_id", F.regexp_extract(b.explanation, "(because) it is so$", 1).alias("marker"), b.text.alias("text_b"), F.col("a").alias("text_a"))
