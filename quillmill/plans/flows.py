"""Queries of ordinals, fix passes, keywords, what-if runs and rescues, over whole tables.

The tables hold no verdicts and no answers of models, so these are planted: a
checksum of a question's id, the letter and the pass says what a judge or a model
answered, on both sides alike.  What is made of the answers is stated twice, as operators and as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.operators import keywords, ordinals, passes, planning, rescue, whatif
from quillmill.plans.views import SQL_QUESTIONS, questions, sql_list, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register


def drawn(*parts: Column | str) -> Column:
    """0 to 255 from a checksum of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))), 1, 2), 16, 10).cast("int")


def sql_drawn(*parts: str) -> str:
    return f"('0x' || left(md5(concat_ws('|', {', '.join(parts)})), 2))::INTEGER"


# --- ordinals


_ZIP = "a AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS ordinal FROM orders), b AS (SELECT event_id, event_type, row_number() OVER (ORDER BY ts DESC, event_id) - 1 AS ordinal FROM events)"


@query(f"WITH {_ZIP} SELECT a.ordinal, o_orderkey, event_id, event_type FROM a JOIN b USING (ordinal)")
def zip_audit(spark: SparkSession, d: str) -> DataFrame:
    orders, events = table(spark, d, "orders").select("o_orderkey", "o_orderdate"), table(spark, d, "events").select("event_id", "event_type", "ts")
    return ordinals.zip_rows(orders, events, ["o_orderdate", "o_orderkey"], [F.desc("ts"), "event_id"]).select("ordinal", "o_orderkey", "event_id", "event_type")


@query("WITH s AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS a FROM lineitem) SELECT a // 10000 AS chunk, count(*) AS n, min(l_orderkey) AS first_l_orderkey, arg_min(l_linenumber, a) AS first_l_linenumber, max(l_orderkey) AS last_l_orderkey, arg_max(l_linenumber, a) AS last_l_linenumber FROM s GROUP BY 1")
def batch_manifest(spark: SparkSession, d: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return ordinals.ends_of_chunks(ordinals.chunked(table(spark, d, "lineitem").select(*keys), keys, 10_000), "chunk", keys)


@query(f"WITH s AS (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS a FROM part), g AS (SELECT p_partkey, a, unnest([1, 2, 3, 4]) AS tier FROM s), v AS (SELECT *, unnest(range(1, 6)) AS variant FROM g) SELECT p_partkey, tier, variant::INTEGER AS variant, {sql_list(R.POSITIONS)}[(a * 20 + (tier - 1) * 5 + variant - 1) % 20 + 1] AS letter FROM v")
def position_grid(spark: SparkSession, d: str) -> DataFrame:
    anchors = ordinals.with_ordinal(table(spark, d, "part").select("p_partkey", "p_retailprice"), "p_retailprice", "p_partkey", name="a")
    return planning.task_grid(anchors, 5).select("p_partkey", "tier", "variant", planning.answer_position(F.col("a"), F.col("tier"), F.col("variant")).alias("letter"))


# --- judges and fixes


def _chapter_questions(spark: SparkSession, d: str) -> DataFrame:
    return questions(spark, d).select("question_id", F.col("doc_id").alias("chapter"), "difficulty_tier", "domain", "question_stem", "options")


def _wrong_letters(rows: DataFrame) -> DataFrame:
    return rows.select("question_id", F.explode(F.transform(F.filter("options", lambda o: ~o.is_correct), lambda o: o.letter)).alias("letter"))


def _verdicts(rows: DataFrame) -> DataFrame:
    q = F.col("question_id")
    each = rows.select("question_id", "options", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("pass")).withColumn("judge", F.explode(F.sequence(F.lit(1), F.lit(3)))).withColumn("error", F.when(drawn(q, F.col("pass"), F.col("judge"), "error") == 0, "json_parse_failed"))
    letters = F.when(F.col("error").isNull(), F.transform(F.filter("options", lambda o: ~o.is_correct), lambda o: o.letter)).otherwise(F.array(F.lit(None).cast("string")))
    told = each.withColumn("letter", F.explode(letters))
    h, bad = drawn(q, F.col("pass"), F.col("letter"), F.col("judge")), drawn(q, F.col("pass"), "bad") < 50
    cls = F.when(h < F.when(bad, 150).otherwise(25), "english_gap").when(h < 180, "clean").when(h < 250, "content_gap").otherwise("soft_flag")
    return told.select("question_id", "pass", "judge", "letter", F.when(F.col("letter").isNotNull(), cls).alias("class"), "error")


def _signals(rows: DataFrame) -> DataFrame:
    h = drawn(F.col("question_id"), F.col("letter"), "signal")
    kind = F.when(h % 2 == 0, "schema_labeling").otherwise("english_gap_scanner")
    return _wrong_letters(rows).select("question_id", "letter", (h < 24).alias("fired"), kind.alias("detector_id"), F.when(h % 3 == 1, "override_to").otherwise("note").alias("verdict_action"), F.lit("english_gap").alias("proposed_class"))


def _rewrites(rows: DataFrame) -> DataFrame:
    stem = rows.select("question_id", F.lit(1).alias("pass"), F.lit(None).cast("string").alias("letter"), F.concat(F.lit(" New "), "question_stem").alias("whole"), drawn(F.col("question_id"), "stem", "rewrite").alias("h"))
    option = _wrong_letters(rows).select("question_id", F.lit(2).alias("pass"), "letter", F.concat(F.lit("New "), "question_id", F.lit(" "), "letter").alias("whole"), drawn(F.col("question_id"), F.col("letter"), "rewrite").alias("h"))
    text = F.when(F.col("h") < 60, None).when(F.col("letter").isNull() & (F.col("h") < 75), "  ").otherwise(F.col("whole"))
    why = F.when(F.col("h") % 2 == 0, F.concat(F.lit("Why "), "letter"))
    return stem.unionByName(option).where("h < 250").select("question_id", "pass", "letter", text.alias("text"), why.alias("explanation"), F.when(F.col("h") < 20, "api").alias("error"))


_JUDGED = f"""
v AS (
  SELECT *, CASE WHEN error IS NOT NULL THEN NULL WHEN h < CASE WHEN bad THEN 150 ELSE 25 END THEN 'english_gap' WHEN h < 180 THEN 'clean' WHEN h < 250 THEN 'content_gap' ELSE 'soft_flag' END AS class FROM (
    SELECT question_id, pass, judge, letter, error, {sql_drawn("question_id", "pass", "letter", "judge")} AS h, {sql_drawn("question_id", "pass", "'bad'")} < 50 AS bad FROM (
      SELECT question_id, pass, judge, error, unnest(CASE WHEN error IS NULL THEN wrong_letters ELSE [NULL] END) AS letter FROM (
        SELECT question_id, wrong_letters, pass, judge, CASE WHEN {sql_drawn("question_id", "pass", "judge", "'error'")} = 0 THEN 'json_parse_failed' END AS error FROM q, range(3) a(pass), range(1, 4) b(judge))))),
runs AS (SELECT 0 AS pass, 3 AS judges UNION ALL SELECT 1, 1 UNION ALL SELECT 2, 3),
answers AS (SELECT v.* FROM v JOIN runs USING (pass) WHERE judge <= judges),
errors AS (
  SELECT question_id, pass, CASE WHEN ok = 0 THEN first_error WHEN ok < judges THEN 'partial: ' || ok || '/' || judges || ' succeeded' END AS error FROM (
    SELECT question_id, pass, any_value(judges) AS judges, count(DISTINCT judge) FILTER (error IS NULL) AS ok, arg_min(error, judge) FILTER (error IS NOT NULL) AS first_error FROM answers JOIN runs USING (pass) GROUP BY ALL)),
signals AS (SELECT *, {sql_drawn("question_id", "letter", "'signal'")} AS h FROM (SELECT question_id, unnest(wrong_letters) AS letter FROM q)),
votes AS (
  SELECT question_id, pass, letter, class FROM (SELECT question_id, pass, letter, class, count(*) AS n, min(judge) AS first FROM answers WHERE error IS NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY question_id, pass, letter ORDER BY class = 'soft_flag' DESC, n DESC, list_position(['english_gap', 'content_gap', 'soft_flag', 'clean'], class), first) = 1),
final AS (
  SELECT question_id, pass, letter, CASE WHEN h < 24 AND h % 3 = 1 THEN 'english_gap' WHEN class = 'english_gap' AND h < 24 AND h % 2 = 0 THEN 'content_gap' ELSE class END AS class
  FROM votes JOIN signals USING (question_id, letter)),
told AS (
  SELECT question_id, pass, error, coalesce(list(letter ORDER BY letter) FILTER (class = 'english_gap'), []) AS flagged, count(*) FILTER (class = 'soft_flag') AS soft
  FROM errors LEFT JOIN final USING (question_id, pass) GROUP BY question_id, pass, error)"""


@query(f"WITH {SQL_QUESTIONS}, {_JUDGED} SELECT question_id, array_to_string(flagged, '') AS flagged, soft::INTEGER AS n_soft, error FROM told WHERE pass = 0")
def judged_letters(spark: SparkSession, d: str) -> DataFrame:
    rows = _chapter_questions(spark, d)
    return passes.judged(_verdicts(rows).where("pass = 0"), _signals(rows), 3).select("question_id", F.array_join("flagged", "").alias("flagged"), "n_soft", "error")


THRESHOLD = 0.1
_PASSES = f"""
rw AS (SELECT *, CASE WHEN h < 60 THEN NULL WHEN letter IS NULL AND h < 75 THEN '  ' ELSE whole END AS text, CASE WHEN h % 2 = 0 THEN 'Why ' || letter END AS why, h < 20 AS failed FROM (
  SELECT question_id, NULL AS letter, ' New ' || stem AS whole, {sql_drawn("question_id", "'stem'", "'rewrite'")} AS h FROM q
  UNION ALL SELECT question_id, letter, 'New ' || question_id || ' ' || letter, {sql_drawn("question_id", "letter", "'rewrite'")} FROM (SELECT question_id, unnest(wrong_letters) AS letter FROM q)) WHERE h < 250),
s0 AS (SELECT q.question_id, q.doc_id AS chapter, stem, texts, explanations, error, flagged, soft FROM q JOIN told t ON t.question_id = q.question_id AND t.pass = 0),
c0 AS (SELECT chapter, count(*) AS n, sum(len(flagged)) AS caught, 3 * count(*) AS wrong, count(error) AS failed FROM s0 GROUP BY chapter),
c1 AS (SELECT *, caught / wrong::DOUBLE <= {THRESHOLD} AS within, failed = 0 AND caught / wrong::DOUBLE > {THRESHOLD} AS fix FROM c0),
s1 AS (
  SELECT s0.*, fix, fix AND len(flagged) > 0 AND len(flagged) / 3.0 >= 0.5 AS tried, CASE WHEN NOT rw.failed AND trim(rw.text, ' ') <> '' THEN trim(rw.text, ' ') END AS new_stem
  FROM s0 JOIN c1 USING (chapter) LEFT JOIN rw ON rw.question_id = s0.question_id AND rw.letter IS NULL),
s2 AS (
  SELECT s1.*, tried AND new_stem IS NOT NULL AS done, CASE WHEN tried AND new_stem IS NOT NULL THEN a.flagged WHEN tried OR NOT fix THEN [] ELSE s1.flagged END AS residual
  FROM s1 LEFT JOIN told a ON a.question_id = s1.question_id AND a.pass = 1),
x AS (SELECT question_id, count(*) AS applied, map(list(letter), list(text)) AS fixed, map(list(letter), list(why)) AS whys FROM (SELECT question_id, unnest(residual) AS letter FROM s2) JOIN rw USING (question_id, letter) WHERE NOT failed AND text IS NOT NULL GROUP BY 1),
s3 AS (
  SELECT s2.question_id, chapter, CASE WHEN done THEN new_stem ELSE stem END AS stem, len(residual) AS attempted, coalesce(applied, 0) AS applied,
    (tried AND NOT done)::INTEGER + len(residual) - coalesce(applied, 0) AS errors,
    array_to_string(list_transform(texts, lambda t, i: coalesce(fixed[substring('ABCD', i, 1)], t)), '|') AS texts, array_to_string(list_transform(explanations, lambda t, i: coalesce(whys[substring('ABCD', i, 1)], t)), '|') AS explanations,
    CASE WHEN fix THEN len(b.flagged) ELSE len(s2.flagged) END AS remaining, CASE WHEN fix THEN b.soft ELSE s2.soft END AS soft,
    CASE WHEN done AND len(residual) > 0 THEN 'stem_rewrite+distractor_rewrite' WHEN done THEN 'stem_rewrite' WHEN len(residual) > 0 THEN 'distractor_rewrite' ELSE 'none' END AS intervention
  FROM s2 LEFT JOIN x USING (question_id) JOIN told b ON b.question_id = s2.question_id AND b.pass = 2)"""


def _passes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = _chapter_questions(spark, d)
    return passes.fix_passes(rows.drop("difficulty_tier", "domain"), _verdicts(rows), _signals(rows), _rewrites(rows), threshold=THRESHOLD)


@query(f"WITH {SQL_QUESTIONS}, {_JUDGED}, {_PASSES} SELECT question_id, chapter, intervention, attempted::INTEGER AS attempted, applied::INTEGER AS applied, errors::INTEGER AS errors, remaining::INTEGER AS remaining, stem, texts, explanations FROM s3")
def fixed_questions(spark: SparkSession, d: str) -> DataFrame:
    fixed, _ = _passes(spark, d)
    joined = lambda field: F.array_join(F.transform("options", lambda o: o[field]), "|").alias(f"{field}s")
    return fixed.select("question_id", "chapter", "intervention", "attempted", "applied", "errors", "remaining", F.col("question_stem").alias("stem"), joined("text"), joined("explanation"))


@query(f"""WITH {SQL_QUESTIONS}, {_JUDGED}, {_PASSES},
e AS (SELECT chapter, sum(remaining) AS remaining, sum(soft) AS soft, sum(applied) AS applied, sum(errors) AS errors, count(*) FILTER ({sql_drawn("question_id", "'major'")} = 1) AS major FROM s3 GROUP BY chapter),
w AS (SELECT *, CASE WHEN failed > 0 THEN 'audit_parse_errors=' || failed WHEN fix AND remaining / wrong::DOUBLE > {THRESHOLD} THEN 'fix_did_not_converge' WHEN major > 0 THEN 'editorial_major' END AS reason FROM c1 JOIN e USING (chapter))
SELECT d.doc_id AS chapter, coalesce(n, 0) AS n_questions, CASE WHEN n IS NULL THEN 'empty' WHEN reason IS NULL THEN 'ready' ELSE 'review' END AS status,
  CASE WHEN n IS NOT NULL AND reason IS NULL THEN CASE WHEN fix THEN 'post_fix' WHEN caught = 0 THEN 'audit_only' ELSE 'tolerance' END END AS ready_via, reason AS review_reason, coalesce(caught, 0)::BIGINT AS caught, coalesce(remaining, 0)::BIGINT AS remaining,
  coalesce(soft, 0)::BIGINT AS n_soft, coalesce(applied, 0)::BIGINT AS fixes_applied, coalesce(errors, 0)::BIGINT AS fixes_failed, coalesce(failed, 0) AS parse_errors
FROM documents d LEFT JOIN w ON w.chapter = d.doc_id""")
def ship_chapters(spark: SparkSession, d: str) -> DataFrame:
    fixed, chapters = _passes(spark, d)
    majors = fixed.groupBy("chapter").agg(F.count_if(drawn(F.col("question_id"), "major") == 1).alias("n_major"))
    return passes.with_empty(passes.editorial_hold(chapters, majors), table(spark, d, "documents").select(F.col("doc_id").alias("chapter")))


# --- keywords

_BLANK = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}]+"
_LETTER = r"0-9_\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}"


@query(rf"""
WITH RECURSIVE
t AS (SELECT d.doc_id, CASE WHEN coalesce(l.quality, 0) = 1 THEN [d.lang, d.source, 'topic ' || d.doc_id % 7] ELSE [d.lang] END AS labels, d.text, regexp_replace(lower(d.text), '[a-z]*[{_LETTER}][a-z{_LETTER}]*', '0', 'g') AS clean FROM documents d LEFT JOIN labels l USING (doc_id)),
o AS (SELECT * FROM t WHERE len(labels) < 3 AND length(text) >= 20),
p AS (SELECT doc_id, 0 AS kind, regexp_replace(unnest(m), '{_BLANK}', ' ', 'g') AS term, unnest(range(len(m))) AS spot FROM (SELECT doc_id, regexp_extract_all(clean, '\b[a-z]{{3,}}{_BLANK}[a-z]{{3,}}\b') AS m FROM o)),
w AS (SELECT doc_id, 1 AS kind, unnest(m) AS term, unnest(range(len(m))) AS spot FROM (SELECT doc_id, regexp_extract_all(clean, '\b[a-z]{{4,}}\b') AS m FROM o)),
c AS (SELECT doc_id, kind, term, min(spot) AS spot, count(*) * CASE WHEN kind = 1 AND term IN (SELECT unnest({sql_list(R.KEYWORD_BOOST)})) THEN 3 ELSE 1 END AS n FROM (FROM p UNION ALL FROM w)
  WHERE len(list_filter(string_split(term, ' '), lambda x: list_contains({sql_list(R.KEYWORD_STOP)}, x))) = 0 GROUP BY doc_id, kind, term),
r AS MATERIALIZED (SELECT doc_id, kind, term, row_number() OVER (PARTITION BY doc_id, kind ORDER BY n DESC, spot) AS rank FROM c),
f(doc_id, n, chosen) AS (
  SELECT o.doc_id, 0::BIGINT, coalesce((SELECT list(r.term ORDER BY r.rank) FROM r WHERE r.doc_id = o.doc_id AND kind = 0 AND rank <= 3), []) FROM o
  UNION ALL
  SELECT f.doc_id, r.rank, CASE WHEN contains(array_to_string(chosen, ' '), r.term) THEN chosen ELSE list_append(chosen, r.term) END
  FROM f JOIN r ON r.doc_id = f.doc_id AND r.kind = 1 AND r.rank = f.n + 1 WHERE len(chosen) < 5),
e AS (SELECT doc_id, arg_max(chosen, n) AS chosen FROM f GROUP BY doc_id)
SELECT doc_id, array_to_string(CASE WHEN len(labels) >= 3 THEN labels[1:5] ELSE coalesce(chosen, []) END, '|') AS keywords FROM t LEFT JOIN e USING (doc_id)""")
def topic_keywords(spark: SparkSession, d: str) -> DataFrame:
    labels = F.when(F.coalesce("quality", F.lit(0)) == 1, F.array("lang", "source", F.concat(F.lit("topic "), (F.col("doc_id") % 7).cast("string")))).otherwise(F.array("lang"))
    rows = table(spark, d, "documents").select("doc_id", "lang", "source", "text").join(table(spark, d, "labels"), "doc_id", "left").withColumn("concepts", labels)
    return keywords.topic_keywords(rows, "doc_id", "text", "concepts").select("doc_id", F.array_join("topic_keywords", "|").alias("keywords"))


# --- what-if


GRID = [0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]
_WHATIF = f"""
k AS (SELECT question_id, difficulty_tier AS tier, wrong_letters, {sql_drawn("question_id", "'failed'")} < 10 AS failed FROM q),
u AS (SELECT question_id, letter, CASE WHEN {sql_drawn("question_id", "letter", "'class'")} < 30 THEN 'english_gap' ELSE 'clean' END AS class FROM (SELECT question_id, unnest(wrong_letters) AS letter FROM k)),
g AS (SELECT question_id, tier, failed, count(*) FILTER (class = 'english_gap') AS gaps FROM k JOIN u USING (question_id) GROUP BY ALL),
i AS (
  SELECT question_id, letter, tier, gaps, ['laterality', 'numeric_ratio', 'universal_quantifier'][h % 3 + 1] AS signature, h % 100 / 100.0 AS confidence FROM (
    SELECT u.question_id, u.letter, tier, gaps, {sql_drawn("u.question_id", "u.letter", "'scan'")} AS h FROM u JOIN g USING (question_id) WHERE class <> 'english_gap' AND NOT failed) WHERE h % 5 > 0),
th AS (SELECT unnest({GRID})::DOUBLE AS threshold),
z AS (SELECT threshold, question_id, any_value(tier) AS tier, any_value(gaps) AS gaps, count(*) AS n FROM th JOIN i ON confidence >= threshold GROUP BY threshold, question_id)"""


def _whatif(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = _chapter_questions(spark, d)
    told = rows.select("question_id", F.col("difficulty_tier").alias("tier"), (drawn(F.col("question_id"), "failed") < 10).alias("failed"))
    letters = _wrong_letters(rows)
    judged = letters.withColumn("class", F.when(drawn(F.col("question_id"), F.col("letter"), "class") < 30, "english_gap").otherwise("clean"))
    h = drawn(F.col("question_id"), F.col("letter"), "scan")
    names = F.array(*map(F.lit, ["laterality", "numeric_ratio", "universal_quantifier"]))
    signals = letters.select("question_id", "letter", F.element_at(names, h % 3 + 1).alias("signature"), F.when(h % 5 > 0, "override_to").otherwise("note").alias("verdict_action"), (h % 100 / 100).alias("confidence"))
    return whatif.override_simulation(told, judged, signals, GRID)


@query(f"""WITH {SQL_QUESTIONS}, {_WHATIF}, b AS (SELECT count(*) AS n, count(*) FILTER (gaps = 0) AS clean FROM g), y AS (SELECT threshold, sum(n) AS overrides, count(*) AS hit, count(*) FILTER (gaps = 0) AS newly FROM z GROUP BY threshold)
SELECT th.threshold, n AS n_questions, clean AS baseline_clean, coalesce(overrides, 0)::BIGINT AS overrides, coalesce(hit, 0) AS with_override, coalesce(newly, 0) AS newly_unclean, coalesce(hit - newly, 0) AS more_unclean, clean - coalesce(newly, 0) AS projected_clean,
  round(clean / n::DOUBLE * 100, 2) AS baseline_percent, round((clean - coalesce(newly, 0)) / n::DOUBLE * 100, 2) AS projected_percent FROM th LEFT JOIN y USING (threshold), b""")
def override_simulation(spark: SparkSession, d: str) -> DataFrame:
    return _whatif(spark, d)[0]


@query(f"""WITH {SQL_QUESTIONS}, {_WHATIF}, t AS (SELECT tier, count(*) FILTER (NOT failed) AS questions FROM k GROUP BY tier), y AS (SELECT threshold, tier, sum(n) AS overrides, count(*) AS hit FROM z GROUP BY ALL)
SELECT 'tier' AS axis, tier::VARCHAR AS value, threshold, questions, coalesce(overrides, 0)::BIGINT AS overrides, coalesce(hit, 0) AS with_override FROM t CROSS JOIN th LEFT JOIN y USING (tier, threshold)
UNION ALL SELECT 'signature', signature, threshold, NULL, count(*) FILTER (confidence >= threshold), NULL FROM i CROSS JOIN th WHERE signature IN (SELECT signature FROM i WHERE confidence >= {GRID[0]}) GROUP BY signature, threshold""")
def override_axes(spark: SparkSession, d: str) -> DataFrame:
    _, tiers, signatures = _whatif(spark, d)
    return tiers.select(F.lit("tier").alias("axis"), F.col("tier").cast("string").alias("value"), "threshold", "questions", "overrides", "with_override").unionByName(signatures.select(F.lit("signature").alias("axis"), F.col("signature").alias("value"), "threshold", "overrides"), allowMissingColumns=True)


# --- rescue


_RESCUE = f"""
tp AS (SELECT unnest(['en', 'en', 'en', 'en', 'de', 'de', 'fr']) AS domain, unnest([1, 1, 1, 1, 2, 2, 3]) AS tier, unnest(['e4', 'e1', 'e3', 'e2', 'd1', 'd2', 'f1']) AS template, unnest([4, 1, 3, 2, 5, 6, 7]) AS ord),
cd AS (SELECT domain, tier, template, row_number() OVER (PARTITION BY domain, tier ORDER BY ord) AS n FROM tp QUALIFY n <= 3),
a0 AS (SELECT question_id, doc_id, domain, difficulty_tier AS tier, stem, texts, explanations, list_filter(wrong_letters, lambda l: {sql_drawn("question_id", "l", "'gap'")} < 80) AS gaps FROM q),
tr AS (
  SELECT question_id, n, template, h < 50 OR h % 5 = 0 AS bad, CASE WHEN h < 50 OR h % 5 = 0 THEN NULL ELSE template || ': ' || stem END AS new_stem, h % 3 > 0 AS still FROM (
    SELECT question_id, stem, cd.n, template, {sql_drawn("question_id", "template", "'try'")} AS h FROM a0 JOIN cd USING (domain, tier) WHERE len(gaps) > 0)),
wn AS (SELECT question_id, min(n) FILTER (NOT bad AND NOT still) AS won, max(n) FILTER (NOT bad) AS last, count(*) AS n FROM tr GROUP BY question_id),
rs AS (
  SELECT a0.*, won, wn.n AS held, coalesce(w.new_stem, l.new_stem, stem) AS rescued, w.template AS template, {sql_drawn("a0.question_id", "'fallback'")} AS h FROM a0 LEFT JOIN wn USING (question_id)
  LEFT JOIN tr w ON w.question_id = a0.question_id AND w.n = won LEFT JOIN tr l ON l.question_id = a0.question_id AND l.n = wn.last),
rz AS (
  SELECT *, CASE WHEN len(gaps) = 0 THEN 'no_english_gap' WHEN held IS NULL THEN 'no_template_for_cell' WHEN won IS NOT NULL THEN 'rewrote_stem' WHEN h >= 60 THEN 'stem_then_distractor_fix' ELSE 'did_not_converge' END AS outcome, coalesce(won, held, 0) AS n_attempts FROM rs),
ro AS (
  SELECT question_id, doc_id AS chapter, outcome, template, n_attempts, rescued AS stem, round(n_attempts * 0.01 + CASE WHEN held IS NOT NULL AND won IS NULL AND h >= 60 THEN 0.02 ELSE 0 END, 4) AS cost,
    array_to_string(list_transform(texts, lambda t, i: CASE WHEN outcome = 'stem_then_distractor_fix' AND substring('ABCD', i, 1) = gaps[1] THEN 'Fixed ' || question_id ELSE t END), '|') AS texts FROM rz)"""


def _rescued(spark: SparkSession, d: str) -> DataFrame:
    rows = _chapter_questions(spark, d)
    templates = spark.sql("SELECT * FROM VALUES ('en', 1, 'e4', 4), ('en', 1, 'e1', 1), ('en', 1, 'e3', 3), ('en', 1, 'e2', 2), ('de', 2, 'd1', 5), ('de', 2, 'd2', 6), ('fr', 3, 'f1', 7) AS t(domain, difficulty_tier, template, ord)")
    gap = F.get(F.transform(F.filter("options", lambda o: ~o.is_correct & (drawn(F.col("question_id"), o.letter, "gap") < 80)), lambda o: o.letter), F.lit(0))
    asked = rescue.candidate_templates(rows.withColumn("gap_letter", gap), templates, ["domain", "difficulty_tier"])
    h = drawn(F.col("question_id"), F.col("template"), "try")
    bad = (h < 50) | (h % 5 == 0)
    attempts = asked.select("question_id", "question_stem", F.explode("candidates").alias("template")).select("question_id", "template", F.when(~bad | (h >= 50), F.when(~bad, F.concat("template", F.lit(": "), "question_stem"))).alias("stem"), F.when(h < 50, "api").alias("error"), (h % 3 > 0).alias("still_gap"), F.lit(0.01).alias("cost"))
    fallback = drawn(F.col("question_id"), "fallback") >= 60
    fixes = rows.where(fallback).select("question_id", F.concat(F.lit("Fixed "), "question_id").alias("text"), F.lit(None).cast("string").alias("explanation"), F.lit(0.02).alias("cost"))
    return rescue.rescue_stems(asked, attempts, fixes)


@query(f"WITH {SQL_QUESTIONS}, {_RESCUE} SELECT question_id, outcome, template, n_attempts::INTEGER AS n_attempts, stem, texts, cost FROM ro")
def rescued_stems(spark: SparkSession, d: str) -> DataFrame:
    return _rescued(spark, d).select("question_id", "outcome", "template", "n_attempts", F.col("question_stem").alias("stem"), F.array_join(F.transform("options", lambda o: o.text), "|").alias("texts"), "cost")


@query(f"WITH {SQL_QUESTIONS}, {_RESCUE} SELECT chapter, count(*) AS n_questions, count(*) FILTER (outcome = 'no_english_gap') AS no_english_gap, count(*) FILTER (outcome = 'no_template_for_cell') AS no_template_for_cell, count(*) FILTER (outcome = 'rewrote_stem') AS rewrote_stem, count(*) FILTER (outcome = 'stem_then_distractor_fix') AS stem_then_distractor_fix, count(*) FILTER (outcome = 'did_not_converge') AS did_not_converge, round(sum(cost), 4) AS cost FROM ro GROUP BY chapter")
def rescued_chapters(spark: SparkSession, d: str) -> DataFrame:
    return rescue.rescued_chapters(_rescued(spark, d))


# --- manifest

_COUNTED = ["n_soft", "schema_overrides", "gap_overrides", "scanner_flags", "scanner_disagreements", "editorial_clean", "editorial_minor", "editorial_major", "editorial_errors"]


def _sql_manifest() -> str:
    counts = ", ".join(f"CASE WHEN h_{c} % 5 = 0 THEN NULL ELSE h_{c} % 3 END AS {c}" for c in _COUNTED)
    hashes = ", ".join(f"{sql_drawn('doc_id', repr(c))} AS h_{c}" for c in _COUNTED)
    sums = []
    for column, total, chapters in passes.SUMMED:
        if column == "cross_model_disagreements":
            sums += [f"NULL::BIGINT AS {total}", f"NULL::BIGINT AS {chapters}"]
            continue
        sums.append(f"sum({column})::BIGINT AS {total}")
        if chapters:
            sums.append(f"count(*) FILTER ({column} > 0) AS {chapters}")
    return f"""WITH h AS (SELECT doc_id, n_chars, {hashes} FROM documents),
m AS (SELECT doc_id, ['ready', 'review', 'empty'][n_chars % 3 + 1] AS status, n_chars % 4 = 0 AS skipped, n_chars % 5 AS caught, n_chars % 2 AS remaining, n_chars % 7 AS fixes_applied, 1 AS fixes_failed, {counts}, 0.01 AS audit_usd, CASE WHEN n_chars % 2 = 0 THEN 0.005 END AS fix_usd, 0.25 AS editorial_usd FROM h)
SELECT count(*) AS chapters_total, count(*) FILTER (status = 'ready') AS chapters_ready, count(*) FILTER (status = 'review') AS chapters_review, count(*) FILTER (status = 'empty') AS chapters_empty, count(*) FILTER (skipped) AS chapters_skipped_unchanged,
  {", ".join(sums)}, round(sum(audit_usd + coalesce(fix_usd, 0) + editorial_usd)::DOUBLE, 4) AS total_cost_usd, round(sum(editorial_usd)::DOUBLE, 4) AS editorial_cost_usd FROM m"""


@query(_sql_manifest())
def manifest_sums(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_chars")
    counts = {c: F.when(drawn(F.col("doc_id"), c) % 5 > 0, drawn(F.col("doc_id"), c) % 3) for c in _COUNTED}
    status = F.element_at(F.array(*map(F.lit, ("ready", "review", "empty"))), (n % 3 + 1).cast("int"))
    manifest = table(spark, d, "documents").select("doc_id", "n_chars").withColumns(
        {"status": status, "skipped": n % 4 == 0, "caught": n % 5, "remaining": n % 2, "fixes_applied": n % 7, "fixes_failed": F.lit(1), "audit_usd": F.lit(0.01), "fix_usd": F.when(n % 2 == 0, 0.005), "editorial_usd": F.lit(0.25)} | counts
    )
    return passes.manifest_sums(manifest)
