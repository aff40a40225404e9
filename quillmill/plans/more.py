"""Queries of sources, sinks, streams, replay, policy and the Arrow text functions."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import functions as F

from quillmill.functions import attribution, refdata, udfs
from quillmill.functions import text as T
from quillmill.operators import corpus, planning, policy, publish, replay
from quillmill.plans.views import questions, sql_list, sql_set, sql_tokens, table
from quillmill.sources import files
from quillmill.streaming import events as streams

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def _folder(spark) -> str:
    """A folder for files that a query writes and reads: shared where the session names one,
    and only on one machine a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        return tempfile.mkdtemp(prefix="quillmill-")
    return f"{shared.rstrip('/')}/quillmill-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


# --- sources and sinks: what comes back from the files


@query("SELECT c_custkey::VARCHAR AS uid, c_name AS passage, c_mktsegment AS domain_code FROM customer")
def csv_round_trip(spark, d):
    path = _folder(spark)
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("uid"), F.col("c_name").alias("passage"), F.col("c_mktsegment").alias("domain_code"))
    files.write_csv(rows, f"{path}/passages", rows.columns)
    return files.scan_csv(spark, f"{path}/passages", files.PASSAGE, key="uid")


@query("SELECT event_id, event_type AS event, user_id FROM events WHERE event_type = 'error'")
def event_log_round_trip(spark, d):
    path = _folder(spark)
    log = table(spark, d, "events").select("event_id", F.col("event_type").alias("event"), "user_id")
    for half in (0, 1):
        files.append_events(log.where(F.col("event_id") % 2 == half), f"{path}/log")
    return files.scan_events(spark, f"{path}/log", log.schema, "error")


@query("SELECT c_mktsegment AS domain, count(*) AS n FROM customer GROUP BY 1")
def partitioned_round_trip(spark, d):
    path = _folder(spark)
    rows = table(spark, d, "customer").select(F.col("c_mktsegment").alias("domain"), "c_custkey")
    files.write_partitioned(rows, f"{path}/bundle", ["domain"])
    return spark.read.schema("c_custkey bigint, domain string").json(f"{path}/bundle").groupBy("domain").agg(F.count("*").alias("n"))


@query("SELECT 'part' AS source, (SELECT count(*) FROM part) AS n_source, (SELECT count(*) FROM supplier) AS n_target, (SELECT count(*) FROM part) - (SELECT count(*) FROM supplier) AS delta")
def sync_delta(spark, d):
    return files.sync_delta(table(spark, d, "part"), table(spark, d, "supplier")).select(F.lit("part").alias("source"), "n_source", "n_target", "delta")


@query("SELECT DISTINCT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def merged_checkpoint(spark, d):
    return files.merge_checkpoint(table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").select(F.col("c_custkey").alias("k")), "k")


# --- streams, run over what is there


@query("SELECT user_id, arg_max(event_type, event_id) AS event, max(event_id) AS event_id FROM events GROUP BY user_id")
def stream_latest_event(spark, d):
    path = _folder(spark)
    log = table(spark, d, "events").select("user_id", F.col("event_type").alias("event"), "event_id")
    for half in (0, 1):
        files.append_events(log.where(F.col("event_id") % 2 == half).coalesce(1), f"{path}/log")
    stream = streams.read_log(spark, f"{path}/log", log.schema, 1)
    streams.keep_latest(stream, ["user_id"], "event_id", f"{path}/table", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return streams.latest(spark, f"{path}/table", log.schema)


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_windowed_counts(spark, d):
    source = table(spark, d, "events")
    stream = spark.readStream.schema(source.schema).parquet(d.rstrip("/"), pathGlobFilter="events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    path, name = _folder(spark), f"w{abs(hash(d)) % 10**8}"
    counted = streams.windowed_counts(stream, "ts", ["event_type"])
    counted.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


# --- replay, policy and text functions


@query("SELECT event_id, event_type, json_extract_string(props, '$.k')::INTEGER AS k FROM events")
def replayed_answers(spark, d):
    log = table(spark, d, "events")
    answers = log.select("event_id", F.concat(F.lit("```json\n"), "props", F.lit("\n```")).alias("content"))
    return replay.replayed(log.select("event_id", "event_type"), answers, ["event_id"], "k int").select("event_id", "event_type", "answer.k")


@query()
def client_calls(spark, d):
    requests = table(spark, d, "benchmark").select("item_id", F.col("text").alias("prompt"))
    return replay.called(requests, _length_client).select("item_id", "content", "error")


def _length_client():
    return lambda prompt: str(len(prompt))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND doc_id % 4 + 1 = 3 THEN 'strict' WHEN doc_id % 2 = 1 AND doc_id % 4 + 1 IN (2, 4) THEN 'framework_aware' ELSE 'strict' END AS gate_action, [0.75, 0.75, 0.85, 0.95][doc_id % 4 + 1]::DOUBLE AS override_threshold FROM documents")
def policy_cells(spark, d):
    tier = (F.col("doc_id") % 4 + 1).cast("int")
    pattern = F.element_at(F.array(*map(F.lit, ("none", "comparison", "clinical_vignette", "best_answer"))), tier)
    rows = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "BPSY").otherwise("PETH").alias("domain"), tier.alias("tier"), F.lit("integrated").alias("source_type"), pattern.alias("stem_pattern"))
    return policy.resolve(spark, rows).select("doc_id", "gate_action", "override_threshold")


_NAMED = "n AS (SELECT doc_id, upper(left(x, 1)) || substr(x, 2) AS name FROM (SELECT doc_id, regexp_extract(lower(coalesce(text, '')), '([a-z]{3,})', 1) AS x FROM documents) WHERE x <> '')"
_TAIL = "{n} (1999) did. According to {n} it did. {n} et al. did. {n}'s theory did. see {n} and {n} found it. then {n} postulated it. Dr. {n} postulated it."


def _cited(spark, d):
    """Whole texts with citations of every kind behind them: documents cite nobody."""
    name = F.initcap(F.regexp_extract(F.lower(F.coalesce("text", F.lit(""))), "([a-z]{3,})", 1))
    rows = table(spark, d, "documents").select("doc_id", "text", name.alias("name")).where("name <> ''")
    return rows.select("doc_id", F.concat("text", F.lit(". "), F.replace(F.lit(_TAIL), F.lit("{n}"), F.col("name"))).alias("x"))


@query(f"WITH {_NAMED} SELECT doc_id, kind, CASE kind WHEN 'bare_multi' THEN name || ' and ' || name ELSE name END AS name FROM n, (SELECT unnest(['year', 'according_to', 'et_al', 'possessive', 'bare_multi', 'bare_single']) AS kind) WHERE kind NOT LIKE 'bare%' OR NOT list_contains({sql_list(refdata.NOT_NAMES)}, name)")
def attributions(spark, d):
    return _cited(spark, d).select("doc_id", F.explode(attribution.attributions(F.col("x"))).alias("a")).select("doc_id", "a.kind", "a.name")


@query(rf"WITH {_NAMED} SELECT doc_id, trim(regexp_replace(regexp_replace(text || '. ' || CASE WHEN name = 'The' THEN name ELSE '' END || ' did.', '^[\s:\-—,;]+', ''), '[ \t]{{2,}}', ' ', 'g')) AS text FROM n JOIN documents USING (doc_id)")
def stripped_citations(spark, d):
    rows = _cited(spark, d).select("doc_id", F.regexp_replace("x", r"(?s)(\(1999\) did\.).*$", "$1").alias("x"))
    return rows.select("doc_id", attribution.strip_citations(F.col("x"), ["The"]).alias("text"))


@query("SELECT event_id AS doc_id, props AS json FROM events")
def json_in_prose(spark, d):
    rows = table(spark, d, "events").select(F.col("event_id").alias("doc_id"), F.concat(F.lit('I think {"a": "}"} but then '), "props", F.lit(" is it {")).alias("x"))
    return rows.select("doc_id", udfs.extract_json()("x").alias("json"))


@query()
def match_distances(spark, d):
    rows = table(spark, d, "documents").select("doc_id", udfs.match_offsets(r"\bthe\b")("text").alias("a"), udfs.match_offsets(r"\bof\b")("text").alias("b"))
    return rows.select("doc_id", F.size("a").alias("n_a"), udfs.least_distance("a", "b").alias("distance"))


@query("WITH p AS (SELECT n_regionkey, list(CASE n_nationkey % 6 WHEN 0 THEN 'definitional' WHEN 1 THEN 'comparison' WHEN 2 THEN 'exception' WHEN 3 THEN 'clinical_application' WHEN 4 THEN 'neuroanatomical' ELSE 'mechanism' END ORDER BY n_nationkey) AS a FROM nation GROUP BY 1), s AS (SELECT n_regionkey, unnest(a) AS angle, generate_subscripts(a, 1) AS i FROM p), r AS (SELECT *, CASE angle WHEN 'clinical_application' THEN 3 WHEN 'neuroanatomical' THEN 3 WHEN 'mechanism' THEN 2 WHEN 'exception' THEN 2 WHEN 'comparison' THEN 1 ELSE 0 END AS f FROM s), o AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY f DESC, i) AS k FROM r) SELECT n_regionkey, angle FROM o WHERE k = 1")
def angle_selection(spark, d):
    kinds = ["definitional", "comparison", "exception", "clinical_application", "neuroanatomical", "mechanism"]
    angle = F.element_at(F.array(*map(F.lit, kinds)), (F.col("n_nationkey") % 6 + 1).cast("int"))
    pools = table(spark, d, "nation").groupBy("n_regionkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", angle.alias("angle")))), lambda x: x.angle).alias("pool"))
    return pools.select("n_regionkey", planning.angle_for(F.col("pool"), 3, F.lit(1)).alias("angle"))


@query(f"WITH w AS (SELECT item_id, {sql_tokens('text', 6, refdata.BASE_STOP)} AS w FROM benchmark), x AS (SELECT item_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM w), u AS (SELECT item_id, t, min(i) AS i FROM x GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY length(t) DESC, i) AS k FROM u) SELECT item_id, string_agg(t, ',' ORDER BY k) AS terms FROM r WHERE k <= 4 GROUP BY item_id")
def longest_terms(spark, d):
    rows = table(spark, d, "benchmark").select("item_id", T.token_set(F.col("text"), 6, refdata.BASE_STOP).alias("w")).where(F.size("w") > 0)
    return rows.select("item_id", F.array_join(T.sorted_by_length(F.col("w"), 4), ",").alias("terms"))


@query("WITH p AS (SELECT n_regionkey, list(n_name ORDER BY n_nationkey) AS pool FROM nation GROUP BY 1), v AS (SELECT *, unnest(range(1, 6))::INTEGER AS variant FROM p), x AS (SELECT *, ((variant - 1) * 4 + 3) % len(pool) AS f FROM v), y AS (SELECT *, (f + 1 + variant - 1) % len(pool) AS s0 FROM x) SELECT n_regionkey, variant, pool[f + 1] || '+' || pool[CASE WHEN s0 = f THEN (s0 + 1) % len(pool) ELSE s0 END + 1] AS pair FROM y")
def integration_pairs(spark, d):
    pools = table(spark, d, "nation").groupBy("n_regionkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x.n_name).alias("pool"))
    rows = pools.withColumn("variant", F.explode(F.sequence(F.lit(1), F.lit(5))))
    return rows.select("n_regionkey", "variant", F.array_join(planning.integration_pair(F.col("pool"), F.col("variant"), F.lit(4)), "+").alias("pair"))


@query("WITH o AS (SELECT o_custkey, list(DISTINCT o_orderpriority) AS own FROM orders GROUP BY 1) SELECT o_custkey, len(list_filter(['1-URGENT', '9-NEVER'], lambda x: NOT list_contains(own, x)))::BIGINT AS unused, len(list_filter(own, lambda x: x <> '1-URGENT'))::BIGINT AS unknown FROM o")
def orphan_references(spark, d):
    own = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("own"))
    o = corpus.orphans(F.array(F.lit("1-URGENT"), F.lit("9-NEVER")), F.array("own"))
    return own.select("o_custkey", F.size(o.unused).cast("long").alias("unused"), F.size(o.unknown).cast("long").alias("unknown"))


@query(f"SELECT doc_id, len(list_intersect({sql_set('text', 4)}, {sql_list(['that', 'with', 'para', 'dans', 'nicht'])})) > 0 AS member FROM documents")
def membership_filter(spark, d):
    wanted = F.array(*map(F.lit, ["that", "with", "para", "dans", "nicht"]))
    return table(spark, d, "documents").select("doc_id", F.arrays_overlap(T.token_set(F.col("text"), 4), wanted).alias("member"))


@query()
def brief_validation(spark, d):
    rows = questions(spark, d).select("question_id", F.transform("options", lambda o: o.text).alias("core_claims"), F.transform("options", lambda o: F.struct(o.letter.alias("concept_id"), o.text.alias("label"))).alias("concepts"), F.transform("options", lambda o: F.struct(F.lit("mix").alias("type"), F.array(o.letter).alias("concepts_involved"))).alias("misconceptions"), F.transform("options", lambda o: o.letter).alias("question_angles"))
    return rows.select("question_id", publish.brief_failure().alias("reason"))
