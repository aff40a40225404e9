"""Relational queries: scans, joins, aggregations, windows, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillmill.functions import refdata as R
from quillmill.functions import text as T
from quillmill.operators import corpus as C
from quillmill.operators import ordinals
from quillmill.operators import planning as P
from quillmill.plans.views import sql_jaccard, sql_list, sql_set, sql_tokens, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def _cells(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return docs.select((F.pmod("doc_id", F.lit(4)) + 1).cast("int").alias("tier"), C.sentinel("lang").alias("domain"), C.sentinel("source").alias("source_type"), F.coalesce(F.col("quality").cast("string"), F.lit("unknown")).alias("stem_pattern"))


SQL_CELLS = "c AS (SELECT (doc_id % 4 + 1)::INTEGER AS tier, coalesce(nullif(lang, ''), 'unknown') AS domain, coalesce(nullif(source, ''), 'unknown') AS source_type, coalesce(quality::VARCHAR, 'unknown') AS stem_pattern FROM documents LEFT JOIN labels USING (doc_id))"
KEYS = ["tier", "domain", "source_type", "stem_pattern"]


@query(f"WITH {SQL_CELLS} SELECT tier, domain, source_type, stem_pattern, count(*) AS n FROM c GROUP BY ALL")
def cell_distribution(spark, d):
    return C.distribution(_cells(spark, d), KEYS)


@query(f"WITH {SQL_CELLS}, n AS (SELECT tier, domain, count(*) AS n FROM c GROUP BY ALL) SELECT 'tier' AS axis, tier::VARCHAR AS value, sum(n)::BIGINT AS n FROM n GROUP BY tier UNION ALL SELECT 'domain', domain, sum(n)::BIGINT FROM n GROUP BY domain")
def marginals(spark, d):
    return C.marginals(C.distribution(_cells(spark, d), ["tier", "domain"]), ["tier", "domain"])


@query(f"WITH {SQL_CELLS} SELECT tier, domain, count(DISTINCT (source_type, stem_pattern)) AS cells FROM c GROUP BY ALL")
def distinct_cells(spark, d):
    return _cells(spark, d).groupBy("tier", "domain").agg(F.count_distinct(F.struct("source_type", "stem_pattern")).alias("cells"))


@query(f"WITH {SQL_CELLS}, n AS (SELECT tier, domain, source_type, stem_pattern, count(*) AS n FROM c GROUP BY ALL) SELECT * FROM n ORDER BY n DESC, tier, domain, source_type, stem_pattern LIMIT 20")
def top20_cells(spark, d):
    return C.top_cells(C.distribution(_cells(spark, d), KEYS), 20, KEYS)


@query("SELECT lang, count(*) AS total, count(DISTINCT source) AS chapters, count(*) FILTER (WHERE doc_id % 4 = 0) AS t1, count(*) FILTER (WHERE doc_id % 4 = 1) AS t2, count(*) FILTER (WHERE doc_id % 4 = 2) AS t3, count(*) FILTER (WHERE doc_id % 4 = 3) AS t4 FROM documents GROUP BY lang")
def domain_stats_pivot(spark, d):
    tiers = [F.count_if(F.pmod("doc_id", F.lit(4)) == i).alias(f"t{i + 1}") for i in range(4)]
    return table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("total"), F.count_distinct("source").alias("chapters"), *tiers)


@query("SELECT event_type, json_extract_string(props, '$.k')::INTEGER % 6 AS kind, count(*) AS n FROM events GROUP BY ALL")
def misc_distribution(spark, d):
    return C.distribution(table(spark, d, "events").select("event_type", (F.get_json_object("props", "$.k").cast("int") % 6).alias("kind")), ["event_type", "kind"])


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity)::BIGINT AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY ALL")
def revenue_rollup(spark, d):
    t = table(spark, d, "lineitem")
    return t.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("long").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


# --- joins


@query("SELECT doc_id, source, coalesce(quality, -1) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def left_lookup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", "source", F.coalesce("quality", F.lit(-1)).alias("quality"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT item_id FROM benchmark)")
def anti_existing(spark, d):
    return P.remaining(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id")), on="doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_allowlist(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi")


@query("SELECT doc_id AS k, 'old' AS origin FROM labels UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def upsert_append(spark, d):
    old = table(spark, d, "labels").select(F.col("doc_id").alias("k"), F.lit("old").alias("origin"))
    return P.upsert(old, table(spark, d, "documents").select(F.col("doc_id").alias("k"), F.lit("new").alias("origin")), "k")


@query("SELECT s_suppkey, tier, variant FROM supplier, (SELECT unnest([3, 2, 1, 4]) AS tier), (SELECT unnest(range(1, 4))::INTEGER AS variant)")
def task_grid(spark, d):
    return P.task_grid(table(spark, d, "supplier").select("s_suppkey"), 3)


PREFIXES = {"Brand#": "generic", "Brand#1": "mechanism", "Brand#12": "framework", "Brand#2": "statistical"}


@query("SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#12%' THEN 'framework' WHEN p_brand LIKE 'Brand#1%' THEN 'mechanism' WHEN p_brand LIKE 'Brand#2%' THEN 'statistical' WHEN p_brand LIKE 'Brand#%' THEN 'generic' ELSE 'other' END AS flavor FROM part")
def longest_prefix(spark, d):
    parts = table(spark, d, "part")
    return parts.select("p_partkey", P.longest_prefix(parts, "p_brand", PREFIXES, F.lit("other")).alias("flavor"))


@query("SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def dimension_chain(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    joined = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("c_custkey", "n_name", "r_name")


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')")
def contains_filter(spark, d):
    return table(spark, d, "part").where(F.contains(F.lower("p_name"), F.lit("ring"))).select("p_partkey", "p_name")


@query("""WITH s AS (SELECT s_suppkey AS id, s_nationkey AS near, n_regionkey AS g, s_suppkey % 7 AS seed, list_distinct(string_split(lower(n_name), ' ')) AS terms, list_distinct([left(n_name, 1), right(n_name, 1), left(n_name, 2)]) AS t FROM supplier JOIN nation ON n_nationkey = s_nationkey),
p AS (SELECT a.id AS "primary", b.id AS sibling, a.seed, CASE WHEN a.near = b.near THEN 1 WHEN 1 - len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t)))::DOUBLE >= 0.5 THEN 2 ELSE 3 END AS tier FROM s a JOIN s b ON a.g = b.g AND a.id <> b.id),
o AS (SELECT *, row_number() OVER (PARTITION BY "primary", tier ORDER BY sibling) - 1 AS pos, count(*) OVER (PARTITION BY "primary", tier) AS n FROM p),
r AS (SELECT *, (((pos - seed) % n) + n) % n AS turn FROM o),
k AS (SELECT "primary", sibling, tier, (row_number() OVER (PARTITION BY "primary" ORDER BY tier, turn) - 1)::INTEGER AS rank FROM r)
SELECT * FROM k WHERE rank < 3""")
def sibling_cluster(spark, d):
    rows = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_nationkey", "n_regionkey", "n_name")
    return P.siblings(rows, "s_suppkey", "n_regionkey", "s_nationkey", 3, F.col("s_suppkey") % 7, F.array(F.left("n_name", F.lit(1)), F.right("n_name", F.lit(1)), F.left("n_name", F.lit(2))))


# --- event log


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events WHERE event_type <> 'view' GROUP BY user_id")
def latest_event(spark, d):
    log = table(spark, d, "events").where("event_type <> 'view'").select("user_id", "event_id", "event_type")
    return C.last_event(log, ["user_id"], "event_id").select("user_id", "event_type", "event_id")


@query("SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events WHERE json_extract_string(props, '$.k')::INTEGER > 50")
def event_json_payload(spark, d):
    rows = table(spark, d, "events").select("event_id", F.from_json("props", "k int").k.alias("k"))
    return rows.where("k > 50")


@query("SELECT event_type, count(*) FILTER (WHERE value > 10) AS ok, count(*) AS total, round(sum(value), 2) AS cost FROM events GROUP BY event_type")
def rescue_by_type(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 10).alias("ok"), F.count("*").alias("total"), F.round(F.sum("value"), 2).alias("cost"))


@query("SELECT event_type, list_transform(list_slice(list(event_id ORDER BY event_id), 1, 3), lambda x: x::VARCHAR).array_to_string(',') AS examples FROM events GROUP BY event_type")
def first3_examples(spark, d):
    found = C.first_examples(table(spark, d, "events"), ["event_type"], "event_id", "event_id", 3)
    return found.select("event_type", F.array_join(F.transform("examples", lambda x: x.cast("string")), ",").alias("examples"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def hourly_events(spark, d):
    w = table(spark, d, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n")


@query("SELECT event_id, CASE WHEN regexp_extract(r, '^([\\w_]+):', 1) = '' THEN 'unknown' ELSE regexp_extract(r, '^([\\w_]+):', 1) END AS gate FROM (SELECT event_id, CASE WHEN value > 5 THEN event_type || ': low' ELSE 'no reason' END AS r FROM events)".replace("\\\\", "\\"))
def gate_from_reason(spark, d):
    rows = table(spark, d, "events").select("event_id", F.when(F.col("value") > 5, F.concat("event_type", F.lit(": low"))).otherwise("no reason").alias("r"))
    return rows.select("event_id", T.gate_of_reason(F.col("r")).alias("gate"))


@query("SELECT event_id, floor((event_id) / 1000)::BIGINT AS chunk FROM events")
def batch_chunks(spark, d):
    return table(spark, d, "events").select("event_id", P.chunk_of(F.col("event_id"), 1000).alias("chunk"))


# --- text and sets


@query(f"SELECT doc_id, len({sql_tokens('text', 4, R.FULL_STOP)})::BIGINT AS n4, len({sql_set('text', 6, R.FULL_STOP)})::BIGINT AS d6 FROM documents")
def tokens_k(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(T.tokens(F.col("text"), 4, R.FULL_STOP)).cast("long").alias("n4"), F.size(T.token_set(F.col("text"), 6, R.FULL_STOP)).cast("long").alias("d6"))


@query(r"SELECT item_id, substring(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60) AS slug, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS label FROM benchmark")
def slugify(spark, d):
    return table(spark, d, "benchmark").select("item_id", T.slugify(F.col("text")).alias("slug"), T.normalise_label(F.col("text")).alias("label"))


@query("SELECT a.item_id AS a, b.item_id AS b, round(" + sql_jaccard(sql_set("a.text"), sql_set("b.text")) + ", 6) AS jaccard FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1")
def jaccard_pairs(spark, d):
    t = table(spark, d, "benchmark")
    a, b = t.select(F.col("item_id").alias("a"), T.token_set(F.col("text")).alias("sa")), t.select(F.col("item_id").alias("b"), T.token_set(F.col("text")).alias("sb"))
    return a.join(b, F.col("b") == F.col("a") + 1).select("a", "b", F.round(T.jaccard(F.col("sa"), F.col("sb")), 6).alias("jaccard"))


@query(f"SELECT item_id, len(list_filter({sql_set('text', 1)}, lambda w: NOT list_contains({sql_list(R.LIGHT_STOP)}, w)))::BIGINT AS kept, len(list_intersect({sql_set('text', 1)}, {sql_list(R.LIGHT_STOP)}))::BIGINT AS stopped FROM benchmark")
def stopword_sets(spark, d):
    words, stop = T.token_set(F.col("text"), 1), T.words_array(R.LIGHT_STOP)
    return table(spark, d, "benchmark").select("item_id", F.size(F.array_except(words, stop)).cast("long").alias("kept"), F.size(F.array_intersect(words, stop)).cast("long").alias("stopped"))


@query(f"SELECT term, count(*) AS df FROM (SELECT unnest({sql_set('text', 6, R.BASE_STOP)}) AS term FROM documents) GROUP BY term")
def document_frequency(spark, d):
    return C.document_frequency(table(spark, d, "documents"), "text")


@query(f"WITH w AS (SELECT doc_id, {sql_tokens('text', 4)} AS w FROM documents), b AS (SELECT unnest(list_transform(range(0, len(w) // 2), lambda i: w[2 * i + 1] || ' ' || w[2 * i + 2])) AS bigram FROM w) SELECT bigram, count(*) AS n FROM b GROUP BY bigram HAVING count(*) >= 3")
def bigram_freq(spark, d):
    pairs = table(spark, d, "documents").select(T.tokens(F.col("text"), 4).alias("w")).where(F.size("w") >= 2).select(F.explode(C.bigrams(F.col("w"))).alias("bigram"))
    return pairs.groupBy("bigram").agg(F.count("*").alias("n")).where("n >= 3")


@query(r"""WITH t AS (SELECT p_partkey, split_part(p_name, ' ', 1) || ' vs ' || split_part(p_name, ' ', 2) || ' and between ' || lower(p_type) || ' and ' || split_part(p_name, ' ', 2) AS x FROM part),
m AS (SELECT 'v' AS pattern, unnest(regexp_extract_all(x, '(?i)\b([a-z][a-z0-9_-]+)\s+vs\.?\s+([a-z][a-z0-9_-]+)\b', 1)) AS a, unnest(regexp_extract_all(x, '(?i)\b([a-z][a-z0-9_-]+)\s+vs\.?\s+([a-z][a-z0-9_-]+)\b', 2)) AS b FROM t
UNION ALL SELECT 'b', unnest(regexp_extract_all(x, '(?i)\bbetween\s+([a-z][a-z0-9_-]+)\s+and\s+([a-z][a-z0-9_-]+)\b', 1)), unnest(regexp_extract_all(x, '(?i)\bbetween\s+([a-z][a-z0-9_-]+)\s+and\s+([a-z][a-z0-9_-]+)\b', 2)) FROM t)
SELECT least(lower(a), lower(b)) AS a, greatest(lower(a), lower(b)) AS b, count(*) AS n, count(DISTINCT pattern) AS patterns FROM m WHERE lower(m.a) <> lower(m.b) GROUP BY least(lower(m.a), lower(m.b)), greatest(lower(m.a), lower(m.b)) HAVING count(*) >= 3""")
def pair_mining(spark, d):
    name = F.split("p_name", " ")
    rows = table(spark, d, "part").select(F.concat(name[0], F.lit(" vs "), name[1], F.lit(" and between "), F.lower("p_type"), F.lit(" and "), name[1]).alias("x"))
    return C.mined_pairs(rows, "x")


@query("SELECT p_brand, count(*) AS n, count(DISTINCT p_type) AS buckets, count(DISTINCT p_size % 5) AS kinds FROM part GROUP BY p_brand")
def name_pivot(spark, d):
    return C.name_sweep(table(spark, d, "part").withColumn("kind", F.col("p_size") % 5), "p_brand", "p_type", "kind")


@query(r"""WITH f AS (SELECT p_partkey % 500 AS id, arg_min(p_name, p_partkey) AS label, min(p_partkey) AS first_ord FROM part GROUP BY p_partkey % 500),
k AS (SELECT *, trim(regexp_replace(regexp_replace(lower(label), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS key FROM f)
SELECT id, label, first_ord, first_value(id) OVER (PARTITION BY key ORDER BY first_ord) AS canonical_id, first_value(id) OVER (PARTITION BY key ORDER BY first_ord) = id AS is_new FROM k""")
def first_seen_canonical(spark, d):
    rows = table(spark, d, "part").select((F.col("p_partkey") % 500).alias("id"), F.col("p_name").alias("label_in"), "p_partkey")
    return C.first_seen(rows, "id", "label_in", "p_partkey")


@query("WITH s AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS a FROM supplier), g AS (SELECT s_suppkey, a, unnest([1, 2, 3, 4]) AS tier FROM s), v AS (SELECT *, unnest(range(1, 6)) AS variant FROM g) SELECT s_suppkey, tier, variant::INTEGER AS variant, substring('BCADCADBCADACBDCBDAB', ((a * 20 + (tier - 1) * 5 + variant - 1) % 20 + 1)::INTEGER, 1) AS letter FROM v")
def position_cycle(spark, d):
    s = ordinals.with_ordinal(table(spark, d, "supplier").select("s_suppkey"), "s_suppkey", name="a")
    return P.task_grid(s, 5).select("s_suppkey", "tier", "variant", P.answer_position(F.col("a"), F.col("tier"), F.col("variant")).alias("letter"))


@query("WITH n AS (SELECT n_regionkey, list(n_name ORDER BY n_nationkey) AS pool FROM nation GROUP BY 1), g AS (SELECT *, unnest([1, 2, 3, 4]) AS tier FROM n), v AS (SELECT *, unnest(range(1, 6))::INTEGER AS variant FROM g) SELECT n_regionkey, tier, variant, pool[((variant - 1) * 4 + tier - 1) % len(pool) + 1] AS concept, pool[(variant - 1) % len(pool) + 1] AS verb FROM v")
def rotation_pick(spark, d):
    pools = table(spark, d, "nation").groupBy("n_regionkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x.n_name).alias("pool"))
    return P.task_grid(pools, 5).select("n_regionkey", "tier", "variant", P.rotated(F.col("pool"), F.col("variant"), F.col("tier")).alias("concept"), P.rotated(F.col("pool"), F.col("variant")).alias("verb"))


_G = f"""
d AS (SELECT doc_id, {sql_tokens('text', 1, R.LIGHT_STOP)} AS w FROM documents), i AS (SELECT item_id, {sql_tokens('text', 1, R.LIGHT_STOP)} AS w FROM benchmark),
dg AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')))) AS g FROM d WHERE len(w) >= 5),
ig0 AS (SELECT item_id, list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) AS gs FROM i WHERE len(w) >= 5),
ig AS (SELECT item_id, len(gs) AS size, unnest(gs) AS g FROM ig0)"""


@query(f"WITH {_G} SELECT doc_id, item_id, count(*) AS shared, round(count(*) / any_value(size)::DOUBLE, 6) AS share FROM dg JOIN ig USING (g) GROUP BY doc_id, item_id")
def ngram_overlap_benchmark(spark, d):
    return C.ngram_overlap(table(spark, d, "documents"), table(spark, d, "benchmark")).withColumn("share", F.round("share", 6))


_CLASSES = f"""WITH s AS (SELECT p_partkey AS id, list_sort(list_distinct(list_filter(string_split(lower(replace(p_name, ' ', '-')), '-'), lambda t: length(t) >= 3))) AS slug, list_sort({sql_set('p_name', 3)}) AS label, list_sort({sql_set('p_type', 4)}) AS description FROM part),
c AS (SELECT slug, label, description, min(id) AS class, count(*) AS n FROM s GROUP BY ALL), m AS (SELECT id, class FROM s JOIN c USING (slug, label, description)),
p AS (SELECT a.class AS class_a, b.class AS class_b, a.n AS n_a, b.n AS n_b, 0.5::DOUBLE * {sql_jaccard('a.slug', 'b.slug')} + 0.3::DOUBLE * {sql_jaccard('a.label', 'b.label')} + 0.2::DOUBLE * {sql_jaccard('a.description', 'b.description')} AS score FROM c a JOIN c b ON a.class < b.class OR (a.class = b.class AND a.n > 1))"""


def _part_sets(spark, d):
    return table(spark, d, "part"), "p_partkey", T.slug_tokens(F.replace("p_name", F.lit(" "), F.lit("-"))), T.token_set(F.col("p_name"), 3), T.token_set(F.col("p_type"), 4)


@query(f"{_CLASSES} SELECT least(x.id, y.id) AS a, greatest(x.id, y.id) AS b, round(score, 3) AS score FROM p JOIN m x ON x.class = class_a JOIN m y ON y.class = class_b WHERE score >= 0.7 - 1e-12 AND (class_a < class_b OR x.id < y.id)")
def merge_candidates(spark, d):
    return C.similar_pairs(*_part_sets(spark, d))


@query(f"{_CLASSES} SELECT class_a, class_b, n_a, n_b, round(score, 3) AS score FROM p WHERE score >= 0.7 - 1e-12")
def merge_classes(spark, d):
    """Pairs of classes of equal parts, with their sizes: what merge_candidates tells, without its square."""
    classes, _ = C.similarity_classes(*_part_sets(spark, d))
    size = lambda p: classes.select(F.col("class").alias(f"class_{p}"), F.col("n").alias(f"n_{p}"))
    return C.similar_classes(classes).join(size("a"), "class_a").join(size("b"), "class_b").select("class_a", "class_b", "n_a", "n_b", "score")


@query(f"{_CLASSES} SELECT id, class FROM m")
def merge_members(spark, d):
    return C.similarity_classes(*_part_sets(spark, d))[1]


@query(f"SELECT doc_id, round(CASE WHEN len(k) = 0 THEN 1.0 ELSE len(list_filter(k, lambda w: contains(low, w))) / len(k)::DOUBLE END, 6) AS coverage FROM (SELECT d.doc_id, lower(d.text) AS low, {sql_set('b.text', 4, R.GROUNDING_STOP)} AS k FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % 40)")
def grounding_coverage(spark, d):
    items = table(spark, d, "benchmark").select("item_id", T.token_set(F.col("text"), 4, R.GROUNDING_STOP).alias("k"))
    docs = table(spark, d, "documents").select("doc_id", F.lower("text").alias("low"), (F.col("doc_id") % 40).alias("item_id"))
    return docs.join(items, "item_id").select("doc_id", F.round(T.coverage(F.col("k"), F.col("low")), 6).alias("coverage"))


@query("SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean, median(c_acctbal) AS median, max(c_acctbal) AS most, count(*) FILTER (WHERE c_acctbal > 5000) AS over FROM customer GROUP BY c_mktsegment")
def median_stats(spark, d):
    return table(spark, d, "customer").groupBy("c_mktsegment").agg(F.round(F.avg("c_acctbal"), 4).alias("mean"), F.median("c_acctbal").alias("median"), F.max("c_acctbal").alias("most"), F.count_if(F.col("c_acctbal") > 5000).alias("over"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderpriority LIKE '1%' THEN 1 WHEN o_orderpriority LIKE '2%' THEN 2 END ORDER BY o_orderkey) AS n, CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderpriority LIKE '1%' THEN 1 WHEN o_orderpriority LIKE '2%' THEN 2 END AS stratum FROM orders) SELECT o_orderkey, stratum FROM r WHERE (stratum = 0 AND n <= 4) OR (stratum = 1 AND n <= 8) OR (stratum = 2 AND n <= 10)")
def quota_sample(spark, d):
    rules = [(F.col("o_orderstatus") == "F", 4), (F.col("o_orderpriority").startswith("1"), 8), (F.col("o_orderpriority").startswith("2"), 10)]
    return C.stratified_sample(table(spark, d, "orders"), "o_orderkey", rules, "o_orderkey").select("o_orderkey", "stratum")


@query("SELECT doc_id, sha256(doc_id::VARCHAR)[1:8] AS prefix, ('0x' || sha256(doc_id::VARCHAR)[1:4])::INTEGER % 12 AS slot FROM documents".replace("('0x' || sha256(doc_id::VARCHAR)[1:4])::INTEGER", "(16 * (16 * (16 * (instr('0123456789abcdef', sha256(doc_id::VARCHAR)[1]) - 1) + instr('0123456789abcdef', sha256(doc_id::VARCHAR)[2]) - 1) + instr('0123456789abcdef', sha256(doc_id::VARCHAR)[3]) - 1) + instr('0123456789abcdef', sha256(doc_id::VARCHAR)[4]) - 1)"))
def sha_bucket(spark, d):
    key = F.col("doc_id").cast("string")
    return table(spark, d, "documents").select("doc_id", F.substring(F.sha2(key.cast("binary"), 256), 1, 8).alias("prefix"), T.hash_slot(key, 1, 4, 12).alias("slot"))


@query()
def name_uuids(spark, d):
    return table(spark, d, "documents").select("doc_id", T.name_uuid(F.concat_ws(":", "lang", F.col("doc_id").cast("string"))).alias("uuid"))


@query("SELECT n_regionkey, array_to_string(list_slice(list_sort(list(n_name)), 1, 3), ',') AS names FROM nation GROUP BY 1")
def capped_samples(spark, d):
    return table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.slice(F.array_sort(F.collect_list("n_name")), 1, 3), ",").alias("names"))


@query("WITH n AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) SELECT *, rank() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, o_orderstatus) AS rank FROM n")
def ranked_counts(spark, d):
    n = C.distribution(table(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"])
    return n.withColumn("rank", F.rank().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("n"), "o_orderstatus")))


@query("SELECT user_id, round(sum(u.tin * p.price_in + u.tout * p.price_out) / 1e6, 4) AS usd FROM (SELECT user_id, event_type AS model, event_id AS tin, event_id * 2 AS tout FROM events) u JOIN (SELECT 'click' AS model, 3.0 AS price_in, 15.0 AS price_out UNION ALL SELECT 'error', 1.0, 5.0) p USING (model) GROUP BY user_id")
def cost_model(spark, d):
    prices = spark.sql("SELECT * FROM VALUES ('click', 3.0D, 15.0D), ('error', 1.0D, 5.0D) AS t(model, price_in, price_out)")
    usage = table(spark, d, "events").select("user_id", F.col("event_type").alias("model"), F.col("event_id").alias("tin"), (F.col("event_id") * 2).alias("tout"))
    return usage.join(F.broadcast(prices), "model").groupBy("user_id").agg(F.round(F.sum(F.col("tin") * F.col("price_in") + F.col("tout") * F.col("price_out")) / 1e6, 4).alias("usd"))
