"""The registered queries of operators 11 to 13, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.codes import codebooks_digest, compress
from quillmill.llm.lines import LOWER, UPPER, apply_bitmaps, keep_bitmaps
from quillmill.llm.repair import DELETE, INSERT, REROLE, TRUNCATED, damage, repair_conversations


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    damaged = damage(turns)
    span = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    gaps = damaged.groupBy(F.col("conv_id").alias("g_id")).agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    pieces = repair_conversations(damaged)
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("part", c))), lambda x: x[c])
    written = F.transform(F.flatten(in_order("repaired")), lambda r: F.concat(r.role, F.lit(":"), r.text))
    whole = pieces.groupBy(F.col("conv_id").alias("w_id")).agg(*(F.sum(c).alias(c) for c in counts), F.array_join(in_order("audit"), "").alias("audit"), F.array_join(written, "\n").alias("text"))
    known = turns.select("conv_id").distinct()
    told = known.join(gaps, F.col("conv_id").eqNullSafe(F.col("g_id")), "left").join(whole, F.col("conv_id").eqNullSafe(F.col("w_id")), "left")
    return told.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ["gaps", *counts]), F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("repaired_sha256"),
    )


def _add(path: str, cost: str | int, letter: str) -> str:
    """A path is nine digits of cost and its letters, so the least string is the least cost and then the least letters."""
    return f"(lpad((left({path}, 9)::INTEGER + {cost})::VARCHAR, 9, '0') || substr({path}, 10) || '{letter}')"


#: Paths forwards, one row for each conversation and turn; the columns are the four states.
OP11_SQL = rf"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
s AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations),
k AS (SELECT s.*, xor(list_reduce(list_transform(string_split(place, ''), lambda x: ascii(x)::BIGINT), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind FROM s, crc),
d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM k WHERE kind <> 0),
r AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
    trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM d),
f AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS nth, bare = '' AS blank, bare <> '' AND nth > 1 AS duplicate, bare <> '' AND nth = 1 AND NOT regexp_matches(bare, '[.!?]$') AS truncated,
    coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial NOT IN ('su', 'ua', 'au'), FALSE) AS illegal FROM r),
p(conv_id, n, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, '000000000', NULL::VARCHAR, '{INSERT:09d}I', '{2 * INSERT:09d}II' FROM f
  UNION ALL
  SELECT conv_id, n, s0, s1, z2, least(y3, {_add("z2", INSERT, "I")}) FROM (
    SELECT *, least(y2, {_add("s0", INSERT, "I")}, {_add("s1", INSERT, "I")}, {_add("y3", INSERT, "I")}) AS z2 FROM (
      SELECT conv_id, n,
        {_add("s0", DELETE, "D")} AS s0,
        least({_add("s1", DELETE, "D")}, CASE WHEN stays AND initial = 's' THEN {_add("s0", "more", "K")} END) AS s1,
        least({_add("s2", DELETE, "D")}, CASE WHEN stays THEN {_add("before", f"more + {REROLE}", "R")} END, CASE WHEN stays AND initial = 'u' THEN {_add("before", "more", "K")} END) AS y2,
        least({_add("s3", DELETE, "D")}, CASE WHEN stays THEN {_add("s2", f"more + {REROLE}", "R")} END, CASE WHEN stays AND initial = 'a' THEN {_add("s2", "more", "K")} END) AS y3
      FROM (
        SELECT p.conv_id, f.n, s0, s1, s2, s3, least(s0, s1, s3) AS before, initial, NOT blank AND NOT duplicate AS stays, CASE WHEN truncated THEN {TRUNCATED} ELSE 0 END AS more
        FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.n + 1)))),
e AS (SELECT conv_id, left(best, 9)::BIGINT AS cost, substr(best, 10) AS audit FROM (SELECT conv_id, least(s0, s3) AS best FROM p QUALIFY n = max(n) OVER (PARTITION BY conv_id))),
l AS (SELECT conv_id, unnest(range(1, len(audit) + 1)) AS spot, audit[spot] AS letter FROM e),
m AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS n, count(*) FILTER (letter <> 'D') OVER w AS place FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY spot)),
o AS (
  SELECT m.*, f.role, f.text, max(CASE WHEN place = 1 AND letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY m.conv_id) AS lead
  FROM m LEFT JOIN f ON letter <> 'I' AND f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.n = m.n),
x AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY spot) AS text
  FROM o WHERE letter <> 'D' GROUP BY conv_id),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(truncated) AS truncated, count_if(illegal) AS illegal
  FROM f GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(x.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = apply_bitmaps(docs, keep_bitmaps(docs, least_docs=10, least_chars=1))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM t),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '')) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c USING (key) GROUP BY r
"""


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), parts=8, entries=16, rounds=6, scale=4096)
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left").select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def _op13_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round spelled out: all parts against all entries."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT r, p.part, min(d * {entries} + entry)::BIGINT % {entries} AS entry, min(d)::BIGINT AS d FROM (
    SELECT p.r, p.part, b.entry, (list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.x) + list_inner_product(b.x, b.x))::BIGINT AS d FROM p JOIN b{n} b ON b.part = p.part) p GROUP BY r, p.part)""")
        if n < rounds:
            steps.append(f"""
m{n} AS (
  SELECT part, entry, list(y ORDER BY i) AS x FROM (
    SELECT part, entry, i, floor(sum(c) / count(*)) AS y FROM (SELECT part, entry, unnest(x) AS c, unnest(range(len(x))) AS i FROM p JOIN a{n} USING (r, part)) GROUP BY part, entry, i) GROUP BY part, entry),
b{n + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{n} b LEFT JOIN m{n} m ON m.part = b.part AND m.entry = b.entry)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, vec_id, part, w[part * (len(w) // {parts}) + 1:(part + 1) * (len(w) // {parts})] AS x FROM v, range({parts}) t(part)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p QUALIFY entry < {entries}),{",".join(steps)},
e AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: y::BIGINT), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM v JOIN e USING (r), h
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op11_repair": op11_repair, "op12_lines": op12_lines, "op13_codes": op13_codes}


def oracle_sql() -> dict[str, str]:
    return {"op11_repair": OP11_SQL, "op12_lines": OP12_SQL, "op13_codes": _op13_sql()}
