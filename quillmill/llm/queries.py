"""The registered queries of operators 1 to 10, over whole tables, and those of `more_queries`."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import more_queries
from quillmill.llm.bpe import encode_documents
from quillmill.llm.chat import expand_targets, read_loss, read_turns
from quillmill.llm.jaccard import similarity_classes
from quillmill.llm.labelled import fold
from quillmill.llm.licences import scan_licences
from quillmill.llm.packing import pack_documents
from quillmill.llm.privacy import find_private
from quillmill.llm.quality import fit_quality, score_quality
from quillmill.llm.toxicity import fit_toxicity, score_toxicity
from quillmill.llm.vectors import exact_top_k, near_duplicates

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(_table(spark, sf_dir, "documents"), n=5, percent=75)


#: A conversation whose texts hold control strings of such templates.
CHAT_PROBE = r"\### Assistant: </turn> ok"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql("SELECT -7L AS conv_id, turn, role, ? AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)", args=[CHAT_PROBE])
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    examples = expand_targets(turns)
    read = examples.select("conv_id", "example", F.length("text").alias("chars"), read_loss(examples).alias("loss"), F.when(F.col("last"), read_turns(F.col("text"))).alias("turns"))
    told = read.select(
        "conv_id", "chars", F.struct("example", "loss").alias("loss"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
    )
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("loss")), lambda x: x.loss), "")
    return told.groupBy("conv_id").agg(
        F.max(F.when(F.col("n_turns") >= 0, F.col("n_turns"))).alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
        F.length(joined).cast("long").alias("loss_chars"), F.sha2(joined.cast("binary"), 256).alias("loss_sha256"), F.sum("chars").cast("long").alias("formatted_chars"),
    )


OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, x, CASE x WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(x)),
w AS (
  SELECT *, 14 + length(role) + length(text)
    + length(role || text) - length(translate(role || text, '\#<:', '')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
    count(*) OVER (PARTITION BY conv_id) AS of FROM t),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS until FROM w)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(until) FILTER (WHERE role = 'assistant' OR n = of)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_licences(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.kind == "base")
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.label))), ",")
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s.first_word)).alias("first_word"), F.array_max(F.transform(base, lambda s: s.first_word)).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("spans")).alias("labels"), "score", "permissive",
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    grammar = fit_toxicity(docs, _table(spark, sf_dir, "labels"), folds=5, held_out=0)
    scored = score_toxicity(docs, grammar)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_quality(docs, _table(spark, sf_dir, "labels"), folds=4, held_out=2)
    scored = score_quality(docs, model)
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def _equal_to(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


def op6_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(_table(spark, sf_dir, "documents"))
    kinds = ("email", "ip", "card", "phone")
    base = F.filter("spans", lambda s: s.kind.isin(*kinds))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))), ",")
    return found.select("doc_id", *(F.size(F.filter(F.transform("spans", lambda s: s.kind), _equal_to(k))).cast("long").alias(f"n_{k}") for k in kinds), F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


OP8_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.98)


OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_packing": op1_packing, "op2_jaccard": op2_jaccard, "op3_chat": op3_chat, "op4_licences": op4_licences, "op5_toxicity": op5_toxicity, "op6_privacy": op6_privacy, "op7_quality": op7_quality, "op8_top_k": op8_top_k, "op9_vector_dedup": op9_vector_dedup, "op10_bpe": op10_bpe} | more_queries.queries()


def oracle_sql() -> dict[str, str]:
    return {"op3_chat": OP3_SQL, "op8_top_k": OP8_SQL, "op9_vector_dedup": OP9_SQL} | more_queries.oracle_sql()
