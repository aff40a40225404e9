"""Scans and sinks of CSV, JSON and JSON-lines files under declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql.window import Window

from quillmill.functions import refdata as R

#: The columns of an anchor file, all text.
ANCHOR = t.StructType([t.StructField(c, t.StringType()) for c in ("uid", "anchor_point_id_v2", "domain_num", "domain_name", "source", "chapter_num", "chapter_title", "verbatim_anchor", "old_anchor", "testable_fact")])
PASSAGE = t.StructType([t.StructField(c, t.StringType()) for c in ("uid", "passage", "domain_code")])


def _or_empty(spark: SparkSession, schema: t.StructType, read) -> DataFrame:
    """read(), or no rows under the schema where the path does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_csv(spark: SparkSession, path: str, schema: t.StructType, key: str | None = None) -> DataFrame:
    """Header CSV, every value text; of rows with one key the last in the file stays."""
    rows = _or_empty(spark, schema, lambda: spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"'))
    if key is None:
        return rows
    # position in file: files in order of their names, rows within by the split they came from
    placed = rows.withColumn("__at", F.struct(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")))
    rest = [c for c in rows.columns if c != key]
    return placed.groupBy(key).agg(F.max_by(F.struct(*rest), "__at").alias("r")).select(key, "r.*").select(*rows.columns)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """file_path, at (the line's number in its file, from 0), line.

    Files are split as Spark likes.  A line's number is its place in its split plus the lines of the file's splits
    before; what meets in one place is a count for each split."""
    raw = spark.read.text(path).select("value", "_metadata.file_path", F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    splits = raw.groupBy("file_path", "start").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file_path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file_path", "start", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return raw.join(offsets, ["file_path", "start"]).select("file_path", (F.col("id") + F.col("shift")).alias("at"), F.col("value").alias("line"))


def scan_positional(spark: SparkSession, path: str, preamble: int, least_fields: int, ordinals: dict[str, int], with_file: bool = False) -> DataFrame:
    """at and the named fields (and file_path) of CSV by position: the first lines of each file are skipped, short rows dropped,
    values trimmed (S03, S04).  A row is a line: quoted fields hold no line feed."""
    schema = ", ".join(f"c{i} string" for i in range(max(least_fields, max(ordinals.values()) + 1)))
    lines = scan_lines(spark, path).where(F.col("at") >= preamble)
    wide = lines.withColumn("n", F.size(F.split(F.regexp_replace("line", '"[^"]*"', "x"), ","))).where(F.col("n") >= least_fields).withColumn("r", F.from_csv("line", schema, {"mode": "PERMISSIVE"}))
    return wide.select(*["file_path"] * with_file, "at", *(F.trim(F.col(f"r.c{i}")).alias(name) for name, i in ordinals.items()))


def grouped_chapters(anchors: DataFrame, keys: list[str], title: str, fields: list[str]) -> DataFrame:
    """A row for each chapter: its anchors in the order of files and lines, their number, and the title on its last line."""
    place = F.struct("file_path", "at")
    told = anchors.groupBy(*keys).agg(F.max_by(title, place).alias(title), F.count("*").alias("n_anchors"), F.array_sort(F.collect_list(F.struct(place.alias("place"), *fields))).alias("anchors"))
    return told.withColumn("anchors", F.transform("anchors", lambda a: a.dropFields("place")))


def scan_questions(spark: SparkSession, path: str, schema: t.StructType, sidecars: tuple[str, ...] = R.COVERAGE_SIDECARS, glob: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of JSON files (S06-S09): a list of questions, {"questions": list}, or a mapping whose
    values are questions.

    rows: file_path, at, key (of a mapping, whose entries come in the order of their keys; else null) and the schema's fields; a field of
    another type is null.  quarantine: file_path, at, reason: unreadable (no JSON), shape (neither list nor
    mapping), not_a_question (an entry that is no object, at its place).  Sidecars are not read.  A file is one row
    while it is parsed, so it has to fit one.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob).select("value", "_metadata.file_path")
    name = F.lower(F.element_at(F.split("file_path", "/"), -1))
    kept = files.where(~name.rlike("|".join(sidecars))) if sidecars else files
    parsed = kept.select("file_path", F.try_parse_json("value").alias("v"))
    inner = F.try_variant_get("v", "$.questions", "variant")
    kind = lambda v: F.substring_index(F.schema_of_variant(v), "<", 1)
    listed = parsed.withColumn("v", F.when((kind(F.col("v")) == "OBJECT") & (kind(inner) == "ARRAY"), inner).otherwise(F.col("v"))).withColumn("kind", kind(F.col("v")))
    readable = listed.where(F.col("kind").isin("ARRAY", "OBJECT"))
    entries = readable.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("file_path", F.col("pos").alias("at"), "key", F.col("value").alias("q")).withColumn("is_object", F.coalesce(kind(F.col("q")) == "OBJECT", F.lit(False)))
    rows = entries.where("is_object").select("file_path", "at", "key", *(F.try_variant_get("q", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields))
    broken = listed.where(~F.coalesce(F.col("kind").isin("ARRAY", "OBJECT"), F.lit(False))).select("file_path", F.lit(None).cast("int").alias("at"), F.when(F.col("v").isNull(), "unreadable").otherwise("shape").alias("reason"))
    return rows, broken.unionByName(entries.where("not is_object").select("file_path", "at", F.lit("not_a_question").alias("reason")))


def scan_json_documents(spark: SparkSession, path: str, schema: t.StructType, sidecars: tuple[str, ...] = R.COVERAGE_SIDECARS) -> DataFrame:
    """JSON files of a list or of {"questions": list}; sidecar names and unreadable
    files are left out (S06-S09)."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select("value", "_metadata.file_path")
    name = F.element_at(F.split("file_path", "/"), -1)
    kept = files.where(~F.lower(name).rlike("|".join(sidecars))) if sidecars else files
    inner = t.ArrayType(schema)
    listed = F.from_json("value", inner)
    wrapped = F.from_json("value", t.StructType([t.StructField("questions", inner)]))["questions"]
    found = F.when(F.ltrim("value").startswith("["), listed).otherwise(wrapped)
    return kept.select("file_path", F.posexplode(found).alias("at", "q")).where("q is not null").select("file_path", "at", "q.*")


def scan_entities(spark: SparkSession, path: str, schema: t.StructType, keys: DataFrame, on: list[str]) -> DataFrame:
    """Nested documents by key; absent ones come back with nulls and found = false."""
    rows = _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path, multiLine=True, mode="PERMISSIVE"))
    return keys.join(rows.withColumn("found", F.lit(True)), on, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def append_events(events: DataFrame, path: str) -> None:
    """JSON lines, added to what is there."""
    events.write.mode("append").json(path)


def scan_events(spark: SparkSession, path: str, schema: t.StructType, event: str | None = None) -> DataFrame:
    """JSON lines; lines that can't be read are skipped."""
    rows = _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path, mode="DROPMALFORMED"))
    return rows if event is None else rows.where(F.col("event") == event)


def write_csv(rows: DataFrame, path: str, columns: list[str], *, mode: str = "overwrite", compression: str = "none") -> None:
    """A fixed column list with header; other columns are left out (S16).  mode append: files beside those that are there."""
    rows.select(*columns).write.mode(mode).csv(path, header=True, quoteAll=True, escape='"', compression=compression)


def write_partitioned(rows: DataFrame, path: str, by: list[str], session_overwrite: str = "dynamic") -> None:
    """JSON by partition; only the partitions that have rows are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", session_overwrite).partitionBy(*by).json(path)


def merge_checkpoint(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The keys of both, sorted; it only grows."""
    return old.select(key).union(new.select(key)).distinct().orderBy(key)


def sync_delta(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of both sides and their difference; an empty source is refused."""
    one = source.agg(F.count("*").alias("n")).join(target.agg(F.count("*").alias("n_target")))
    n = F.when(F.col("n") == 0, F.raise_error(F.lit("the source has no rows"))).otherwise(F.col("n"))  # part of each result that needs the count
    return one.select(n.alias("n_source"), "n_target", (n - F.col("n_target")).alias("delta"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Path and SHA-256 of each file."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("source_hash"))


def write_sidecar(results: DataFrame, metadata: dict[str, str], path: str) -> None:
    """An audit's rows, its metadata beside each."""
    noted = F.struct(*(F.lit(v).alias(k) for k, v in metadata.items()))
    results.withColumn("metadata", noted).write.mode("overwrite").json(path)


def write_audit(results: DataFrame, fixed: DataFrame, metadata: dict[str, str], path: str, flag: str = "flagged") -> None:
    """The audit, and the fixed rows where anything was flagged."""
    write_sidecar(results, metadata, f"{path}.audit.json")
    if not results.where(flag).isEmpty():
        fixed.write.mode("overwrite").json(f"{path}.fixed.json")
