"""Structured Streaming forms of the event log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql.streaming import DataStreamWriter

from quillmill.operators.corpus import last_event
from quillmill.sources.versions import Versions


def read_log(spark: SparkSession, path: str, schema: t.StructType, files_per_trigger: int = 100) -> DataFrame:
    """An append-only JSON-lines log as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def keep_latest(stream: DataFrame, keys: list[str], ord_col: str, table: str, checkpoint: str, buckets: int = 64) -> DataStreamWriter:
    """The last event of each key in a table, merged batch by batch (R2); read it by `latest`.

    Keys are hashed to buckets.  A batch rewrites the buckets that it has rows for and no others; a
    manifest, a row for each bucket, names the version in which each was written last.  Version n is made from version n - 1, so
    a batch that is run again gives the same table, and a missing version is an error, not a new beginning.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        manifest, data = Versions(spark, f"{table}/manifest"), f"{table}/data"
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        rows = new = last_event(batch, keys, ord_col).select(*batch.columns).withColumn("bucket", bucket).persist()  # read for its buckets and for its rows
        held = manifest.read(number - 1) if number else spark.createDataFrame([], "bucket int, version int")
        touched = {r["bucket"] for r in rows.select("bucket").distinct().collect()}  # at most `buckets` numbers
        paths = [f"{data}/version={r['version']}/bucket={r['bucket']}" for r in held.collect() if r["bucket"] in touched]
        if paths:
            old = spark.read.schema(batch.schema).parquet(*paths).withColumn("bucket", bucket)
            rows = last_event(rows.unionByName(old), [*keys, "bucket"], ord_col).select(*rows.columns)
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{data}/version={number}")
        new.unpersist()
        told = spark.createDataFrame([(b, number) for b in sorted(touched)], "bucket int, version int")
        manifest.replace(number, held.where(~F.col("bucket").isin(*touched) if touched else F.lit(True)).unionByName(told).coalesce(1))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def latest(spark: SparkSession, table: str, schema: t.StructType) -> DataFrame:
    """What `keep_latest` has kept: of each bucket the version that the newest manifest names."""
    manifest = Versions(spark, f"{table}/manifest").current()
    paths = [] if manifest is None else [f"{table}/data/version={r['version']}/bucket={r['bucket']}" for r in manifest.collect()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def once_per_key(stream: DataFrame, keys: list[str], time_col: str, delay: str = "1 hour") -> DataFrame:
    """Each key once within the watermark."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time_col: str, keys: list[str], width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Events per window and key, late ones up to the delay."""
    counted = stream.withWatermark(time_col, delay).groupBy(F.window(time_col, width), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def reprocess_changed(manifest: str, compute: Callable[[DataFrame], DataFrame], key: str = "path", digest: str = "source_hash") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that computes only what changed since the manifest."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        todo = batch
        if _exists(spark, manifest):
            todo = batch.join(spark.read.parquet(manifest).select(key, digest), [key, digest], "left_anti")
        compute(todo).write.mode("append").parquet(manifest)

    return run
