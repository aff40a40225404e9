"""Results written between stages, so that later stages read them and a lost executor costs no recomputation."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _shared(spark: SparkSession) -> str | None:
    """spark.checkpoint.dir; null on one machine, where a temporary folder may stand in."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    return shared


def written(df: DataFrame) -> DataFrame:
    """df, written once to the folder in spark.checkpoint.dir; a temporary one may stand in on one machine only."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared(df.sparkSession) or tempfile.mkdtemp(prefix="quillmill-"))
    return df.checkpoint(eager=True)


def released(spark: SparkSession) -> None:
    """Shuffle files of what is finished are deleted when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """The same as compressed columns: a checkpoint holds its rows uncompressed.  The shuffle files that it took to
    make them are of no more use."""
    spark = df.sparkSession
    shared = _shared(spark)
    path = tempfile.mkdtemp(prefix="quillmill-") + "/stage" if shared is None else f"{shared.rstrip('/')}/quillmill-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    released(spark)
    return spark.read.schema(df.schema).parquet(path)
