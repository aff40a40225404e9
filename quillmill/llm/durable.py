"""Cutting lineage so that a lost executor costs no recomputation."""

from __future__ import annotations

import re
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm.arrow_text import released

#: The driver's garbage is collected at most once in so many seconds.
COLLECT_S = 3.0
_collected = -COLLECT_S


def collected(spark: SparkSession) -> None:
    """Collects the driver's garbage, in Python first, as that holds on to objects of
    its JVM.  Spark drops broadcasts, shuffle files and checkpoints that nobody uses
    only then, and a job of many queries grows the heap before it would come to it."""
    global _collected
    if time.monotonic() - _collected >= COLLECT_S:
        released()
        spark.sparkContext._jvm.System.gc()
        _collected = time.monotonic()


def durable(df: DataFrame) -> DataFrame:
    """df, written once to the folder in spark.checkpoint.dir.

    Only on one machine (a local master) a temporary folder may stand in; a
    cluster without that setting is an error, as its machines share no such folder.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="quillmill-"))
    written = df.checkpoint(eager=True)
    collected(spark)
    return written
