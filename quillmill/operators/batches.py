"""Batches of requests to a model: prepared, submitted chunk by chunk, collected.

The manifest is a table with a row for each chunk (chunk, n, phase, batch_id), kept as
versions: a step writes the version after the one it has read, so steps can be run
twice, and a run that was interrupted goes on at the first chunk that was not submitted.  Tasks
and results are tables beside it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions.text import strip_fence
from quillmill.operators.ordinals import chunked
from quillmill.operators.planning import remaining, short_id
from quillmill.sources.versions import Versions

PREPARED, SUBMITTED, COMPLETE = "prepared", "submitted", "complete"


class Batch:
    """One batch in a folder.  Phases follow each other only as prepared, submitted, complete."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.manifest = Versions(spark, f"{self.folder}/manifest")

    def phase(self) -> str | None:
        """The manifest's phase; null before the first batch.  Reads one row: all chunks of a version tell the same."""
        current = self.manifest.current()
        return None if current is None else current.agg(F.first("phase")).first()[0]

    def _run(self) -> int:
        return self.manifest.current().agg(F.max("run")).first()[0]

    def tasks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/tasks/run={self._run()}")

    def prepare(self, tasks: DataFrame, order: list[str], size: int = 10_000, done: DataFrame | None = None, key: str = "question_id") -> None:
        """Tasks (key, prompt) without those that are done, with short ids (J16) and chunks of `size` in a business order.
        Refused while another batch is on its way."""
        phase, at = self.phase(), self.manifest.latest()
        if phase == SUBMITTED:
            raise RuntimeError("the batch on its way has to be collected first")
        run = 0 if at is None else at + 1
        todo = tasks if done is None else remaining(tasks, done, on=key)
        cut = chunked(todo, order, size).withColumn("short_id", short_id(F.col(key)))
        cut.write.mode("overwrite").partitionBy("chunk").parquet(f"{self.folder}/tasks/run={run}")
        chunks = self.spark.read.schema(cut.schema).parquet(f"{self.folder}/tasks/run={run}").groupBy("chunk").agg(F.count("*").alias("n"))
        self.manifest.commit(at, chunks.select("chunk", "n", F.lit(PREPARED).alias("phase"), F.lit(None).cast("string").alias("batch_id"), F.lit(run).alias("run")))

    def submit(self, send: Callable[[DataFrame, int], str]) -> int:
        """Sends each chunk that was not sent and returns how many were; send(requests, chunk) gives the
        id of what it has sent or raises, and what was sent before stays sent.  A version for each chunk, so nothing is sent twice; for many chunks take submit_whole."""
        if self.phase() not in (PREPARED, SUBMITTED):
            raise RuntimeError(f"phase {self.phase()}, not {PREPARED}")
        sent = 0
        open_ = self.manifest.current().where("batch_id is null").select("chunk").orderBy("chunk")
        for row in open_.toLocalIterator():  # a number for each chunk of 10,000 requests
            name = send(self.tasks().where(F.col("chunk") == row["chunk"]), row["chunk"])
            at = self.manifest.latest()
            batch = F.when(F.col("chunk") == row["chunk"], F.lit(name)).otherwise(F.col("batch_id"))
            self.manifest.commit(at, self.manifest.read(at).withColumns({"batch_id": batch, "phase": F.lit(SUBMITTED)}))
            sent += 1
        return sent

    def submit_whole(self, send: Callable[[DataFrame], Column]) -> int:
        """The same for a service that takes many chunks at once: send(requests) gets all that were not sent, and gives
        each chunk's id as a column of `chunk`, or raises.  One job and one version, however many chunks there are; after
        a send that failed none of its chunks counts as sent."""
        if self.phase() not in (PREPARED, SUBMITTED):
            raise RuntimeError(f"phase {self.phase()}, not {PREPARED}")
        at = self.manifest.latest()
        manifest = self.manifest.read(at)
        open_ = manifest.where("batch_id is null").select("chunk")
        sent = open_.count()
        if sent:
            name = send(self.tasks().join(open_, "chunk", "left_semi"))
            self.manifest.commit(at, manifest.withColumns({"batch_id": F.coalesce("batch_id", name), "phase": F.lit(SUBMITTED)}))
        return sent

    def collect(self, results: DataFrame, ended: DataFrame, schema: str, key: str = "question_id") -> bool:
        """Answers joined to their tasks, once all chunks were sent and have ended; else False and nothing changes.

        results: batch_id, short_id, status, content.  ended: batch_id.  An id that is no short id counts as the id itself.
        Answers go to `answers`, with the reason where there is none (batch_<status>, json_parse, not in manifest).
        After a collection the same call changes nothing."""
        phase, at = self.phase(), self.manifest.latest()
        if phase == COMPLETE:
            return True
        if phase != SUBMITTED:
            raise RuntimeError(f"phase {phase}, not {SUBMITTED}")
        manifest = self.manifest.read(at)
        if not manifest.join(ended, "batch_id", "left_anti").isEmpty():
            return False
        own = results.join(manifest.where("batch_id is not null").select("batch_id", "chunk"), "batch_id")
        answer = F.from_json(strip_fence(F.col("content")), schema)
        told = own.select("batch_id", "chunk", "short_id", "status", F.when(F.col("status") == "succeeded", answer).alias("answer"))
        joined = told.join(self.tasks().select("short_id", F.col(key).alias("__key")), "short_id", "left")
        whole = F.exists(F.array(*(F.col(f"answer.{f.name}").isNotNull() for f in told.schema["answer"].dataType.fields)), lambda x: x)
        error = F.when(F.col("status") != "succeeded", F.concat(F.lit("batch_"), "status")).when(~F.coalesce(whole, F.lit(False)), "json_parse").when(F.col("__key").isNull(), "not in manifest")
        found = joined.select(F.coalesce("__key", "short_id").alias(key), "chunk", "batch_id", F.when(error.isNull(), F.col("answer")).alias("answer"), error.alias("error"))
        found.write.mode("overwrite").parquet(f"{self.folder}/answers/run={self._run()}")
        self.manifest.commit(at, manifest.withColumn("phase", F.lit(COMPLETE)))
        return True

    def answers(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/answers/run={self._run()}")


def outbox(folder: str) -> Callable[[DataFrame, int], str]:
    """A sender that writes requests as JSON lines, a folder for each chunk, for a service that reads them."""

    def send(requests: DataFrame, chunk: int) -> str:
        name = f"batch-{chunk:06d}"
        requests.drop("chunk").write.mode("overwrite").json(f"{folder}/{name}")
        return name

    return send


def whole_outbox(folder: str) -> Callable[[DataFrame], Column]:
    """The same for all chunks in one job: folders named batch_id=..., of which those that a send writes are replaced."""

    def send(requests: DataFrame) -> Column:
        name = F.format_string("batch-%06d", F.col("chunk"))
        requests.withColumn("batch_id", name).drop("chunk").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").json(folder)
        return name

    return send
