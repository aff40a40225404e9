"""Tables kept as numbered versions in a folder; a version counts once it is whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Versions:
    """Folder/version=N, each a Parquet table.  A crashed write leaves no whole version and is written over."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, number: int) -> str:
        return f"{self.folder}/version={number}"

    def _files(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def has(self, number: int) -> bool:
        files, where = self._files(f"{self.path(number)}/_SUCCESS")
        return files.exists(where)

    def latest(self) -> int | None:
        files, where = self._files(self.folder)
        if not files.exists(where):
            return None
        names = [s.getPath().getName() for s in files.listStatus(where)]
        numbers = [int(n[8:]) for n in names if n.startswith("version=") and n[8:].isdigit()]
        return max((n for n in numbers if self.has(n)), default=None)

    def read(self, number: int) -> DataFrame:
        if not self.has(number):
            raise FileNotFoundError(f"{self.path(number)} is missing or was not finished")
        return self.spark.read.parquet(self.path(number))

    def current(self) -> DataFrame | None:
        number = self.latest()
        return None if number is None else self.read(number)

    def replace(self, number: int, rows: DataFrame) -> None:
        """Version `number`, whatever is there: a run that is repeated gives it again."""
        rows.write.mode("overwrite").parquet(self.path(number))

    def commit(self, base: int | None, rows: DataFrame) -> int:
        """The version after `base`, unless another run has written it meanwhile."""
        number = 0 if base is None else base + 1
        if self.has(number):
            raise RuntimeError(f"{self.path(number)} was written by another run")
        self.replace(number, rows)
        return number
