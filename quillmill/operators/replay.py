"""External judgements as replayable tables, with a pluggable client as the other source."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions.text import strip_fence


def replayed(requests: DataFrame, answers: DataFrame, keys: list[str], schema: str) -> DataFrame:
    """Answers from a table of earlier runs; requests without one keep nulls.

    The answer's text may stand in a code fence; what can't be read is null (F17).
    """
    known = answers.select(*keys, F.from_json(strip_fence(F.col("content")), schema).alias("answer"))
    return requests.join(known, keys, "left")


def called(requests: DataFrame, make_client: Callable[[], Callable[[str], str]], attempts: int = 3) -> DataFrame:
    """Adds content and error from a client that each task makes for itself; a request is
    tried again up to `attempts` times, and its last error is kept (L01, L02)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make_client()
        for batch in batches:
            contents, errors = [], []
            for prompt in batch["prompt"]:
                content = error = None
                for _ in range(attempts):
                    try:
                        content, error = ask(prompt), None
                        break
                    except Exception as e:  # noqa: BLE001  a client may raise anything; the row says so
                        error = f"{type(e).__name__}: {e}"
                contents.append(content)
                errors.append(error)
            yield batch.assign(content=contents, error=errors)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
    return requests.mapInPandas(run, f"{fields}, content string, error string")


def two_attempts(tasks: DataFrame, first: Callable[[DataFrame], DataFrame], again: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Generate and validate, then once more for what failed (L03): rows carry `failures`."""
    done = first(tasks)
    good, bad = done.where(F.size("failures") == 0), done.where(F.size("failures") > 0)
    return good.unionByName(again(bad), allowMissingColumns=True)
