"""Arrow UDFs for what no built-in expresses: match offsets and JSON inside prose."""

from __future__ import annotations

import json
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def match_offsets(pattern: str):
    """Start of every match."""
    compiled = re.compile(pattern)

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: [m.start() for m in compiled.finditer(x or "")])

    return run


def least_distance(a, b):
    """The least distance of two sorted arrays of offsets, null if one is empty."""

    def least(x, y) -> int | None:
        if x is None or y is None or not len(x) or not len(y):
            return None
        at = np.searchsorted(y, x)
        return int(np.minimum(np.abs(x - y[np.maximum(at - 1, 0)]), np.abs(y[np.minimum(at, len(y) - 1)] - x)).min())

    @F.pandas_udf("int")
    def run(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([least(x, y) for x, y in zip(xs, ys, strict=True)], dtype="Int32")

    return run(a, b)


def last_json_object(text: str | None) -> str | None:
    """The last balanced {...} that parses; strings and escapes are honoured."""
    best, at, text = None, 0, text or ""
    while (start := text.find("{", at)) >= 0:
        depth, quoted, i = 0, False, start
        while i < len(text):
            c = text[i]
            if quoted:
                i += c == "\\"
                quoted = c != '"'
            elif c == '"':
                quoted = True
            elif c in "{}":
                depth += 1 if c == "{" else -1
                if not depth:
                    break
            i += 1
        at = start + 1
        if not depth and i < len(text):
            try:
                json.loads(text[start : i + 1])
            except ValueError:
                continue
            best, at = text[start : i + 1], i + 1
    return best


def extract_json():
    """The last parseable JSON object of each text."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(last_json_object)

    return run
