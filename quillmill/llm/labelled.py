"""A bounded sample of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a sample gathers at most, half of them for each label.
SAMPLE_BYTES = 48_000_000


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, *, folds: int, held_out: int, most: int, most_bytes: int = SAMPLE_BYTES, text_col: str = "text", id_col: str = "doc_id"
) -> tuple[list[str], list[int], float | None]:
    """Texts and labels (0 or 1) of at most `most` rows outside the held-out fold,
    and the share of ones among all labels outside it (null without any).

    The rows are chosen by a hash of the id, half of the places going to each
    label where there are enough; only their ids and labels are broadcast.  Of
    an id that several rows hold, the text with the smallest hash counts, once.
    A text that would carry its label past half of `most_bytes` is passed over.
    Rows without a label, an id or a text, and ids with both labels, are left
    out; empty tables give no rows.  Labels of the held-out fold are never read.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (fold(id_col, folds) != held_out))
    one = usable.groupBy(id_col).agg(F.min(label_col).alias("y"), F.max(label_col).alias("z")).where(F.col("y") == F.col("z"))
    share = one.agg(F.avg(F.col("y").cast("double"))).first()[0]
    order = F.xxhash64(F.col(id_col))
    picked = [one.where(F.col("y") == y).select(id_col, "y").orderBy(order, id_col).limit(most // 2) for y in (0, 1)]
    chosen = F.broadcast(picked[0].union(picked[1]))
    texts = docs.where(F.col(text_col).isNotNull()).select(id_col, F.col(text_col).cast("string").alias("t"))
    told = texts.join(chosen, id_col).select(id_col, "y", order.alias("o"), F.struct(F.xxhash64("t").alias("h"), F.octet_length("t").alias("n")).alias("k"))
    sizes = told.groupBy(id_col, "y", "o").agg(F.min("k").alias("k")).collect()  # at most `most` rows of numbers
    room, keep = {0: most_bytes // 2, 1: most_bytes // 2}, []
    for r in sorted(sizes, key=lambda r: (r["o"], str(r[0]))):
        if r["k"]["n"] <= room[int(r["y"])]:
            room[int(r["y"])] -= r["k"]["n"]
            keep.append((r[0], int(r["y"]), r["k"]["h"]))
    if not keep:
        return [], [], share
    id_type = docs.schema[id_col].dataType.simpleString()
    kept = F.broadcast(docs.sparkSession.createDataFrame(keep, f"`{id_col}` {id_type}, y int, h bigint"))
    rows = texts.join(kept, id_col).where(F.xxhash64("t") == F.col("h")).groupBy(id_col, "y").agg(F.min("t").alias("t")).collect()
    rows.sort(key=lambda r: (str(r[0]), r["y"]))
    return [r["t"] for r in rows], [r["y"] for r in rows], share


def unique_texts(texts: list[str], labels: list[int]) -> tuple[list[str], list[int]]:
    """Each text once, so copies neither weigh double nor sit on both sides of a split."""
    seen = dict(zip(texts, labels, strict=True))
    return [*seen], [*seen.values()]
