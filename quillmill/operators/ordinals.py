"""Row numbers over a whole table without bringing it to one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillmill.sources.stages import written

#: monotonically_increasing_id() holds the partition above this bit and the row's place below it.
PLACE_BITS = 33


def with_ordinal(rows: DataFrame, *order: Column | str, name: str = "ordinal") -> DataFrame:
    """rows with 0, 1, 2 ... in a business order over the whole table.

    Rows are range-partitioned and sorted by the order, so a row's number is its
    place in its partition plus the rows of the partitions before.  The counts are
    a row for each partition; only these meet in one task and are broadcast.
    The sorted rows are written first, as places count only within one and the
    same partitioning.  Rows that the order leaves equal get their numbers in any
    order; an order that ends in a key is repeatable.  An empty table stays empty.
    """
    place, part = f"__{name}_place", f"__{name}_part"
    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()))
    placed = placed.withColumn(part, F.shiftright(place, PLACE_BITS))
    counts = placed.groupBy(part).agg(F.count("*").alias("__n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = counts.select(part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    numbered = placed.join(F.broadcast(starts), part)
    return numbered.select(*rows.columns, (F.col("__start") + F.col(place).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))).alias(name))


def zip_rows(left: DataFrame, right: DataFrame, left_order: list[Column | str], right_order: list[Column | str], name: str = "ordinal") -> DataFrame:
    """The n-th row of one table beside the n-th of the other, as long as the shorter one.

    Columns of the right table that the left has too are left out.  The join is an
    equality on the ordinal, whose values are all different, so no key is hot."""
    a = with_ordinal(left, *left_order, name=name)
    b = with_ordinal(right, *right_order, name=name)
    return a.join(b.drop(*(c for c in right.columns if c in left.columns)), name)


def chunked(rows: DataFrame, order: list[Column | str], size: int, name: str = "chunk") -> DataFrame:
    """rows with the number of the chunk of at most `size` rows that each belongs to."""
    return with_ordinal(rows, *order, name="__at").withColumn(name, F.floor(F.col("__at") / size)).drop("__at")


def ends_of_chunks(rows: DataFrame, chunk: str, keys: list[str]) -> DataFrame:
    """Rows, first and last key of each chunk: what a manifest keeps of it."""
    key = F.struct(*keys)
    told = rows.groupBy(chunk).agg(F.count("*").alias("n"), F.min(key).alias("__first"), F.max(key).alias("__last"))
    return reduce(lambda df, k: df.withColumn(f"first_{k}", F.col("__first")[k]).withColumn(f"last_{k}", F.col("__last")[k]), keys, told).drop("__first", "__last")
