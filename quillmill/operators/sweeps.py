"""Names that texts cite: hits, one row for each name with its sources and kinds beside it, totals."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import attribution

# Kinds whose name may be several authors', and the kinds that a report shows.
JOINT_KINDS = ("year", "according_to")
SHOWN_KINDS = ("year", "et_al", "according_to", "possessive")


def name_hits(texts: DataFrame, text: Column, bucket: Column) -> DataFrame:
    """name, kind, bucket: a row for each cited author; those of a joint citation count one by one.  Null texts cite nobody."""
    each = lambda hit: F.transform(F.when(hit.kind.isin(*JOINT_KINDS), attribution.authors(hit["name"])).otherwise(F.array(hit["name"])), lambda n: F.struct(n.alias("name"), hit.kind.alias("kind")))
    hits = F.flatten(F.transform(attribution.attributions(text), each))
    return texts.select(bucket.alias("bucket"), F.explode(hits).alias("h")).select("h.name", "h.kind", "bucket")


def swept_names(hits: DataFrame, buckets: Iterable[str], whitelist: Iterable[str] = (), kinds: Iterable[str] = SHOWN_KINDS) -> DataFrame:
    """name, total, in_<bucket>, as_<kind>, whitelisted: both pivots in one aggregation.

    Hits are counted where they are before they are shuffled, so a name that every text cites is one row of each task.
    Hits of other buckets and kinds count in the total alone.
    """
    listed = F.col("name").isin(*whitelist) if (whitelist := [*whitelist]) else F.lit(False)
    return hits.groupBy("name").agg(
        F.count("*").alias("total"), *(F.count_if(F.col("bucket") == b).alias(f"in_{b}") for b in buckets), *(F.count_if(F.col("kind") == k).alias(f"as_{k}") for k in kinds)
    ).withColumn("whitelisted", listed)


def sweep_summary(names: DataFrame) -> DataFrame:
    """One row: names and instances, how many are on the list, and the percent of instances that are."""
    on, total = F.col("whitelisted"), F.coalesce(F.sum("total"), F.lit(0))
    listed = F.coalesce(F.sum(F.when(on, F.col("total"))), F.lit(0))
    percent = lambda part: F.round(part * 100.0 / F.greatest(total, F.lit(1)), 1)
    return names.agg(
        total.alias("instances"), F.count("*").alias("names"), F.count_if(on).alias("listed_names"), listed.alias("listed"), percent(listed).alias("listed_percent"), F.count_if(~on).alias("unlisted_names"),
        (total - listed).alias("unlisted"), percent(total - listed).alias("unlisted_percent"),
    )


def top_names(names: DataFrame, k: int = 40, unlisted_only: bool = False) -> DataFrame:
    """The k names cited most, ties by name; only those that may still go onto the list, if asked."""
    return (names.where(~F.col("whitelisted")) if unlisted_only else names).orderBy(F.desc("total"), "name").limit(k)
