"""Votes, reconciliation, overrides and the status of a chapter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Ties between classes go to the most conservative.
RANK = {"english_gap": 0, "content_gap": 1, "soft_flag": 2, "clean": 3}


def conservatism(cls: Column) -> Column:
    out = F.lit(len(RANK))
    for name, rank in RANK.items():
        out = F.when(cls == name, rank).otherwise(out)
    return out


def quorum_vote(verdicts: DataFrame, keys: list[str], cls: str = "class", at: str = "pass") -> DataFrame:
    """One class per key: any soft_flag, else the most votes, else the most
    conservative, else the first (A13).  Adds votes and first_pass."""
    counted = verdicts.groupBy(*keys, cls).agg(F.count("*").alias("votes"), F.min(at).alias("first_pass"))
    order = Window.partitionBy(*keys).orderBy((F.col(cls) == "soft_flag").desc(), F.desc("votes"), conservatism(F.col(cls)), "first_pass")
    return counted.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def quorum_of(votes: Column) -> Column:
    """The same vote over an array of (letter, class, judge) of one question: letter and class of each letter, by letter."""

    def elected(letter: Column) -> Column:
        own = F.filter(votes, lambda v: v.letter == letter)

        def standing(cls: Column) -> Column:
            mine = F.filter(own, lambda v: v["class"].eqNullSafe(cls))
            return F.struct((~F.coalesce(cls == "soft_flag", F.lit(False))).alias("later"), (-F.size(mine)).alias("n"), conservatism(cls).alias("rank"), F.array_min(F.transform(mine, lambda v: v.judge)).alias("first"), cls.alias("class"))

        best = F.array_min(F.transform(F.array_distinct(F.transform(own, lambda v: v["class"])), standing))
        return F.struct(letter.alias("letter"), best["class"].alias("class"))

    return F.transform(F.array_sort(F.array_distinct(F.transform(votes, lambda v: v.letter))), elected)


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], override: str = "structural_override") -> DataFrame:
    """Two judges on the same keys (A14, J5): agreement keeps; a missing verdict defers
    to the other judge; a structural override wins and counts as no disagreement;
    english_gap on either side wins; else soft_flag with the sorted pair.  Keys
    only in b are dropped."""
    both = a.select(*keys, F.col("class").alias("ca"), F.col(override).alias("oa")).join(b.select(*keys, F.col("class").alias("cb"), F.col(override).alias("ob")), keys, "left")
    over = F.when(F.coalesce("oa", F.lit(False)), F.col("ca")).when(F.coalesce("ob", F.lit(False)), F.col("cb"))
    differ = F.col("ca").isNotNull() & F.col("cb").isNotNull() & (F.col("ca") != F.col("cb"))
    gap = differ & ((F.col("ca") == "english_gap") | (F.col("cb") == "english_gap"))
    result = F.when(F.col("cb").isNull(), F.col("ca")).when(F.col("ca").isNull(), F.col("cb")).when(~differ, F.col("ca")).when(over.isNotNull(), over).when(gap, "english_gap").otherwise("soft_flag")
    return both.select(*keys, result.alias("class"), (differ & over.isNull()).cast("int").alias("disagreement"), F.when(differ & (result == "soft_flag"), F.array_sort(F.array("ca", "cb"))).alias("ambiguous_between"))


def schema_override(verdicts: DataFrame, signals: DataFrame, keys: list[str]) -> DataFrame:
    """english_gap becomes content_gap where a label pair fired."""
    hit = signals.where(F.col("fired") & (F.col("detector_id") == "schema_labeling")).select(*keys, F.lit(True).alias("__hit")).distinct()
    joined = verdicts.join(hit, keys, "left")
    applies = (F.col("class") == "english_gap") & F.coalesce("__hit", F.lit(False))
    return joined.withColumn("original_class", F.when(applies, F.col("class"))).withColumn("class", F.when(applies, "content_gap").otherwise(F.col("class"))).drop("__hit")


def english_gap_override(verdicts: DataFrame, signals: DataFrame, keys: list[str]) -> DataFrame:
    """Any other class becomes english_gap where an override signal fired; after D17."""
    hit = signals.where(F.col("fired") & (F.col("verdict_action") == "override_to") & (F.col("proposed_class") == "english_gap")).select(*keys, F.lit(True).alias("__hit")).distinct()
    joined = verdicts.join(hit, keys, "left")
    applies = (F.col("class") != "english_gap") & F.coalesce("__hit", F.lit(False))
    return joined.withColumn("overridden", applies).withColumn("class", F.when(F.col("overridden"), "english_gap").otherwise(F.col("class"))).drop("__hit")


def chapter_status(audits: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """empty, ready or review with its reason, per chapter (Q12).  Rows: chapter,
    question_id, flagged and wrong counts, failed (parse error), major."""
    total = audits.groupBy("chapter").agg(F.count("question_id").alias("questions"), F.sum("flagged").alias("flagged"), F.greatest(F.sum("wrong"), F.lit(1)).alias("wrong"), F.count_if("failed").alias("failed"), F.count_if("major").alias("major"))
    rate = F.col("flagged") / F.col("wrong")
    reason = F.when(F.col("failed") > 0, "parse_error").when(rate > tolerance, "english_gap").when(F.col("major") > 0, "editorial_major")
    status = F.when(F.col("questions") == 0, "empty").when(reason.isNotNull(), "review").otherwise("ready")
    via = F.when(status == "ready", F.when(F.col("flagged") == 0, "audit_only").otherwise("tolerance"))
    return total.select("chapter", "questions", "flagged", status.alias("status"), via.alias("ready_via"), F.when(status == "review", reason).alias("review_reason"))


def reuse_or_recompute(sources: DataFrame, manifest: DataFrame) -> DataFrame:
    """Chapters whose hash and configuration are those of the manifest keep its row."""
    old = manifest.select("chapter", F.col("source_hash").alias("__h"), F.col("config").alias("__c"), F.col("status").alias("__s"))
    same = (F.col("source_hash") == F.col("__h")) & F.col("config").eqNullSafe(F.col("__c"))
    joined = sources.join(old, "chapter", "left")
    return joined.withColumn("reused", F.coalesce(same, F.lit(False))).withColumn("status", F.when(F.col("reused"), F.col("__s"))).drop("__h", "__c", "__s")


def class_tally(rows: DataFrame, keys: list[str], classes: list[str], cls: str = "class", error: str = "error") -> DataFrame:
    """Rows of each class per key (A15, A18, A19, A28); rows with an error, and classes that
    are not known, count as error only."""
    failed = F.col(error).isNotNull() | ~F.coalesce(F.col(cls).isin(*classes), F.lit(False))
    counts = [F.count_if(~failed & (F.col(cls) == c)).alias(c) for c in classes]
    return rows.groupBy(*keys).agg(*counts, F.count_if(failed).alias("error"))


def derive_flagged(classifications: Column, legacy: Column) -> Column:
    """The english_gap rows; where there are no classifications, the older list (Q11)."""
    return F.when(classifications.isNotNull(), F.filter(classifications, lambda c: c["class"] == "english_gap")).otherwise(legacy)


def signal_disagreements(signals: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Fired letters that the verdict does not call english_gap, per question."""
    joined = signals.where("fired").select(*keys).distinct().join(verdicts.select(*keys, "class"), keys, "left")
    return joined.groupBy(keys[0]).agg(F.count_if(~F.col("class").eqNullSafe(F.lit("english_gap"))).alias("disagreements"))


def cohort_report(before: DataFrame, after: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Clean rows before and after, and whole percents rounded down."""
    both = before.select(key, *by, (F.col("class") == "clean").alias("pre")).join(after.select(key, (F.col("class") == "clean").alias("post")), key)
    told = both.groupBy(*by).agg(F.count("*").alias("n"), F.count_if("pre").alias("clean_before"), F.count_if("post").alias("clean_after"))
    return told.withColumn("percent_before", F.floor(100 * F.col("clean_before") / F.col("n"))).withColumn("percent_after", F.floor(100 * F.col("clean_after") / F.col("n")))


def bundle_guard(manifest: DataFrame, allow_partial: bool = False) -> int:
    """0: publish; 1: no chapters; 2: chapters in review (Q14).  Reads one aggregate row."""
    row = manifest.agg(F.count("*").alias("n"), F.count_if(F.col("status") == "review").alias("review")).first()
    return 1 if not row["n"] else 2 if row["review"] and not allow_partial else 0
