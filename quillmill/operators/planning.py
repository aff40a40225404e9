"""Planning by rotation: every choice is arithmetic on ordinals, so plans are repeatable."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillmill.functions import text as T
from quillmill.functions.refdata import POSITIONS

TIER_ORDER = [3, 2, 1, 4]


def ordinal(order: Column, *keys: str) -> Column:
    """0, 1, 2 ... within the keys, by a business order."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1


def answer_position(anchor: Column, tier: Column, variant: Column, tiers: int = 4, variants: int = 5) -> Column:
    """The letter of the correct option."""
    slot = F.pmod(anchor * (tiers * variants) + (tier - 1) * variants + variant - 1, F.lit(len(POSITIONS)))
    return F.element_at(T.words_array(POSITIONS), (slot + 1).cast("int"))


def rotated(pool: Column, variant: Column, tier: Column | None = None) -> Column:
    """The pool's element for a variant (W07) or for a variant and tier."""
    at = variant - 1 if tier is None else (variant - 1) * 4 + tier - 1
    return F.when(F.size(pool) > 0, F.get(pool, F.pmod(at, F.size(pool)).cast("int")))


def integration_pair(pool: Column, variant: Column, tier: Column) -> Column:
    """Two different elements for tier 4; null with fewer than two."""
    n = F.size(pool)
    first = F.pmod((variant - 1) * 4 + tier - 1, n)
    second = F.pmod(first + 1 + variant - 1, n)
    second = F.when(second == first, F.pmod(second + 1, n)).otherwise(second)
    return F.when(n >= 2, F.array(F.get(pool, first.cast("int")), F.get(pool, second.cast("int"))))


# The levels of a tier's three wrong options.
LEVELS = {1: (1, 2, 3), 2: (1, 2, 3), 3: (2, 3, 4), 4: (3, 4, 4)}


def distractor_slots(pool: Column, tested: Column, permitted_ids: Column, variant: Column, tier: Column) -> Column:
    """Three structs (slot, level, mode, misconception_id).

    The pool is first cut to the permitted concepts, if there are any and three
    of it remain (J18); those that involve the tested concept come first.  From
    a start that turns with variant and tier, the first three different ids are
    taken, or the next in turn where there are fewer.  A pool of under three
    gives open slots.  pool: array of misconception_id, concepts_involved.
    """
    level = F.lit(None).cast("array<int>")
    for number, levels in LEVELS.items():
        level = F.when(tier == number, F.array(*map(F.lit, levels))).otherwise(level)
    allowed = F.when(F.coalesce(F.size(permitted_ids), F.lit(0)) > 0, permitted(pool, permitted_ids)).otherwise(pool)

    def turned(p: Column) -> Column:
        hit = lambda m: F.coalesce(F.array_contains(m.concepts_involved, tested), F.lit(False))
        ids = F.concat(F.transform(F.filter(p, hit), lambda m: m.misconception_id), F.transform(F.filter(p, lambda m: ~hit(m)), lambda m: m.misconception_id))
        start = F.pmod((variant - 1) * 3 + tier - 1, F.size(p)).cast("int")
        return T.bound(ids, lambda x: F.concat(F.slice(x, start + 1, F.size(x)), F.slice(x, F.lit(1), start)))

    def made(ids: Column) -> Column:
        taken = F.array_distinct(ids)
        return F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct((i + 1).alias("slot"), F.get(level, i).alias("level"), F.lit("focused").alias("mode"), F.coalesce(F.get(taken, i), F.get(ids, i)).alias("misconception_id")))

    opened = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct((i + 1).alias("slot"), F.get(level, i).alias("level"), F.lit("open").alias("mode"), F.lit(None).cast("string").alias("misconception_id")))
    return F.when(F.coalesce(F.size(pool), F.lit(0)) < 3, opened).otherwise(T.bound(allowed, lambda p: T.bound(turned(p), made)))


def task_grid(anchors: DataFrame, variants: int = 5, tiers: list[int] = TIER_ORDER) -> DataFrame:
    """Anchors times tiers times variants (J10): a generator, not a join."""
    return anchors.withColumn("tier", F.explode(F.array(*map(F.lit, tiers)))).withColumn("variant", F.explode(F.sequence(F.lit(1), F.lit(variants))))


def remaining(tasks: DataFrame, *done: DataFrame, on: str) -> DataFrame:
    """Tasks that no earlier run has."""
    for table in done:
        tasks = tasks.join(table.select(on).distinct(), on, "left_anti")
    return tasks


def upsert(existing: DataFrame, new: DataFrame, on: str) -> DataFrame:
    """Existing rows and the new ones whose key is not there."""
    return existing.unionByName(new.join(existing.select(on).distinct(), on, "left_anti"))


def longest_prefix(rows: DataFrame, key: str, prefixes: dict[str, str], fallback: Column) -> Column:
    """The value of the longest prefix that the key begins with."""
    out = fallback
    for prefix in sorted(prefixes, key=len):
        out = F.when(F.startswith(F.col(key), F.lit(prefix)), prefixes[prefix]).otherwise(out)
    return out


def siblings(rows: DataFrame, id_col: str, group_col: str, near_col: str, take: int, seed: Column, terms: Column | None = None, least_distance: float = 0.5) -> DataFrame:
    """primary, sibling, tier, rank: up to `take` other rows of the group.

    Priorities (tier): 1, the same near_col; 2, another one and a Jaccard distance
    of the terms of at least `least_distance`; 3, the rest.  Each is in the order
    of the ids, turned by the row's seed, and a lower one is used only for what
    the higher ones leave open.  Without terms all distances are 1.

    Rank in a rotation is arithmetic, so in the first priority only neighbours
    within reach are joined: no row meets its whole group.  Only rows with fewer
    than `take` near ones meet the group, as the distances decide who comes first.
    """
    near = Window.partitionBy(group_col, near_col)
    terms = F.lit(None).cast("array<string>") if terms is None else terms
    sized = rows.withColumn("__terms", F.array_distinct(terms)).withColumn("__at", F.row_number().over(near.orderBy(id_col)) - 1).withColumn("__n", F.count("*").over(near)).withColumn("__seed", seed)
    wanted = sized.select(F.col(id_col).alias("primary"), F.col(group_col).alias("g"), F.col(near_col).alias("near"), F.col("__at").alias("at"), F.col("__n").alias("n"), F.col("__seed").alias("seed"), F.col("__terms").alias("own"))
    others = sized.select(F.col(id_col).alias("sibling"), F.col(group_col).alias("g"), F.col(near_col).alias("near_other"), F.col("__at").alias("slot"), F.col("__terms").alias("terms"))
    # in the order of the others (without the row itself) the k-th pick is at pmod(seed + k, n - 1)
    picks = wanted.where("n > 1").select("*", F.posexplode(F.sequence(F.lit(0), F.least(F.lit(take), F.col("n") - 1).cast("int") - 1)).alias("rank", "k"))
    slot = F.pmod(F.col("seed") + F.col("k"), F.col("n") - 1)
    picks = picks.withColumn("slot", F.when(slot >= F.col("at"), slot + 1).otherwise(slot)).withColumnRenamed("near", "near_other")
    first = picks.join(others, ["g", "near_other", "slot"]).select("primary", "sibling", F.lit(1).alias("tier"), "rank")
    short = wanted.where(F.col("n") - 1 < take)
    distance = F.when(F.coalesce(F.size("own"), F.lit(0)) + F.coalesce(F.size("terms"), F.lit(0)) > 0, T.jaccard_distance(F.col("own"), F.col("terms"))).otherwise(1.0)
    far = short.join(others, "g").where(F.col("near") != F.col("near_other")).select("primary", "sibling", "seed", (F.col("n") - 1).cast("int").alias("had"), F.when(distance >= least_distance, 2).otherwise(3).alias("tier"))
    lower = Window.partitionBy("primary", "tier")
    placed = far.withColumn("m", F.count("*").over(lower)).withColumn("rank", F.pmod(F.row_number().over(lower.orderBy("sibling")) - 1 - F.col("seed"), F.col("m")).cast("int"))
    whole = placed.withColumn("rank", F.col("had") + F.row_number().over(Window.partitionBy("primary").orderBy("tier", "rank")) - 1).where(F.col("rank") < take)
    return first.unionByName(whole.select("primary", "sibling", "tier", "rank"))


def short_id(qid: Column) -> Column:
    """At most 64 characters: longer ids keep 57 and a hash."""
    return F.when(F.length(qid) <= 64, qid).otherwise(F.concat(F.substring(qid, 1, 57), F.lit("_"), F.substring(F.md5(qid), 1, 6)))


def chunk_of(position: Column, size: int = 10_000) -> Column:
    """The batch a row belongs to."""
    return F.floor(position / size)


def permitted(pool: Column, concepts: Column, least: int = 3) -> Column:
    """The part of a pool that overlaps the permitted concepts, if enough is left."""
    kept = F.filter(pool, lambda m: F.arrays_overlap(m.concepts_involved, concepts))
    return F.when(F.size(kept) >= least, kept).otherwise(pool)


# How well each kind of angle suits a tier.
ANGLE_AFFINITY = {
    1: {"definitional": 3, "comparison": 2, "exception": 1, "clinical_application": 0, "neuroanatomical": 1, "mechanism": 0},
    2: {"comparison": 3, "definitional": 2, "exception": 2, "neuroanatomical": 1, "clinical_application": 1, "mechanism": 1},
    3: {"clinical_application": 3, "neuroanatomical": 3, "mechanism": 2, "exception": 2, "comparison": 1, "definitional": 0},
    4: {"mechanism": 3, "exception": 3, "comparison": 2, "clinical_application": 2, "neuroanatomical": 1, "definitional": 0},
}


def angle_for(angles: Column, tier: int, variant: Column) -> Column:
    """The angle for a variant (W08): within the best-suited ones while they last, else in
    turn through all, best first."""
    suited = F.lit(0)
    table = F.create_map(*(F.lit(x) for pair in ANGLE_AFFINITY[tier].items() for x in pair))
    ranked = T.bound(angles, lambda a: F.array_sort(F.transform(a, lambda x, i: F.struct((-F.coalesce(F.element_at(table, x), suited)).alias("s"), i.alias("i"), x.alias("angle")))))

    def pick(r: Column) -> Column:
        top = F.filter(r, lambda x: x.s == F.get(r, F.lit(0)).s)
        return F.when(F.size(top) >= variant, F.get(top, (variant - 1).cast("int")).angle).when(F.size(r) > 0, F.get(r, F.pmod(variant - 1, F.size(r)).cast("int")).angle)

    return T.bound(ranked, pick)


def vocabulary(groups: list[Column], each: int, most: int) -> Column:
    """The longest terms of each group, in order, none twice, up to a cap."""
    return F.slice(F.array_distinct(F.concat(*(T.sorted_by_length(g, each) for g in groups))), 1, most)


def template_for(rows: DataFrame, templates: DataFrame, keys: list[str], ord_col: str = "ord") -> DataFrame:
    """The first template whose keys match, a null key of a template matching all.

    Each distinct key asks for itself and for its forms with wildcards, so the
    lookup is an equality join whatever the number of rows and templates.
    """
    asked = rows.select(*keys).distinct()
    forms = F.array(*(F.struct(*((F.col(k) if used >> i & 1 else F.lit(None)).cast(asked.schema[k].dataType).alias(f"__{k}") for i, k in enumerate(keys))) for used in range(1 << len(keys))))
    wild = asked.select(*keys, F.explode(forms).alias("f")).select(*keys, "f.*")
    held = templates.select(*(F.col(k).alias(f"__t_{k}") for k in keys), F.col(ord_col).alias("__ord"), F.col("template").alias("__template"))
    same = lambda left, right: reduce(lambda a, b: a & b, (F.col(left + k).eqNullSafe(F.col(right + k)) for k in keys))
    found = wild.join(held, same("__", "__t_")).groupBy(*keys).agg(F.min_by("__template", "__ord").alias("template"))
    found = found.select(*(F.col(k).alias(f"__k_{k}") for k in keys), "template")
    return rows.join(found, same("", "__k_"), "left").select(*rows.columns, "template")


def first_flagged(rows: DataFrame, score: str, limit: float, ord_col: str, n: int) -> DataFrame:
    """The first n rows in file order below a score, where none or 0 counts as 5."""
    value = F.coalesce(F.nullif(F.col(score).cast("double"), F.lit(0.0)), F.lit(5.0))
    return rows.where(value < limit).orderBy(ord_col).limit(n)
