"""All 22 gates over whole records, in their order.

A record has question_id, difficulty_tier, stem_pattern, question_stem,
tested_concept (concept_id, knowledge_tested), options (letter, text, is_correct,
explanation, concept_id, misconception_id, misconception_label,
misconception_type, confused_with, distractor_level), flashcard_seeds (a map of
front and back), topic_keywords, and what its brief and its surroundings say:
brief_ids, brief_labels (a map), testable_fact, domain_vocab, brief_terms, source,
gate_action, eliminable (the letters that a judge of stem contradictions flagged; null
where none was asked) and known (whether the id exists already).  Missing parts are nulls.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.functions import text as T
from quillmill.operators import gates as G
from quillmill.operators.questions import correct

OPTION = "struct<letter:string,text:string,is_correct:boolean,explanation:string,concept_id:string,misconception_id:string,misconception_label:string,misconception_type:string,confused_with:string,distractor_level:int>"
WORDS = "array<string>"


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def _first(reasons: Column) -> Column:
    return F.get(F.filter(reasons, lambda r: r.isNotNull()), F.lit(0))


def _wrong() -> Column:
    return F.filter("options", lambda o: ~F.coalesce(o.is_correct, F.lit(False)))


def structure() -> Column:
    """A stem, four options, one of them correct, a tested concept with an id (G01, prerequisite)."""
    plain = G.structure()
    reason = F.coalesce(plain.reason, F.when(F.col("tested_concept").isNull(), "structure: no tested concept").when(_blank(F.col("tested_concept.concept_id")), "structure: tested concept without id"))
    return G.verdict(reason.isNotNull(), reason)


def content_quality() -> Column:
    """Flashcards for concept, comparison and nuance with fronts of 20 and backs of 40
    characters; three keywords or more, each of two characters or more (G02, prerequisite)."""

    def card(kind: str) -> Column:
        seed = F.element_at("flashcard_seeds", kind)
        return (
            F.when(seed.isNull(), f"content_quality: no {kind} card").when(_blank(seed.front) | _blank(seed.back), f"content_quality: empty {kind} card")
            .when(F.length(seed.front) < 20, f"content_quality: short front of {kind} card").when(F.length(seed.back) < 40, f"content_quality: short back of {kind} card")
        )

    words = F.when(F.coalesce(F.size("topic_keywords"), F.lit(0)) < 3, "content_quality: few keywords").when(F.exists("topic_keywords", lambda k: F.coalesce(F.length(k), F.lit(0)) < 2), "content_quality: empty keyword")
    reason = F.when(F.col("flashcard_seeds").isNull(), "content_quality: no cards").otherwise(_first(F.array(*map(card, ("concept", "comparison", "nuance")), words)))
    return G.verdict(reason.isNotNull(), reason)


def consistency() -> Column:
    """The correct option has the tested concept and nothing of a distractor; every distractor
    has all of its fields, of known kinds, and no misconception stands twice (G03, prerequisite)."""
    right = F.get(F.filter("options", lambda o: o.is_correct), F.lit(0))

    def fault(o: Column) -> Column:
        missing = [F.when(_blank(o[f]), F.concat(F.lit("consistency: "), o.letter, F.lit(f" without {f}"))) for f in ("misconception_id", "concept_id", "confused_with", "misconception_label")]
        kind = F.when(~F.coalesce(o.misconception_type.isin(*R.MISCONCEPTION_TYPES), F.lit(False)), F.concat(F.lit("consistency: "), o.letter, F.lit(" of unknown misconception_type")))
        level = F.when(~F.coalesce(o.distractor_level.between(1, 4), F.lit(False)), F.concat(F.lit("consistency: "), o.letter, F.lit(" of unknown distractor_level")))
        return F.coalesce(*missing, kind, level)

    ids = F.transform(_wrong(), lambda o: o.misconception_id)
    own = F.when(right.isNull(), "consistency: no correct option").when(_blank(right.concept_id), "consistency: correct option without concept").when(right.concept_id != F.coalesce(F.col("tested_concept.concept_id"), F.lit("")), "consistency: another concept")
    stray = F.coalesce(*(F.when(right[f].isNotNull(), f"consistency: correct option with {f}") for f in ("distractor_level", "confused_with", "misconception_id", "misconception_type")))
    reason = F.coalesce(own, stray, _first(F.transform(_wrong(), fault)), F.when(F.size(F.array_distinct(ids)) != F.size(ids), "consistency: repeated misconception"))
    return G.verdict(reason.isNotNull(), reason)


def technical_terms() -> Column:
    """Words of five letters and more of the brief's labels and fact, without general ones."""
    labels = F.coalesce(F.array_join(F.map_values("brief_labels"), " "), F.lit(""))
    return F.array_except(T.token_set(F.concat_ws(" ", labels, "testable_fact"), 5), T.words_array(R.GENERAL_TERMS))


def domain_expertise() -> Column:
    """From tier 3 on two technical terms in the answer and its explanation, where the brief has any; the metric
    tells how many, so that tier 2 can be warned (G12)."""
    text = F.lower(F.concat_ws(" ", correct(), correct("explanation")))

    def of(terms: Column) -> Column:
        hits = F.size(F.filter(terms, lambda t: F.contains(text, t)))
        return G.verdict((F.col("difficulty_tier") >= 3) & (F.size(terms) > 0) & (hits < 2), "domain_expertise: few terms", F.when(F.size(terms) > 0, hits))

    return T.bound(technical_terms(), of)


def canonical_terms() -> Column:
    both = F.concat(F.coalesce("domain_vocab", F.array().cast(WORDS)), F.coalesce("brief_terms", F.array().cast(WORDS)))
    return F.array_distinct(F.transform(F.filter(both, lambda t: ~_blank(t)), F.lower))


def _not_listing(gate: Column) -> Column:
    """A gate that questions listing features are exempt from."""
    exempt = F.coalesce(F.col("stem_pattern") == "feature_listing", F.lit(False))
    return T.bound(gate, lambda g: F.struct((g.ok | exempt).alias("ok"), F.when(~exempt, g.reason).alias("reason"), g.metric.alias("metric")))


def stem_eliminable() -> Column:
    """No distractor that the stem alone refutes, unless the policy skips the cell."""
    n = F.size(F.coalesce("eliminable", F.array().cast(WORDS)))
    return G.verdict((n > 0) & ~F.coalesce(F.col("gate_action") == "skip", F.lit(False)), F.concat(F.lit("stem_eliminable_distractor: "), F.array_join("eliminable", ",")), n)


def distractor_mix() -> Column:
    """The distractors' levels against the tier's; it never fails, the warning says what is there."""
    return G.verdict(F.lit(False), "")


def chain(whitelist: Iterable[str] = (), fold: bool = False) -> list[tuple[str, Column, bool]]:
    """Name, gate and whether a failure stops the chain, in order.  fold: see apply_identity."""
    brief_ids, labels = F.coalesce("brief_ids", F.array().cast(WORDS)), F.coalesce("brief_labels", F.expr(G.NO_LABELS))
    return [
        ("structure", structure(), True), ("content_quality", content_quality(), True), ("consistency", consistency(), True),
        ("anchor_grounding", G.anchor_grounding(F.coalesce("tested_concept.concept_id", F.lit("")), brief_ids), False), ("attribution", G.attribution(whitelist, F.col("tested_concept.knowledge_tested")), False),
        ("option_length_balance", G.length_balance(), False), ("blooms_cognitive_level", G.apply_level(brief_ids, labels), False), ("remember_identity", G.remember_identity(), False),
        ("understand_identity", G.understand_identity(), False), ("apply_identity", G.apply_identity(fold), False), ("evaluate_identity", G.evaluate_identity(), False), ("domain_expertise", domain_expertise(), False),
        ("scope_match", G.scope_match(F.coalesce("stem_pattern", F.lit("")), labels), False), ("option_claim", G.option_claim(), False), ("originality", G.originality(F.coalesce(F.nullif("source", F.lit("")), "testable_fact", F.lit(""))), False),
        ("topic_realm", _not_listing(G.topic_realm(F.transform(F.coalesce("brief_terms", F.array().cast(WORDS)), F.lower))), False), ("stem_keyword_distribution", _not_listing(G.stem_keywords(canonical_terms())), False),
        ("laterality_integrity", G.laterality(), False), ("universal_denial", G.universal_denial(), False), ("stem_eliminable_distractor", stem_eliminable(), False), ("distractor_mix", distractor_mix(), False),
        ("uniqueness", G.verdict(F.coalesce("known", F.lit(False)), "uniqueness: id exists"), True),
    ]


def _named(name: str, first: bool) -> Callable[[Column], Column]:
    return lambda g: F.struct(F.lit(name).alias("gate"), g.ok.alias("ok"), g.reason.alias("reason"), g.metric.alias("metric"), F.lit(first).alias("first"))


def check_records(records: DataFrame, whitelist: Iterable[str] = (), only: Callable[[str], bool] | None = None, fold: bool = False) -> DataFrame:
    """question_id, failures (gate, reason) in order, cut after the first failing prerequisite, and
    warnings: tier 2 answers with few terms, a third to a half of the source repeated, an odd mix of levels (G12, G15, G21, G24).

    Each gate is computed once a record, whatever reads its parts.  only: which gates take part, by name.
    fold: see apply_identity.
    """
    gates = [g for g in chain(whitelist, fold) if only is None or only(g[0])]
    told = F.array(*(T.bound(gate, _named(name, first)) for name, gate, first in gates))
    checked = records.select("question_id", "difficulty_tier", F.transform(_wrong(), lambda o: o.distractor_level).alias("levels"), F.explode(F.array(told)).alias("told"))  # the generator keeps the gates from being computed again by each reader
    failed = F.filter("told", lambda g: ~g.ok)
    stop = lambda f: F.array_position(F.transform(f, lambda g: g.first), True)
    cut = T.bound(failed, lambda f: F.slice(f, F.lit(1), F.when(stop(f) > 0, stop(f).cast("int")).otherwise(F.size(f))))
    metric = lambda name: F.get(F.filter("told", lambda g: g.gate == name), F.lit(0)).metric
    mix = G.distractor_mix(F.filter("levels", lambda x: x.isNotNull()), {t: [*x] for t, x in R.DISTRACTOR_MIX.items()})
    warned = F.array(F.when((F.col("difficulty_tier") == 2) & (metric("domain_expertise") < 2), "domain_expertise"), F.when(metric("originality").between(0.3, 0.5) & (metric("originality") < 0.5), "originality"), F.when(mix.isNotNull(), "distractor_mix"))
    ran = ~F.exists("told", lambda g: g.first & ~g.ok & (g.gate != "uniqueness"))  # a prerequisite that fails stops those after it
    return checked.select("question_id", F.transform(cut, lambda g: F.struct(g.gate.alias("gate"), g.reason.alias("reason"))).alias("failures"), F.filter(warned, lambda w: w.isNotNull() & ran).alias("warnings"))
