"""Detectors: each gives an array of signals per question; scan() explodes them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import refdata as R
from quillmill.functions import text as T
from quillmill.operators import gates
from quillmill.operators.questions import by_tier, correct, distractors

SIGNAL = "struct<detector_id:string,letter:string,fired:boolean,confidence:double,signature:string,verdict_action:string,proposed_class:string,reason:string,extra:map<string,string>>"
ACTIONS = ("block", "override_to", "advisory")


def signal(detector: str, letter: Column, fired: Column, confidence: Column | float, signature: Column | str, action: Column | str, proposed: Column | str | None = None, reason: Column | str = "") -> Column:
    """One signal row of the contract (D01); a signal that did not fire has confidence 0."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    fired = F.coalesce(fired, F.lit(False))
    return F.struct(
        F.lit(detector).alias("detector_id"), letter.alias("letter"), fired.alias("fired"), F.when(fired, lit(confidence)).otherwise(0.0).cast("double").alias("confidence"),
        F.when(fired, lit(signature)).alias("signature"), lit(action).alias("verdict_action"), lit(proposed).cast("string").alias("proposed_class"), F.when(fired, lit(reason)).otherwise("no_signal").alias("reason"), F.lit(None).cast("map<string,string>").alias("extra"),
    )


def valid_signal(s: Column) -> Column:
    """The contract as a predicate: known action, a class for an override, confidence in [0, 1]."""
    return s.verdict_action.isin(*ACTIONS) & ((s.verdict_action != "override_to") | s.proposed_class.isNotNull()) & s.confidence.between(0.0, 1.0)


def _words(items: list[str]) -> str:
    return r"(?i)\b(" + "|".join(items) + r")\b"


def _whole(word: str) -> str:
    return rf"(?i)\b\Q{word}\E\b"


# --- the four scanners of a stem and a distractor; null: nothing found


def quantifier_signature(stem: Column, text: Column) -> Column:
    """A quantifier in the distractor against a concrete case in the stem."""
    return F.when(text.rlike(_words(R.QUANTIFIERS)) & T.specific_case(stem).isNotNull(), F.concat(F.lit("universal:"), F.lower(F.regexp_extract(text, _words(R.QUANTIFIERS), 1))))


def laterality_signature(stem: Column, text: Column) -> Column:
    """Opposite sides, both directions; handedness in the stem does not count."""
    clean = F.regexp_replace(stem, R.HANDEDNESS, "")
    found = F.lit(None).cast("string")
    for a, b in reversed(R.LATERAL_PAIRS):
        for x, y in ((b, a), (a, b)):
            # The distractor first: it is short and seldom has a side, so the stem is seldom read.
            found = F.when(text.rlike(_whole(y)) & clean.rlike(_whole(x)), f"laterality:'{x}'(stem)_vs_'{y}'(distractor)").otherwise(found)
    return found


def ratio_signature(stem: Column, text: Column) -> Column:
    """Some ratio of the stem differs from some ratio of the distractor."""
    ratios = lambda t: F.regexp_extract_all(t, F.lit(r"\b(\d+:\d+)\b"), 1)
    return F.when(F.exists(ratios(stem), lambda a: F.exists(ratios(text), lambda b: a != b)), "ratio_mismatch")


def stage_signature(stem: Column, text: Column) -> Column:
    """The stem's stage against the later one, in this direction only."""
    found = F.lit(None).cast("string")
    for a, b in reversed(R.STAGE_PAIRS):
        found = F.when(text.rlike(_whole(b)) & stem.rlike(_whole(a)) & ~stem.rlike(_whole(b)), f"stage_timing:'{a}'(stem)_vs_'{b}'(distractor)").otherwise(found)
    return found


SCANNERS: list[tuple[str, float, Callable[[Column, Column], Column]]] = [("universal_quantifier", 0.85, quantifier_signature), ("laterality", 0.75, laterality_signature), ("numeric_ratio", 0.80, ratio_signature), ("stage_timing", 0.65, stage_signature)]


def first_signature(stem: Column, text: Column) -> Column:
    """struct(signature, confidence, reason) of the first scanner that finds something."""
    kind = "struct<signature:string,confidence:double,reason:string>"
    found = lambda name, c: lambda reason: F.when(reason.isNotNull(), F.struct(F.lit(name).alias("signature"), F.lit(c).alias("confidence"), reason.alias("reason")))
    return F.coalesce(*(T.bound(scan(stem, text), found(name, c)) for name, c, scan in SCANNERS), F.lit(None).cast(kind))


def english_gap() -> Column:
    """One signal per distractor; an override where the tier's threshold is reached."""
    wrong = F.filter("options", lambda o: ~F.coalesce(o.is_correct, F.lit(False)))
    threshold = by_tier(R.OVERRIDE_THRESHOLD, 0.75)

    def one(o: Column) -> Column:
        def told(s: Column) -> Column:
            strong = (s.signature != "stage_timing") & (s.confidence >= threshold)
            return signal("english_gap_scanner", o.letter, s.isNotNull(), s.confidence, s.signature, F.when(strong, "override_to").otherwise("advisory"), F.when(strong, "english_gap"), s.reason)

        return T.bound(first_signature(F.col("question_stem"), o.text), told)

    return F.transform(wrong, one)


def stem_pairs(stem: Column, brief_pairs: list[tuple[str, str]] = ()) -> Column:
    """array of (pair, confidence, pattern): the label pairs that begin in the stem within 200 characters of each other, in the
    order in which they decide: brief pairs, the fixed ones, the upper-case ones, which are case-sensitive.  pattern finds one
    of the two in a distractor."""
    tiers = [(list(brief_pairs), 1.0, "(?i)"), (R.LABEL_PAIRS, 0.5, "(?i)"), (R.UPPERCASE_PAIRS, 0.5, "")]

    def near(low: Column) -> Column:
        found = []
        for pairs, confidence, flag in tiers:
            for a, b in pairs:
                both = F.contains(low, F.lit(a.lower())) & F.contains(low, F.lit(b.lower()))  # cheaper than the pattern
                told = F.struct(F.lit(f"{a}|{b}").alias("pair"), F.lit(confidence).alias("confidence"), F.lit(rf"{flag}\b(?:\Q{a}\E|\Q{b}\E)\b").alias("pattern"))
                found.append(F.when(both & stem.rlike(T.begin_within(rf"\Q{a}\E", rf"\Q{b}\E", 200, flag)), told))
        return F.filter(F.array(*found), lambda x: x.isNotNull())

    return T.bound(F.lower(stem), near)


def first_pair(near: Column, text: Column) -> Column:
    """struct(pair, confidence, blocked) of the first of stem_pairs() of which the distractor has a label."""
    own = F.get(F.filter(near, lambda x: F.regexp_like(text, x.pattern)), F.lit(0))
    return T.bound(own, lambda x: F.when(x.isNotNull(), F.struct(x.pair.alias("pair"), x.confidence.alias("confidence"), text.rlike(_words(R.LABEL_QUANTIFIERS)).alias("blocked"))))


def label_pair(stem: Column, text: Column, brief_pairs: list[tuple[str, str]] = ()) -> Column:
    """first_pair() for one distractor."""
    return T.bound(stem_pairs(stem, brief_pairs), lambda near: first_pair(near, text))


def schema_labeling(brief_pairs: list[tuple[str, str]] = ()) -> Column:
    """Override to content_gap on a label pair, unless a quantifier blocks it."""
    wrong = F.filter("options", lambda o: ~F.coalesce(o.is_correct, F.lit(False)))

    def one(near: Column, o: Column) -> Column:
        return T.bound(first_pair(near, o.text), lambda s: signal("schema_labeling", o.letter, s.isNotNull() & ~s.blocked, s.confidence, "schema_labeling", "override_to", "content_gap", s.pair))

    # The stem's pairs are looked for once a question, and few stems have any.
    return T.bound(stem_pairs(F.col("question_stem"), brief_pairs), lambda near: F.transform(wrong, lambda o: one(near, o)))


def from_gate(name: str, gate: Column, confidence: float) -> Column:
    """A gate's failure as a blocking signal."""
    return F.array(signal(name, F.lit(None).cast("string"), ~gate.ok, confidence, name, "block", None, gate.reason))


def numeric_overlap() -> Column:
    """Two options name instruments whose age ranges cover an age of the stem."""
    years = T.ages(F.col("question_stem"))
    table = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(a).alias("low"), F.lit(b).alias("high")) for n, (a, b) in R.INSTRUMENT_AGES.items()))
    # Instruments of the stem's ages once a question: most stems have none, so no option is read.
    live = T.bound(years, lambda ys: F.filter(table, lambda r: F.exists(ys, lambda y: y.between(r.low, r.high))))
    covered = T.bound(live, lambda rs: F.filter("options", lambda o: F.exists(rs, lambda r: F.regexp_like(F.lower(o.text), F.concat(F.lit(r"\b\Q"), r["name"], F.lit(r"\E\b"))))))
    action = F.when(F.col("difficulty_tier") == 4, "advisory").otherwise("block")
    return T.bound(F.transform(covered, lambda o: o.letter), lambda x: F.array(signal("numeric_overlap", F.lit(None).cast("string"), F.size(x) >= 2, 0.9, "numeric_overlap", action, None, F.array_join(x, ","))))


def imperative_lead() -> Column:
    """A distractor that begins with an order."""
    wrong = F.filter("options", lambda o: ~F.coalesce(o.is_correct, F.lit(False)))
    return F.transform(wrong, lambda o: signal("imperative_lead", o.letter, o.text.rlike(R.IMPERATIVE_LEAD), 0.95, "imperative_lead", "block", None, F.lower(F.regexp_extract(o.text, R.IMPERATIVE_LEAD, 1))))


def meta_evaluative() -> Column:
    """A stem that speaks about its options."""
    return F.array(signal("meta_evaluative", F.lit(None).cast("string"), F.col("question_stem").rlike(R.META_TOKENS), 1.0, "meta_evaluative", "block", None, F.lower(F.regexp_extract("question_stem", R.META_TOKENS, 1))))


def lead_form_parallelism() -> Column:
    """Options that begin in different ways."""
    shapes = F.array_distinct(F.transform("options", lambda o: T.lead_shape(o.text)))
    return F.array(signal("lead_form_parallelism", F.lit(None).cast("string"), F.size(shapes) >= 2, 0.6, "lead_form_parallelism", "advisory", None, F.array_join(F.array_sort(shapes), ",")))


def defensible_alternative(source: Column | None = None) -> Column:
    """Tier 4: two distractors that share three words with the tested fact."""
    words = lambda t: F.filter(F.array_distinct(F.regexp_extract_all(F.lower(t), F.lit("[a-zà-öø-ÿ][a-zà-öø-ÿ0-9-]+"), 0)), lambda w: (F.length(w) >= 5) & ~w.isin(*R.ALTERNATIVE_STOP))
    own = words(F.col("question_stem") if source is None else source)
    close = F.filter(distractors(), lambda t: F.size(F.array_intersect(words(t), own)) >= 3)
    return F.array(signal("defensible_alternative", F.lit(None).cast("string"), (F.col("difficulty_tier") == 4) & (F.size(close) >= 2), 0.4, "defensible_alternative", "advisory", None, F.size(close).cast("string")))


#: Builders by phase; registering a name again replaces it.
REGISTRY: dict[str, tuple[Callable[[], Column], tuple[str, ...]]] = {
    "english_gap_scanner": (english_gap, ("audit",)),
    "schema_labeling": (schema_labeling, ("audit",)),
    "laterality_integrity": (lambda: from_gate("laterality_integrity", gates.laterality(), 0.9), ("generation", "audit")),
    "universal_denial": (lambda: from_gate("universal_denial", gates.universal_denial(), 0.9), ("generation", "audit")),
    "numeric_overlap": (numeric_overlap, ("generation", "audit")),
    "imperative_lead": (imperative_lead, ("generation", "audit")),
    "meta_evaluative": (meta_evaluative, ("generation", "audit")),
    "lead_form_parallelism": (lead_form_parallelism, ("generation", "audit")),
    "defensible_alternative": (defensible_alternative, ("audit",)),
}


def scan(questions: DataFrame, phase: str = "audit", registry: dict = REGISTRY) -> DataFrame:
    """One row per question and signal, all detectors of the phase in one pass."""
    builders = [build for build, phases in registry.values() if phase in phases]
    every = questions.withColumn("__signals", F.concat(*(build() for build in builders)))
    return every.select("question_id", "difficulty_tier", F.explode("__signals").alias("s")).select("question_id", "difficulty_tier", "s.*")


def blocking(signals: DataFrame) -> DataFrame:
    """Fired signals that fail a question, as (question_id, gate, reason)."""
    return signals.where(F.col("fired") & F.col("verdict_action").isin("block", "override_to")).select("question_id", F.concat(F.lit("detector:"), "detector_id").alias("gate"), "reason")


__all__ = ["REGISTRY", "SIGNAL", "blocking", "correct", "scan", "signal", "valid_signal"]
