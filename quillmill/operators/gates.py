"""Row gates: every one is a struct (ok, reason, metric); reason is null when ok."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import attribution as A
from quillmill.functions import refdata as R
from quillmill.functions import text as T
from quillmill.operators.questions import all_texts, by_tier, correct, distractors

Gate = Column


def verdict(fails: Column, reason: Column | str, metric: Column | None = None) -> Gate:
    fails = F.coalesce(fails, F.lit(False))
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct((~fails).alias("ok"), F.when(fails, reason).alias("reason"), (F.lit(None) if metric is None else metric).cast("double").alias("metric"))


def structure() -> Gate:
    """A stem, four options, one of them correct (G01, prerequisite)."""
    rights = F.size(F.filter("options", lambda o: o.is_correct))
    reason = F.when(F.coalesce(F.trim("question_stem"), F.lit("")) == "", "structure: no stem").when(F.coalesce(F.size("options"), F.lit(0)) != 4, "structure: not four options").when(rights != 1, "structure: not one correct option")
    return verdict(reason.isNotNull(), reason, rights)


def unique_misconceptions(field: str = "misconception_id") -> Gate:
    """No misconception twice among the distractors (part of G03, prerequisite)."""
    own = distractors(field)
    return verdict(F.size(F.array_distinct(own)) != F.size(own), "consistency: repeated misconception", F.size(F.array_distinct(own)))


def length_balance() -> Gate:
    """Longest over shortest option above 1.7, or the correct one above 1.2 of the longest
    distractor; a question with an empty option passes (G06)."""
    size = F.transform("options", lambda o: F.length(o.text))
    ratio = F.array_max(size) / F.nullif(F.array_min(size), F.lit(0))
    longer = F.length(correct()) > F.array_max(F.transform(distractors(), F.length)) * 1.2
    return verdict((F.array_min(size) > 0) & ((ratio > 1.7) | longer), F.when(ratio > 1.7, "option_length_balance: ratio").otherwise("option_length_balance: correct"), ratio)


NO_IDS, NO_LABELS = "cast(array() as array<string>)", "cast(map() as map<string,string>)"


def concepts_named(text: Column, ids: Column, labels: Column) -> Column:
    """The concepts whose id has a part, or whose label a word, of four letters or more
    that stands somewhere in the lower-case text (F03, F05)."""
    low = F.lower(F.coalesce(text, F.lit("")))
    by_id = F.filter(ids, lambda c: F.exists(T.slug_tokens(c, 4), lambda t: F.contains(low, t)))
    by_label = F.filter(F.map_keys(labels), lambda c: F.exists(T.tokens(F.element_at(labels, c), 4), lambda w: F.contains(low, w)))
    return F.array_union(by_id, by_label)


def apply_level(ids: Column | None = None, labels: Column | None = None) -> Gate:
    """Tier 3 answers need a whole word of applying or comparing; tier 4 needs two of the
    brief's concepts in stem, answer and its explanation, where the brief is known (G07)."""
    ids, labels = F.expr(NO_IDS) if ids is None else ids, F.expr(NO_LABELS) if labels is None else labels
    words = F.array_distinct(F.split(F.lower(correct()), r"[^\p{L}\p{N}_]+"))
    phrases = [w for w in R.APPLY_INDICATORS if " " in w]
    applied = F.size(F.array_intersect(words, T.words_array(R.APPLY_INDICATORS))) + sum((F.contains(F.lower(correct()), F.lit(p)).cast("int") for p in phrases), F.lit(0))
    named = F.size(concepts_named(F.concat_ws(" ", "question_stem", correct(), correct("explanation")), ids, labels))
    known = (F.size(ids) > 0) | (F.size(labels) > 0)
    third, fourth = (F.col("difficulty_tier") == 3) & (applied == 0), (F.col("difficulty_tier") == 4) & known & (named < 2)
    return verdict((F.size("options") == 4) & (third | fourth), F.when(third, "blooms_cognitive_level: definition only").otherwise("blooms_cognitive_level: one concept"), F.when(F.col("difficulty_tier") == 4, named).otherwise(applied))


def remember_identity() -> Gate:
    """Tier 1: no scenario in the stem, no forward-looking verb first."""
    scenario = F.col("question_stem").rlike(R.SCENARIO_CASED) | F.col("question_stem").rlike(R.REMEMBER_SCENARIO)
    first = F.regexp_extract(F.lower(F.trim(correct())), r"^([a-z]+)", 1)
    verb = first.isin(*R.FORWARD_VERBS)
    return verdict((F.col("difficulty_tier") == 1) & (scenario | verb), F.when(scenario, "remember_identity: scenario").otherwise("remember_identity: verb"), scenario.cast("int") + verb.cast("int"))


def understand_identity() -> Gate:
    """Tier 2: at most 280 characters and 40 words, no evaluative framing."""
    words = F.when(F.trim("question_stem") == "", 0).otherwise(F.size(F.split(F.trim("question_stem"), r"\s+")))
    framed = F.col("question_stem").rlike(R.EVALUATIVE)
    return verdict((F.col("difficulty_tier") == 2) & ((F.length("question_stem") > 280) | (words > 40) | framed), "understand_identity: long or evaluative", words)


def apply_identity(fold: bool = False) -> Gate:
    """Tier 3: a scenario, an application verb with four content words after it, a mechanism.

    The words are those of `text.tokens`, so one with an ß or a letter of Latin Extended is none.  fold: letters
    from À to ɏ count as any other letter does.
    """
    plain = T.folded if fold else lambda t: t
    scenario = F.col("question_stem").rlike(R.SCENARIO_CASED) | plain(F.col("question_stem")).rlike(R.APPLY_SCENARIO)
    # each occurrence of a verb counts with what follows it
    parts = F.split(plain(F.lower(correct())), r"\b(?:" + "|".join(R.APPLICATION_VERBS) + r")\b")
    after = F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))), lambda i: F.size(T.tokens(F.array_join(F.slice(parts, i, 1000), " "), 5, R.FULL_STOP)))
    most = F.when(F.size(parts) > 1, F.array_max(after)).otherwise(-1)
    mechanism = plain(correct()).rlike(R.MECHANISM)
    reason = F.when(~scenario, "apply_identity: no scenario").when(most < 4, "apply_identity: bare label").when(~mechanism, "apply_identity: no mechanism")
    return verdict((F.col("difficulty_tier") == 3) & reason.isNotNull(), reason, most)


def evaluate_identity() -> Gate:
    """Tier 4: two sentences, a conjunction or a competing claim."""
    stops = F.length("question_stem") - F.length(F.translate("question_stem", ".?!", ""))
    rich = (stops >= 2) | F.col("question_stem").rlike(R.CONJUNCTIVE) | F.col("question_stem").rlike(R.COMPETING)
    return verdict((F.col("difficulty_tier") == 4) & ~rich, "evaluate_identity: simple stem", stops)


def domain_expertise(terms: Column, least: int = 2) -> Gate:
    """Tier 3 and up: two technical terms in the answer and its explanation."""
    text = F.lower(F.concat_ws(" ", correct(), correct("explanation")))
    hits = F.size(F.filter(terms, lambda t: F.contains(text, F.lower(t))))
    return verdict((F.col("difficulty_tier") >= 3) & (hits < least), "domain_expertise: few terms", hits)


def option_claim() -> Gate:
    """No reasoning in an option's text."""
    found = F.filter(all_texts(), lambda t: t.rlike(R.REASONING))
    return verdict(F.size(found) > 0, "option_claim: reasoning", F.size(found))


def originality(source: Column) -> Gate:
    """Five-word runs of the source that the question, its explanations included, repeats;
    half or more fails (G15).  From 0.3 on the metric is a warning."""
    options = F.transform("options", lambda o: F.concat_ws(" ", o.text, o.explanation))
    produced = T.ngrams(T.tokens(F.concat_ws(" ", F.col("question_stem"), F.array_join(options, " ")), 1, R.LIGHT_STOP))
    own = T.ngrams(T.tokens(source, 1, R.LIGHT_STOP))
    share = F.size(F.array_intersect(own, produced)) / F.nullif(F.size(own), F.lit(0))
    return verdict(F.coalesce(share, F.lit(0.0)) >= 0.5, "originality: copied", share)


def topic_realm(terms: Column | None = None) -> Gate:
    """The answer shares far more words with the stem, and with the brief's lower-case terms, than the distractors do."""
    words = lambda t: T.token_set(t, 4, R.FULL_STOP)
    sets = F.struct((words(F.col("question_stem")) if terms is None else F.array_union(terms, words(F.col("question_stem")))).alias("realm"), words(correct()).alias("own"), F.filter(F.transform(distractors(), words), lambda s: F.size(s) >= 5).alias("valid"))

    def of(x: Column) -> Gate:
        share = lambda s: F.size(F.array_intersect(s, x.realm)) / F.nullif(F.size(s), F.lit(0))
        mean = F.aggregate(F.transform(x.valid, share), F.lit(0.0), lambda a, y: a + y) / F.nullif(F.size(x.valid), F.lit(0))
        usable = (F.size(x.realm) >= 3) & (F.size(x.own) >= 5) & (F.size(x.valid) >= 3) & ~F.col("question_stem").rlike(R.EXCEPT_GATE)
        return T.bound(F.struct(mean.alias("mean"), F.when(usable, share(x.own) - mean).alias("gap")), lambda m: verdict((m.mean < 0.5) & (m.gap >= by_tier(R.REALM_GAP, 0.25)), "topic_realm: gap", m.gap))

    return T.bound(sets, of)


def stem_keywords(canonical: Column | None = None) -> Gate:
    """Stem words that only the correct option repeats; from tier 3 on only those of the
    canonical terms, if there are any (G17)."""
    floor = by_tier(R.STEM_KEYWORD_FLOOR, 7)
    texts = F.transform(distractors(), F.lower)
    own = F.filter(T.token_set(F.col("question_stem"), 5, R.FULL_STOP), lambda w: (F.length(w) >= floor) & F.contains(F.lower(correct()), w) & ~T.appears_in(w, texts))
    strict = F.filter(own, lambda w: ~w.isin(*R.GENERIC_WORDS))
    strict = strict if canonical is None else T.bound(canonical, lambda c: F.when(F.size(c) > 0, F.array_intersect(strict, c)).otherwise(strict))
    own = F.when(F.col("difficulty_tier") >= 3, strict).otherwise(own)
    return T.bound(own, lambda k: verdict((F.size(k) >= by_tier(R.STEM_KEYWORD_LIMIT, 2)) & ~F.col("question_stem").rlike(R.EXCEPT_GATE), "stem_keyword_distribution: only in correct", F.size(k)))


def answer_keywords() -> Gate:
    """Content words that only the correct option has (G23; off in the pipeline)."""
    floor = by_tier({1: 5, 2: 5, 3: 7, 4: 7}, 7)
    texts = F.transform(distractors(), F.lower)
    own = F.filter(T.token_set(correct(), 5, R.FULL_STOP), lambda w: (F.length(w) >= floor) & ~T.appears_in(w, texts))
    return verdict((F.size(own) >= by_tier(R.KEYWORD_LIMIT, 3)) & ~F.col("question_stem").rlike(R.EXCEPT_GATE), "keyword_distribution: only in correct", F.size(own))


def laterality() -> Gate:
    """A stem with one of bilateral and unilateral, a distractor with the other."""
    both = [r"(?i)\bbilateral(?:ly)?\b", r"(?i)\bunilateral(?:ly)?\b"]
    stem = [F.col("question_stem").rlike(p) for p in both]
    other = [F.exists(distractors(), _matches(p)) for p in both]
    fails = (stem[0] & ~stem[1] & other[1]) | (stem[1] & ~stem[0] & other[0])
    return verdict(fails, "laterality_integrity: opposite term")


def _matches(pattern: str):
    return lambda t: t.rlike(pattern)


def universal_denial() -> Gate:
    """A preserved ability in the stem that a distractor denies altogether.

    Quantifier and verb begin at most 80 characters apart, in either order.
    """
    near = T.begin_within(R.DENIAL_QUANTIFIER, R.DENIAL_VERB, 80, "(?i)")
    stem_words = T.token_set(F.col("question_stem"), 6, R.FULL_STOP)
    hit = F.filter(distractors(), lambda t: t.rlike(near) & F.arrays_overlap(T.token_set(t, 6, R.FULL_STOP), stem_words))
    return verdict(F.col("question_stem").rlike(R.PRESERVATION) & (F.size(hit) > 0), "universal_denial: denied", F.size(hit))


# --- gates that need more of the record than the derived view has


def content_quality() -> Gate:
    """Three flashcards with fronts of 20 and backs of 40 characters, three keywords (G02, prerequisite).

    Columns: flashcard_seeds (array of front and back), topic_keywords.
    """
    cards = F.coalesce(F.size("flashcard_seeds"), F.lit(0)) >= 3
    long = F.forall("flashcard_seeds", lambda c: (F.length(c.front) >= 20) & (F.length(c.back) >= 40))
    words = F.size(F.filter("topic_keywords", lambda k: F.length(k) > 1))
    reason = F.when(~cards, "content_quality: few flashcards").when(~F.coalesce(long, F.lit(False)), "content_quality: short flashcard").when(F.coalesce(words, F.lit(0)) < 3, "content_quality: few keywords")
    return verdict(reason.isNotNull(), reason, words)


def anchor_grounding(concept: Column, brief_ids: Column) -> Gate:
    """The tested concept is one of the brief's; passes where the brief is unknown."""
    return verdict((F.size(brief_ids) > 0) & ~F.array_contains(brief_ids, concept), "anchor_grounding: concept not in brief")


def scope_match(pattern: Column, labels: Column) -> Gate:
    """Comparing stems whose answer names two concepts or more (labels: id to label): each
    distractor names as many if that is two, else one fewer at least (G13)."""
    hits = lambda t: F.size(concepts_named(t, F.expr(NO_IDS), labels))
    own = hits(correct())
    need = F.when(own <= 2, own).otherwise(own - 1)
    short = F.filter(distractors(), lambda t: hits(t) < need)
    fails = pattern.isin("comparison", "contrast_prompt", "best_answer") & (F.size("options") == 4) & (own >= 2) & (F.size(short) > 0)
    return verdict(fails, "scope_match: narrower distractor", F.size(short))


def attribution(whitelist: Iterable[str] = (), knowledge: Column | None = None) -> Gate:
    """No attribution to somebody off the whitelist in stem, tested knowledge, options and
    explanations; the reason names the first three, the metric counts all (G05)."""
    where = [(F.lit("stem"), F.col("question_stem")), (F.lit("tested_concept"), F.lit("") if knowledge is None else knowledge)]
    fixed = F.array(*(F.struct(n.alias("place"), t.cast("string").alias("text")) for n, t in where))
    own = F.flatten(F.transform("options", lambda o: F.array(F.struct(F.concat(F.lit("opt_"), o.letter, F.lit("_text")).alias("place"), o.text.alias("text")), F.struct(F.concat(F.lit("opt_"), o.letter, F.lit("_explanation")).alias("place"), o.explanation.alias("text")))))
    told = lambda s: F.transform(F.filter(A.attributions(s.text, whitelist), lambda h: ~h.whitelisted), lambda h: F.concat_ws(":", s.place, h.kind, F.concat(F.lit("'"), h.matched, F.lit("'"))))
    found = F.flatten(F.transform(F.concat(fixed, own), told))
    return T.bound(found, lambda f: verdict(F.size(f) > 0, F.concat(F.lit("attribution: "), F.array_join(F.slice(f, 1, 3), "; ")), F.size(f)))


def uniqueness(questions: DataFrame, existing: DataFrame, key: str = "question_id") -> DataFrame:
    """ok: the id is not among those that exist; a question without an id passes."""
    known = existing.select(key).distinct().withColumn("__known", F.lit(True))
    return questions.join(known, key, "left").withColumn("ok", F.col("__known").isNull()).drop("__known")


def distractor_mix(levels: Column, wanted: dict[int, list[int]]) -> Column:
    """A warning where the distractors' levels are not the tier's; it never fails."""
    mix = by_tier({tier: ",".join(map(str, sorted(x))) for tier, x in wanted.items()}, None)
    own = F.array_join(F.transform(F.array_sort(levels), lambda x: x.cast("string")), ",")
    return F.when(mix.isNotNull() & (own != mix), F.concat(F.lit("distractor_mix: "), own, F.lit(" instead of "), mix))


#: Name, builder, whether a failure stops the chain.
PIPELINE = [
    ("structure", structure, True), ("attribution", attribution, False), ("option_length_balance", length_balance, False), ("blooms_cognitive_level", apply_level, False), ("remember_identity", remember_identity, False),
    ("understand_identity", understand_identity, False), ("apply_identity", apply_identity, False), ("evaluate_identity", evaluate_identity, False), ("option_claim", option_claim, False),
    ("topic_realm", topic_realm, False), ("stem_keyword_distribution", stem_keywords, False), ("laterality_integrity", laterality, False), ("universal_denial", universal_denial, False),
]


def run_gates(questions: DataFrame, gates: list = PIPELINE) -> DataFrame:
    """Adds `failures`: (gate, reason) in order, cut after the first failing prerequisite."""
    checked = questions.withColumns({f"__{name}": build() for name, build, _ in gates})
    found, stopped = [], F.lit(False)
    for name, _, first in gates:
        ok = F.col(f"__{name}.ok")
        found.append(F.when(~ok & ~stopped, F.struct(F.lit(name).alias("gate"), F.col(f"__{name}.reason").alias("reason"))))
        if first:
            stopped = stopped | ~ok
    return checked.withColumn("failures", F.filter(F.array(*found), lambda f: f.isNotNull())).drop(*(f"__{name}" for name, _, _ in gates))
