"""The whole gate chain on literal records."""

import pytest
from pyspark.sql import functions as F

from quillmill.operators import chain

CARD = {"front": "f" * 20, "back": "b" * 40}
SCHEMA = f"""question_id string, difficulty_tier int, stem_pattern string, question_stem string, tested_concept struct<concept_id:string,knowledge_tested:string>, options array<{chain.OPTION}>,
flashcard_seeds map<string,struct<front:string,back:string>>, topic_keywords array<string>, brief_ids array<string>, brief_labels map<string,string>, testable_fact string, domain_vocab array<string>, brief_terms array<string>,
source string, gate_action string, eliminable array<string>, known boolean"""


def option(letter, right=False, **changes):
    wrong = {"concept_id": f"c{letter}", "misconception_id": f"m{letter}", "misconception_label": "label", "misconception_type": "similar_name", "confused_with": "x", "distractor_level": "ABCD".index(letter)}
    own = {"concept_id": "c1", "misconception_id": None, "misconception_label": None, "misconception_type": None, "confused_with": None, "distractor_level": None}
    return {"letter": letter, "text": f"some option text {letter}", "is_correct": right, "explanation": "why"} | (own if right else wrong) | changes


def record(qid="q", options=None, **changes):
    base = {
        "question_id": qid, "difficulty_tier": 1, "stem_pattern": "none", "question_stem": "What is it?", "tested_concept": {"concept_id": "c1", "knowledge_tested": "k"},
        "options": options or [option("A", True), option("B"), option("C"), option("D")], "flashcard_seeds": dict.fromkeys(("concept", "comparison", "nuance"), CARD), "topic_keywords": ["one", "two", "three"],
        "brief_ids": ["c1"], "brief_labels": {}, "testable_fact": None, "domain_vocab": [], "brief_terms": [], "source": None, "gate_action": "strict", "eliminable": None, "known": False,
    }
    return base | changes


def four(letter=None, right="A", **changes):
    return [option(x, x == right, **(changes if x == letter else {})) for x in "ABCD"]


CASES = {
    "good": (record(), [], []),
    "no stem": (record(question_stem=" "), ["structure: no stem"], []),
    "three options": (record(options=four()[:3], known=True), ["structure: not four options"], []),
    "no concept": (record(tested_concept=None), ["structure: no tested concept"], []),
    "no concept id": (record(tested_concept={"concept_id": "", "knowledge_tested": None}), ["structure: tested concept without id"], []),
    "no cards": (record(flashcard_seeds=None), ["content_quality: no cards"], []),
    "one card missing": (record(flashcard_seeds={"concept": CARD, "nuance": CARD}), ["content_quality: no comparison card"], []),
    "short front": (record(flashcard_seeds={"concept": CARD, "nuance": CARD | {"front": "f" * 19}, "comparison": CARD}), ["content_quality: short front of nuance card"], []),
    "short back": (record(flashcard_seeds={"concept": CARD | {"back": "b" * 39}, "nuance": CARD, "comparison": CARD}), ["content_quality: short back of concept card"], []),
    "two keywords": (record(topic_keywords=["one", "two"]), ["content_quality: few keywords"], []),
    "short keyword": (record(topic_keywords=["one", "two", "x", None]), ["content_quality: empty keyword"], []),
    "another concept": (record(tested_concept={"concept_id": "c2", "knowledge_tested": None}), ["consistency: another concept"], []),
    "stray field": (record(options=four("A", confused_with="x")), ["consistency: correct option with confused_with"], []),
    "no misconception": (record(options=four("C", misconception_id=None)), ["consistency: C without misconception_id"], []),
    "no label": (record(options=four("B", misconception_label="")), ["consistency: B without misconception_label"], []),
    "odd kind": (record(options=four("D", misconception_type="odd")), ["consistency: D of unknown misconception_type"], []),
    "odd level": (record(options=four("D", distractor_level=5)), ["consistency: D of unknown distractor_level"], []),
    "twice": (record(options=four("D", misconception_id="mB")), ["consistency: repeated misconception"], []),
    "not in brief": (record(brief_ids=["c9"], known=True), ["anchor_grounding: concept not in brief", "uniqueness: id exists"], []),
    "no brief": (record(brief_ids=None), [], []),
    "cited": (record(question_stem="Squire (2004) found it."), ["attribution: stem:"], []),
    "long": (record(options=four("A", text="x" * 60)), ["option_length_balance"], []),
    "eliminable": (record(eliminable=["B", "D"]), ["stem_eliminable_distractor: B,D"], []),
    "skipped": (record(eliminable=["B"], gate_action="skip"), [], []),
    "few terms": (record(difficulty_tier=2, brief_labels={"c1": "receptor density"}), [], ["domain_expertise"]),
    "few terms, tier 3": (record(difficulty_tier=3, brief_labels={"c1": "receptor density"}), ["blooms_cognitive_level", "apply_identity", "domain_expertise: few terms"], ["distractor_mix"]),
    "general terms": (record(difficulty_tier=3, brief_labels={"c1": "general theory"}), ["blooms_cognitive_level", "apply_identity"], ["distractor_mix"]),
    "levels": (record(options=four("D", distractor_level=4)), [], ["distractor_mix"]),
    "copied": (record(source="alpha beta gamma delta epsilon zeta", question_stem="alpha beta gamma delta epsilon zeta"), ["originality: copied"], []),
    "half copied": (record(testable_fact="alpha beta gamma delta epsilon zeta eta", question_stem="alpha beta gamma delta epsilon"), [], ["originality"]),
}


@pytest.fixture(scope="module")
def told(spark):
    rows = spark.createDataFrame([r | {"question_id": name} for name, (r, _, _) in CASES.items()], SCHEMA)
    return {r["question_id"]: r for r in chain.check_records(rows).collect()}


@pytest.mark.parametrize("name", CASES)
def test_chain(told, name):
    _, failures, warnings = CASES[name]
    got = told[name]
    assert [f["reason"][: len(w)] for f, w in zip(got["failures"], failures, strict=True)] == failures
    assert got["warnings"] == warnings


def test_gates_in_order():
    names = [name for name, _, _ in chain.chain()]
    assert len(names) == 22 and names[:3] == ["structure", "content_quality", "consistency"] and [n for n, _, first in chain.chain() if first] == [*names[:3], "uniqueness"] == [*names[:3], names[-1]]


def test_listing_questions_are_exempt_and_terms_widen_the_realm(spark):
    words = "alpha bravo charlie delta echo foxtrot golf hotel"
    spread = [option("A", True, text=words), *(option(x, text=f"{x.lower()}one two{x.lower()} three{x.lower()} four{x.lower()} five{x.lower()} six{x.lower()}xx") for x in "BCD")]
    rows = [record("plain", spread, question_stem="nothing shared here today"), record("terms", spread, question_stem="nothing shared here today", brief_terms=words.upper().split()[:7]), record("listing", spread, stem_pattern="feature_listing", question_stem=words), record("stem", spread, question_stem=words)]
    got = {r["question_id"]: [f["gate"] for f in r["failures"]] for r in chain.check_records(spark.createDataFrame(rows, SCHEMA), only=lambda n: n in ("topic_realm", "stem_keyword_distribution")).collect()}
    assert got == {"plain": [], "terms": ["topic_realm"], "listing": [], "stem": ["topic_realm", "stem_keyword_distribution"]}
    tier = [record(n, spread, difficulty_tier=3, question_stem="charlie foxtrot ipsum", domain_vocab=v) for n, v in (("any", []), ("known", ["Charlie", "foxtrot"]), ("other", ["hotel"]))]
    got = {r["question_id"]: [f["gate"] for f in r["failures"]] for r in chain.check_records(spark.createDataFrame(tier, SCHEMA), only=lambda n: n == "stem_keyword_distribution").collect()}
    assert got == {"any": ["stem_keyword_distribution"], "known": ["stem_keyword_distribution"], "other": []}


def test_nulls_crash_no_gate(spark):
    empty = {k: None for k in record()} | {"question_id": "null"}
    row = spark.createDataFrame([empty], SCHEMA)
    assert [f["gate"] for f in chain.check_records(row).select(F.col("failures")).first()[0]] == ["structure"]


def test_words_with_letters_beyond_the_word_list_count_where_folded(spark):
    """Four words follow the verb, one of them with an ß, as the SQL of gate_chain counts them."""
    rows = [record(name, four("A", text=text), difficulty_tier=3, question_stem="A patient presents.") for name, text in (("sharp s", "Predict antagonist from chßber cheinver enheitie"), ("three words", "Predict antagonist from cheinver enheitie"), ("participle", "Predict antagonist cheinver enheitie lichkeit by chüing"))]
    got = lambda fold: {r["question_id"]: [f["reason"] for f in r["failures"]] for r in chain.check_records(spark.createDataFrame(rows, SCHEMA), only=lambda n: n == "apply_identity", fold=fold).collect()}
    assert got(True) == {"sharp s": [], "three words": ["apply_identity: bare label"], "participle": []}
    assert got(False)["sharp s"] == ["apply_identity: bare label"]
