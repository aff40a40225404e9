"""Literal rows for the rules that the documents never trigger."""

import uuid

from pyspark.sql import functions as F

from quillmill.functions import attribution, refdata, udfs
from quillmill.functions import text as T
from quillmill.operators import audits, corpus, detectors, fixers, gates, planning, policy, publish, verdicts
from quillmill.operators.questions import OPTION
from quillmill.plans import more
from quillmill.sources import files

SCHEMA = f"question_id string, difficulty_tier int, question_stem string, options array<{OPTION}>"


def question(spark, stem="A plain stem.", texts=("alpha", "beta", "gamma", "delta"), tier=3, right=0, explanations=None):
    options = [("ABCD"[i], t, i == right, (explanations or [""] * 4)[i]) for i, t in enumerate(texts)]
    return spark.createDataFrame([("q", tier, stem, options)], SCHEMA)


def gate(df, build):
    return df.select(build().alias("g")).first()["g"]


def test_length_balance_boundaries(spark):
    assert gate(question(spark, texts=("x" * 100,) * 4), gates.length_balance)["ok"]
    assert gate(question(spark, texts=("x" * 100, "x" * 170, "x" * 100, "x" * 100)), gates.length_balance)["ok"]  # exactly 1.7
    assert not gate(question(spark, texts=("x" * 100, "x" * 171, "x" * 100, "x" * 100)), gates.length_balance)["ok"]
    assert not gate(question(spark, texts=("x" * 121, "x" * 100, "x" * 100, "x" * 100)), gates.length_balance)["ok"]


def test_identity_gates(spark):
    scenario = "A patient, age 52, presents with weakness."
    good = ("Predict impaired recall of recent events from damaged hippocampal tissue", "b", "c", "d")
    assert gate(question(spark, scenario, good, 3), gates.apply_identity)["ok"]
    assert gate(question(spark, scenario, ("Predict recall", "b", "c", "d"), 3), gates.apply_identity)["reason"] == "apply_identity: bare label"
    assert gate(question(spark, "A definition.", good, 3), gates.apply_identity)["reason"] == "apply_identity: no scenario"
    assert not gate(question(spark, scenario, tier=1), gates.remember_identity)["ok"]
    assert not gate(question(spark, "x " * 41, tier=2), gates.understand_identity)["ok"]
    assert not gate(question(spark, "One sentence", tier=4), gates.evaluate_identity)["ok"]
    assert gate(question(spark, "One. However, two.", tier=4), gates.evaluate_identity)["ok"]


def test_laterality_and_denial(spark):
    df = question(spark, "Bilateral damage is seen.", ("a", "unilateral cognitive impairment", "c", "d"))
    assert not gate(df, gates.laterality)["ok"]
    denied = question(spark, "The subject still recalls memories.", ("a", "damage erases all memories", "c", "d"))
    assert not gate(denied, gates.universal_denial)["ok"]


def test_prerequisite_stops_the_chain(spark):
    df = spark.createDataFrame([("q", 3, "stem", [("A", "because of x", True, "")])], SCHEMA)
    assert [f["gate"] for f in gates.run_gates(df).first()["failures"]] == ["structure"]


def signals(df, name):
    return [s.asDict() for s in detectors.scan(df).where(F.col("detector_id") == name).orderBy("letter").collect()]


def test_english_gap_signals(spark):
    df = question(spark, "A patient with a 2:1 ratio still recalls one event.", ("a", "erases ALL pre-injury memories", "a 3:1 ratio", "plain"), 1)
    found = signals(df, "english_gap_scanner")
    assert [(s["letter"], s["signature"], s["verdict_action"]) for s in found] == [("B", "universal_quantifier", "override_to"), ("C", "numeric_ratio", "override_to"), ("D", None, "advisory")]
    tier4 = signals(question(spark, "A patient still recalls.", ("a", "erases all", "c", "d"), 4), "english_gap_scanner")
    assert tier4[0]["fired"] and tier4[0]["verdict_action"] == "advisory"


def test_handedness_does_not_count_as_side(spark):
    found = signals(question(spark, "A right-handed man.", ("a", "left lesion", "c", "d"), 2), "english_gap_scanner")
    assert not found[0]["fired"]


def test_label_pairs(spark):
    row = spark.createDataFrame([("caffeine dose is the IV and reaction time is the DV", "Reaction time as IV"), ("the iv and the dv", "iv"), ("agonist or antagonist", "all agonist")], "s string, t string")
    found = row.select(detectors.label_pair(F.col("s"), F.col("t")).alias("p")).collect()
    assert found[0]["p"]["pair"] == "IV|DV" and found[0]["p"]["confidence"] == 0.5
    assert found[1]["p"] is None  # lower case
    assert found[2]["p"]["blocked"]
    boosted = row.select(detectors.label_pair(F.col("s"), F.col("t"), [("agonist", "antagonist")]).alias("p")).collect()
    assert boosted[2]["p"]["confidence"] == 1.0


def test_numeric_overlap(spark):
    found = signals(question(spark, "A child, age 7, is tested.", ("WISC-V", "WIAT-III", "WAIS-IV", "other"), 3), "numeric_overlap")
    assert found[0]["fired"] and found[0]["reason"] == "A,B"


def test_fixers(spark):
    df = spark.createDataFrame([("Left lesion", "Right then right side")], "s string, t string")
    assert df.select(fixers.swap_pair(F.col("s"), F.col("t"), refdata.LATERAL_PAIRS)).first()[0] == "Left then left side"
    long = "It erases all of the memories that were made before the injury in adult life"
    cut = spark.createDataFrame([(long,), ("all gone",)], "t string").select(fixers.drop_quantifier(F.col("t"))).collect()
    assert cut[0][0] == long.replace("all ", "") and cut[1][0] is None
    ages = spark.createDataFrame([("A 9-year-old boy, age 9.",), ("At age 12 and age 13.",)], "s string").select(fixers.set_stem_age(F.col("s"), F.lit(42))).collect()
    assert [a[0] for a in ages] == ["A 42-year-old boy, age 9.", "At age 42 and age 13."]


def test_votes(spark):
    rows = [("q1", "A", 0, "english_gap"), ("q1", "A", 1, "english_gap"), ("q1", "A", 2, "clean"), ("q2", "A", 0, "english_gap"), ("q2", "A", 1, "content_gap"), ("q2", "A", 2, "clean"), ("q3", "A", 0, "clean"), ("q3", "A", 1, "clean"), ("q3", "A", 2, "soft_flag")]
    df = spark.createDataFrame(rows, "question_id string, letter string, pass int, class string")
    found = {r["question_id"]: r["class"] for r in verdicts.quorum_vote(df, ["question_id", "letter"]).collect()}
    assert found == {"q1": "english_gap", "q2": "english_gap", "q3": "soft_flag"}


def test_reconciliation(spark):
    kind = "k string, class string, structural_override boolean"
    a = spark.createDataFrame([("1", "english_gap", False), ("2", "content_gap", False), ("3", None, False), ("4", "clean", True), ("5", "clean", False)], kind)
    b = spark.createDataFrame([("1", "clean", False), ("2", "clean", False), ("3", "clean", False), ("4", "english_gap", False), ("9", "clean", False)], kind)
    found = {r["k"]: (r["class"], r["disagreement"]) for r in verdicts.reconcile(a, b, ["k"]).collect()}
    assert found == {"1": ("english_gap", 1), "2": ("soft_flag", 1), "3": ("clean", 0), "4": ("clean", 0), "5": ("clean", 0)}


def test_override_order(spark):
    keys = ["question_id", "letter"]
    v = spark.createDataFrame([("q", "A", "english_gap")], "question_id string, letter string, class string")
    s = spark.createDataFrame([("q", "A", "schema_labeling", True, "override_to", "content_gap"), ("q", "A", "english_gap_scanner", True, "override_to", "english_gap")], "question_id string, letter string, detector_id string, fired boolean, verdict_action string, proposed_class string")
    first = verdicts.schema_override(v, s, keys)
    assert first.first()["class"] == "content_gap"
    assert verdicts.english_gap_override(first, s, keys).first()["class"] == "english_gap"


def test_first_seen_and_similarity(spark):
    rows = [("agonist", "Agonist", 0), ("agonist", "Other", 1), ("ag-2", "agonist!", 2), ("blank", "", 3)]
    found = {r["id"]: r["canonical_id"] for r in corpus.first_seen(spark.createDataFrame(rows, "id string, label_in string, at int"), "id", "label_in", "at").collect()}
    assert found == {"agonist": "agonist", "ag-2": "agonist", "blank": "blank"}
    concepts = spark.createDataFrame([(1, "agonist", "agonist", "binds receptor strongly"), (2, "receptor-agonist", "receptor agonist", "binds receptor strongly"), (3, "antagonist", "antagonist", "blocks")], "id int, slug string, label string, d string")
    pairs = corpus.similar_pairs(concepts, "id", T.slug_tokens(F.col("slug")), T.token_set(F.col("label"), 3), T.token_set(F.col("d"), 4), 0.5).collect()
    assert [(p["a"], p["b"]) for p in pairs] == [(1, 2)]


def test_small_functions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(T.slugify(F.lit("  Hello, World! "))) == "hello-world"
    space = uuid.UUID(hex=T.NAMESPACE)
    assert get(T.name_uuid(F.lit("dom:Täst"))) == str(uuid.uuid5(space, "dom:Täst"))
    assert get(T.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>"))) == 0.0
    assert get(T.ngrams(F.array(*map(F.lit, "abcd")))) == []
    assert get(T.question_id_parts(F.lit("QZ-PMET-AP-D1-RMS-01-1-H-01"))).asDict() == {"domain": "PMET", "anchor": "D1-RMS-01-1", "tier_letter": "H", "tier": 3}
    assert get(T.question_id_parts(F.lit("QZ-M"))).asDict() == {"domain": "?", "anchor": None, "tier_letter": "QZ", "tier": 0}
    assert get(planning.longest_prefix(one, "id", {}, F.lit("x"))) == "x"
    assert get(T.strip_fence(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}'
    assert udfs.last_json_object('x {"a": "}"} y {"b": 1} {') == '{"b": 1}'
    assert get(T.repair_mojibake(F.lit("itâ€™s"))) == "it’s"
    for good in "—–’‘“\xa0":
        assert get(T.repair_mojibake(F.lit(good.encode().decode("cp1252")))) == good


def test_attributions(spark):
    df = spark.createDataFrame([("Squire (2004) found it. Piaget (1936) too. Maria Smith found that it is.",)], "x string")
    hits = df.select(attribution.attributions(F.col("x"), ["Piaget"]).alias("h")).first()["h"]
    assert [(h["name"], h["kind"], h["whitelisted"]) for h in hits] == [("Squire", "year", False), ("Piaget", "year", True)]
    assert df.select(attribution.strip_citations(F.col("x"), ["Piaget"])).first()[0] == "found it. Piaget too. Maria Smith found that it is."


def test_attribution_kinds(spark):
    told = {
        "Smith hypothesized it.": [("Smith hypothesized", "Smith", "bare_single")],
        "Then Smith demonstrated that x": [],  # "Then" looks like a first name
        "then Smith demonstrated that x": [("Smith demonstrated that", "Smith", "bare_single")],
        "Smith found that x": [], "Smith showed that x": [], "Maria Smith argued that": [], "Dr. Smith argued that": [], "Results argued that": [],
        "Cannon and Bard proposed": [("Cannon and Bard proposed", "Cannon and Bard", "bare_multi")],
        "by Smith, Jones, and Brown found": [("Smith, Jones, and Brown found", "Smith, Jones, and Brown", "bare_multi")],
        "Anxiety and Depression found": [],
        "Köhler et al. said": [("Köhler et al.", "Köhler", "et_al")],
        "Per Latané it is": [("Per Latané", "Latané", "according_to")],
        "Smith's theory and James' work": [("Smith's theory", "Smith", "possessive"), ("James' work", "Jame", "possessive")],
        "Watson, J.B. & Rayner, R. (1920a)": [("Watson, J.B. & Rayner, R. (1920a)", "Watson, J.B. & Rayner, R.", "year")],
    }
    df = spark.createDataFrame([*enumerate(told)], "i int, x string")
    found = {r["x"]: [(h["matched"], h["name"], h["kind"]) for h in r["h"]] for r in df.select("x", attribution.attributions(F.col("x")).alias("h")).collect()}
    assert found == told
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(attribution.attributions(F.lit(None).cast("string"))) == [] and get(attribution.strip_citations(F.lit(None).cast("string"))) is None
    assert get(attribution.is_whitelisted(F.lit("Kübler-Ross"), ["Kübler-Ross"])) and get(attribution.is_whitelisted(F.lit("Cannon-Bard"), ["Cannon", "Bard"])) and not get(attribution.is_whitelisted(F.lit(""), ["x"]))
    strip = lambda s, known: get(attribution.strip_citations(F.lit(s), known))
    assert strip("Watson, J.B. & Rayner, R. (1920) saw  it", ["Watson"]) == "Watson saw it"
    assert strip("Cannon and Bard (1929): both", ["Cannon", "Bard"]) == "Cannon and Bard: both"
    assert strip("Smith and Jones (1985), so Smith (1985) said", []) == "so said"


def test_attribution_gate(spark):
    df = question(spark, "Squire (2004) found it.", ("Per Jones", "b", "c", "d"), explanations=["Smith (1985) demonstrated this.", "", "", "Piaget (1936)"])
    found = df.select(gates.attribution(["Piaget"]).alias("g")).first()["g"]
    assert found["reason"] == "attribution: stem:year:'Squire (2004)'; opt_A_text:according_to:'Per Jones'; opt_A_explanation:year:'Smith (1985)'" and found["metric"] == 3
    assert question(spark, "Piaget (1936) described stages.").select(gates.attribution(["Piaget"]).alias("g")).first()["g"]["ok"]
    known = question(spark).select(gates.attribution([], F.lit("Jones et al. did")).alias("g")).first()["g"]
    assert known["reason"].startswith("attribution: tested_concept:et_al")


def test_gates_by_whole_words_and_concepts(spark):
    assert gate(question(spark, texts=("misleading", "b", "c", "d")), gates.apply_level)["ok"] is False
    assert gate(question(spark, texts=("This leads on", "b", "c", "d")), gates.apply_level)["ok"]
    assert gate(question(spark, texts=("x rather than y", "b", "c", "d")), gates.apply_level)["ok"]
    ids = F.array(F.lit("working-memory"), F.lit("sleep-cycle"))
    fourth = lambda stem: question(spark, stem, tier=4).select(gates.apply_level(ids).alias("g")).first()["g"]
    assert fourth("Memory, then sleep")["ok"] and not fourth("Memory only")["ok"] and gate(question(spark, tier=4), gates.apply_level)["ok"]
    labels = F.create_map(F.lit("m"), F.lit("Memory of facts"), F.lit("s"), F.lit("Sleep"))
    scope = lambda *t: question(spark, texts=t).select(gates.scope_match(F.lit("best_answer"), labels).alias("g")).first()["g"]["ok"]
    assert scope("memory only", "b", "c", "d")  # one concept in the answer: nothing to match
    assert not scope("facts of sleep", "memory", "sleep facts", "sleep memory") and scope("facts of sleep", "sleep memory", "sleep facts", "sleep memory")
    assert gate(question(spark, texts=("x" * 200, "", "c", "d")), gates.length_balance)["ok"]  # an empty option
    assert not gate(question(spark, "dr. smith sees it", tier=1), gates.remember_identity)["ok"]
    text = "one two three four five six seven eight nine ten eleven twelve"
    own = question(spark, "stem", explanations=[text, "", "", ""]).select(gates.originality(F.lit(text)).alias("g")).first()["g"]
    assert not own["ok"] and own["metric"] == 1.0
    far = "completely " + "z" * 69 + " impaired"  # begin 81 characters apart
    assert gate(question(spark, "Memory is preserved as recall.", ("a", far + " recall", "c", "d")), gates.universal_denial)["ok"]
    assert not gate(question(spark, "Memory is preserved as recall.", ("a", far.replace("zz", "z", 1) + " recall", "c", "d")), gates.universal_denial)["ok"]
    rows = spark.createDataFrame([("q1",), ("q2",), (None,)], "question_id string")
    assert {r["question_id"]: r["ok"] for r in gates.uniqueness(rows, rows.where("question_id = 'q1'")).collect()} == {"q1": False, "q2": True, None: True}


def test_ages_and_instruments(spark):
    one = spark.range(1)
    get = lambda s: [round(x, 3) for x in one.select(T.ages(F.lit(s))).first()[0]]
    assert get("16:11, aged 7, a 9-year-old, 12 year old, 16 years, 11 months; 16:13") == [16.917, 7.0, 9.0, 12.0, 16.917]
    fired = lambda stem, texts: signals(question(spark, stem, texts), "numeric_overlap")[0]["fired"]
    assert fired("A boy aged 16", ("WISC-V", "WAIS-IV", "c", "d")) and not fired("A boy aged 16", ("xwisc", "WAIS-IV", "c", "d"))


def test_siblings_fill_from_lower_priorities(spark):
    rows = [("a", "g", "c1", ["x", "y"]), ("b", "g", "c1", ["x"]), ("c", "g", "c2", ["x", "y"]), ("d", "g", "c3", ["p", "q"]), ("e", "g", "c4", ["x", "y"]), ("f", "h", "c1", [])]
    df = spark.createDataFrame(rows, "id string, g string, near string, terms array<string>")
    found = planning.siblings(df, "id", "g", "near", 3, F.ascii("id"), F.col("terms")).orderBy("rank").collect()
    assert [(r["sibling"], r["tier"]) for r in found if r["primary"] == "a"] == [("b", 1), ("d", 2), ("e", 3)]  # 97 turns c, e by one
    assert not [r for r in found if r["primary"] == "f"]
    brute = {}
    for i, g, near, terms in rows:
        pools = [[], [], []]
        for j, h, n2, t2 in rows:
            if j != i and h == g:
                union = {*terms} | {*t2}
                pools[0 if n2 == near else 1 if (1 - len({*terms} & {*t2}) / len(union) if union else 1) >= 0.5 else 2].append(j)
        picked = []
        for pool in pools:
            picked += [pool[(ord(i) + k) % len(pool)] for k in range(min(3 - len(picked), len(pool)))]
        brute[i] = picked
    assert {i: [r["sibling"] for r in found if r["primary"] == i] for i, *_ in rows} == brute


def test_similar_pairs_against_brute_force(spark):
    import random

    rng = random.Random(1)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta", "epsi", "zeta"])
    rows = [(i, "-".join(word() for _ in range(rng.randint(1, 4))), " ".join(word() for _ in range(rng.randint(0, 4))), " ".join(word() for _ in range(3))) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, slug string, label string, d string")
    j = lambda a, b: len(a & b) / len(a | b) if a | b else 0.0
    for threshold in (0.5, 0.7):
        found = corpus.similar_pairs(df, "id", T.slug_tokens(F.col("slug")), T.token_set(F.col("label"), 3), T.token_set(F.col("d"), 4), threshold).collect()
        sets = [({*s.split("-")}, {*t.split()}, {*u.split()}) for _, s, t, u in rows]
        want = {(a, b) for b in range(90) for a in range(b) if 0.5 * j(sets[a][0], sets[b][0]) + 0.3 * j(sets[a][1], sets[b][1]) + 0.2 * j(sets[a][2], sets[b][2]) >= threshold - 1e-12}
        assert {(r["a"], r["b"]) for r in found} == want and want


def test_similar_classes_of_repeated_rows_nulls_and_blocks(spark):
    rows = [(i, "red-hot-iron" if i % 3 else "red-hot-gear", "red hot", "large") for i in range(60)] + [(100, None, None, None), (101, None, None, None), (102, "", "", ""), (103, "red-hot-iron", "red hot", "small")]
    df = spark.createDataFrame(rows, "id int, slug string, label string, d string")
    sets = (T.slug_tokens(F.col("slug")), T.token_set(F.col("label"), 3), T.token_set(F.col("d"), 4))
    classes, members = corpus.similarity_classes(df, "id", *sets)
    want = {i: 0 if i % 3 == 0 else 1 for i in range(60)} | {100: 100, 101: 100, 102: 100, 103: 103}
    assert {r["id"]: r["class"] for r in members.collect()} == want
    for block in (1, 2, 4096):
        found = {(r["class_a"], r["class_b"]): r["score"] for r in corpus.similar_classes(classes, 0.5, block).collect()}
        assert found == {(0, 0): 1.0, (1, 1): 1.0, (0, 1): 0.75, (0, 103): 0.55, (1, 103): 0.8}
    pairs = {(r["a"], r["b"]) for r in corpus.similar_pairs(df, "id", *sets, 0.76).collect()}
    assert pairs == {(a, b) for a, x in want.items() for b, y in want.items() if a < b and (x == y != 100 or {x, y} == {1, 103})}
    for block in (1, 7):  # members told in blocks
        told = corpus.similar_pairs(df, "id", *sets, 0.76, block).collect()
        assert len(told) == len(pairs) and {(r["a"], r["b"]) for r in told} == pairs
    assert corpus.similar_classes(classes.where("false")).count() == 0


def test_pairs_of_one_large_class_are_told_by_several_tasks(spark):
    df = spark.range(1000).select("id", F.lit("red-hot-iron").alias("slug"), F.lit("red hot").alias("label"), F.lit("large").alias("d"))
    pairs = corpus.similar_pairs(df, "id", T.slug_tokens(F.col("slug")), T.token_set(F.col("label"), 3), T.token_set(F.col("d"), 4), block=50)
    each = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(each) == 1000 * 999 // 2 and max(each) < 0.6 * sum(each)


def test_empty_source_is_refused(spark):
    import pytest

    with pytest.raises(Exception, match="no rows"):
        files.sync_delta(spark.range(0), spark.range(3)).select("delta").collect()


def test_positions_are_balanced():
    assert len(refdata.POSITIONS) == 20 and all(refdata.POSITIONS.count(x) == 5 for x in "ABCD")


def test_policy(spark):
    rows = spark.createDataFrame([("BPSY", 4, "integrated", "subtle_error"), ("NONE", 3, "x", "y"), (None, None, None, None)], "domain string, tier int, source_type string, stem_pattern string")
    found = [(r["gate_action"], r["override_threshold"], r["co_firing_required"]) for r in policy.resolve(spark, rows).collect()]
    assert sorted(found, key=str) == sorted([("audit", 0.95, True), ("strict", 0.85, False), ("strict", None, False)], key=str)


def test_strip_reasoning(spark):
    texts = ("A claim that is long enough because it has a reason", "Another claim of like size here", "A third claim of like size", "Short")
    done = publish.strip_reasoning(question(spark, texts=texts, explanations=["Known.", "", "", ""])).first()["options"]
    assert done[0]["text"] == "A claim that is long enough" and done[0]["explanation"] == "Known. because it has a reason"
    assert done[1]["text"] == texts[1]


def test_scans(spark, tmp_path):
    (tmp_path / "a.csv").write_text('uid,passage,domain_code\n1,"one, two",X\n1,"last ""one""",Y\n')
    assert [tuple(r) for r in files.scan_csv(spark, str(tmp_path / "a.csv"), files.PASSAGE, "uid").collect()] == [("1", 'last "one"', "Y")]
    assert files.scan_csv(spark, str(tmp_path / "none.csv"), files.PASSAGE).count() == 0
    folder = tmp_path / "q" / "DOM"
    folder.mkdir(parents=True)
    (folder / "c1.json").write_text('[{"question_id": "q1"}]')
    (folder / "c2.json").write_text('{"questions": [{"question_id": "q2"}]}')
    (folder / "c3.json").write_text("broken")
    (folder / "c1.audit.json").write_text('[{"question_id": "no"}]')
    from pyspark.sql import types as t

    schema = t.StructType([t.StructField("question_id", t.StringType())])
    assert sorted(r["question_id"] for r in files.scan_json_documents(spark, str(tmp_path / "q"), schema).collect()) == ["q1", "q2"]
    (tmp_path / "p.csv").write_text("skip\nskip\na, b ,c\nshort\nd,e,f\n")
    assert [tuple(r)[1:] for r in files.scan_positional(spark, str(tmp_path / "p.csv"), 2, 3, {"x": 0, "y": 1}).orderBy("at").collect()] == [("a", "b"), ("d", "e")]


def test_gates_on_wider_records(spark):
    card = ("x" * 20, "y" * 40)
    df = spark.createDataFrame([([card] * 3, ["ab", "cd", "ef"]), ([card] * 2, ["ab", "cd", "ef"]), ([card] * 3, ["a", "b", "cd"])], "flashcard_seeds array<struct<front:string,back:string>>, topic_keywords array<string>")
    assert [r[0]["ok"] for r in df.select(gates.content_quality()).collect()] == [True, False, False]
    q = question(spark, texts=("memory and sleep", "memory and sleep", "memory", "sleep, memory"))
    labels = F.create_map(F.lit("m"), F.lit("Memory of facts"), F.lit("s"), F.lit("Sleep"))
    assert not q.select(gates.scope_match(F.lit("comparison"), labels).alias("g")).first()["g"]["ok"]
    assert q.select(gates.scope_match(F.lit("paraphrase"), labels).alias("g")).first()["g"]["ok"]
    assert not q.select(gates.anchor_grounding(F.lit("c9"), F.array(F.lit("c1"))).alias("g")).first()["g"]["ok"]
    assert q.select(gates.distractor_mix(F.array(F.lit(2), F.lit(1)), {3: [1, 2]}).alias("g")).first()["g"] is None


def test_tallies_and_guard(spark):
    rows = spark.createDataFrame([("c", "clean", None), ("c", "odd", None), ("c", "major", "x"), ("c", "major", None)], "chapter string, class string, error string")
    assert verdicts.class_tally(rows, ["chapter"], ["clean", "major"]).first().asDict() == {"chapter": "c", "clean": 1, "major": 1, "error": 2}
    manifest = spark.createDataFrame([("a", "ready"), ("b", "review")], "chapter string, status string")
    assert (verdicts.bundle_guard(manifest), verdicts.bundle_guard(manifest, True), verdicts.bundle_guard(manifest.limit(0))) == (2, 0, 1)
    templates = spark.createDataFrame([("D", None, 2, "general"), ("D", "f", 1, "special")], "domain string, flavor string, ord int, template string")
    asked = spark.createDataFrame([(1, "D", "f"), (2, "D", "g"), (3, "X", "f")], "id int, domain string, flavor string")
    assert sorted((r["id"], r["template"]) for r in planning.template_for(asked, templates, ["domain", "flavor"]).collect()) == [(1, "special"), (2, "general"), (3, None)]


def test_match_distances_beyond_fifty_matches(spark, tmp_path):
    texts = ["the " * 60 + "of", "of " + "x " * 50 + "the " * 70 + "y of", "the the", "", None]
    spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = more.match_distances(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["n_a"], r["distance"]) for r in found} == {0: (60, 4), 1: (70, 6), 2: (2, None), 3: (0, None), 4: (0, None)}


def test_vocabulary_signals_and_rewrites(spark):
    words = lambda *xs: F.array(*map(F.lit, xs)).cast("array<string>")
    get = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    groups = [words("ab", "abcd", "abc", "wxyz"), words("abc", "q"), words()]
    assert get(planning.vocabulary(groups, 3, 12)) == ["abcd", "wxyz", "abc", "q"] and get(planning.vocabulary(groups, 3, 2)) == ["abcd", "wxyz"]
    assert [get(audits.rewrite_stem(F.lit(a), F.lit(b))) for a, b in ((1, 3), (2, 3), (1, 2), (0, 0), (None, 3))] == [False, True, True, False, False]
    rows = spark.createDataFrame(
        [("a", "d1", True, "block", None, 1.0, "r1"), ("b", "d1", False, "block", None, 0.0, "r2"), ("c", "d2", True, "override_to", "english_gap", 0.5, "r3"), ("d", "d2", True, "advisory", None, 0.5, "r4"), ("e", "d2", True, "override_to", None, 0.5, "r5"), ("f", "d3", True, "block", None, 1.5, "r6"), ("g", "d3", True, "shout", None, 0.5, "r7")],
        "question_id string, detector_id string, fired boolean, verdict_action string, proposed_class string, confidence double, reason string",
    )
    valid = rows.select("question_id", detectors.valid_signal(F.struct("*")).alias("ok"))
    assert {r["question_id"] for r in valid.collect() if r["ok"]} == {"a", "b", "c", "d"}
    failed = {tuple(r) for r in detectors.blocking(rows.where("question_id < 'e'")).collect()}
    assert failed == {("a", "detector:d1", "r1"), ("c", "detector:d2", "r3")}
