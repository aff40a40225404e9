"""Questions changed by a model's earlier answers: rewrites by letter, critiques, rescues by gate; rubric audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.text import strip_fence

# What a gate's rescue asks for (the list in the answer, the options it may change), the
# classes of an editorial audit, dollars for a million tokens in and out.
GATE_STRATEGIES = {
    "apply_identity": (None, "correct"), "topic_realm": ("distractors", "wrong"), "scope_match": ("distractors", "wrong"), "stem_keyword_distribution": ("distractors", "wrong"), "option_claim": ("options", "all"),
}
EDITORIAL_CLASSES = ("clean", "minor", "major")
CRITIQUE_PRICES = (15.0, 75.0)


def _member(v: Column, path: str) -> Column:
    """The text at a path, null unless it is one."""
    at = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(at) == "STRING", F.try_variant_get(at, "$", "string"))


def _answer(answers: DataFrame) -> DataFrame:
    """question_id, error, v: an answer's JSON object, null where it is none or empty."""
    v = F.try_parse_json(strip_fence(F.col("content")))
    full = F.startswith(F.schema_of_variant("v"), F.lit("OBJECT<")) & (F.schema_of_variant("v") != "OBJECT<>")
    return answers.withColumn("v", v).select("question_id", "error", F.when(full, F.col("v")).alias("v"), F.lit(True).alias("asked"))


def rewrites_of(v: Column, path: str) -> Column:
    """array of (letter, text, explanation) in a list of an answer; entries that are no objects and fields that are no texts don't count."""
    entries = F.filter(F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.expr("cast(array() as array<variant>)")), lambda x: F.coalesce(F.startswith(F.schema_of_variant(x), F.lit("OBJECT")), F.lit(False)))
    return F.transform(entries, lambda x: F.struct(*(_member(x, f"$.{f}").alias(f) for f in ("letter", "text", "explanation"))))


def rewritten(options: Column, rewrites: Column, may: str = "all", blank_text_counts: bool = False) -> Column:
    """options with text and explanation by letter, the last rewrite of a letter.

    may: which options can change, all, correct or wrong.  A rewrite without a text leaves its option as it is, or, with
    blank_text_counts, changes each field that it has, an empty text too.  An explanation that the rewrite
    lacks stays, as does everything else, who is correct above all.
    """

    def one(o: Column) -> Column:
        own = F.try_element_at(F.filter(rewrites, lambda r: r.letter == o.letter), F.lit(-1))
        right = F.coalesce(o.is_correct, F.lit(False))
        allowed = {"all": F.lit(True), "correct": right, "wrong": ~right}[may]
        takes = allowed & (own.isNotNull() if blank_text_counts else F.coalesce(own.text != "", F.lit(False)))
        return F.when(F.coalesce(takes, F.lit(False)), o.withField("text", F.coalesce(own.text, o.text)).withField("explanation", F.coalesce(own.explanation, o.explanation))).otherwise(o)

    return F.transform(options, one)


def self_critique(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """questions with question_stem and options as a critique left them, outcome, error, rationale.

    questions: question_id, question_stem, options, flagged (array of letters; a question without any is skipped).
    answers: question_id, content, error, one row a question: {"revised", "rationale", "question": {"question_stem", "options"}}.  outcome: skipped, failed,
    kept (no revision needed) or revised.  A blank stem stays; an option's text and explanation are taken
    where they are texts.  Who is correct never changes, whatever the answer says.  A flagged question that
    nobody answered failed with "no_answer".
    """
    joined = questions.join(_answer(answers), "question_id", "left")
    asked = F.coalesce(F.size("flagged"), F.lit(0)) > 0
    error = (
        F.when(F.coalesce(F.size("options"), F.lit(0)) == 0, "no_options").when(F.col("asked").isNull(), "no_answer").when(F.col("error").isNotNull(), F.concat(F.lit("api_error: "), "error")).when(F.col("v").isNull(), "parse_failed")
    )
    wants = F.coalesce(F.try_variant_get("v", "$.revised", "boolean"), F.lit(False))
    outcome = F.when(~asked, "skipped").when(error.isNotNull(), "failed").when(wants, "revised").otherwise("kept")
    told = joined.withColumns({"outcome": outcome, "__error": F.when(asked, error), "__stem": _member(F.col("v"), "$.question.question_stem"), "__new": rewrites_of(F.col("v"), "$.question.options")})
    revised = F.col("outcome") == "revised"
    stem = F.when(revised & (F.trim("__stem") != ""), F.col("__stem")).otherwise(F.col("question_stem"))
    options = F.when(revised, rewritten(F.col("options"), F.col("__new"), blank_text_counts=True)).otherwise(F.col("options"))
    rationale = F.when(F.col("outcome").isin("kept", "revised"), F.coalesce(_member(F.col("v"), "$.rationale"), F.lit("")))
    rest = [c for c in questions.columns if c not in ("question_stem", "options")]
    return told.select(*rest, stem.alias("question_stem"), options.alias("options"), "outcome", F.col("__error").alias("error"), rationale.alias("rationale"))


def critique_summary(critiqued: DataFrame, usage: DataFrame, chapter: str = "chapter", prices: tuple[float, float] = CRITIQUE_PRICES) -> DataFrame:
    """attempted, revised, failed and dollars of each chapter.  usage: question_id, tokens_in, tokens_out, one row a question; skipped questions cost nothing."""
    spent = critiqued.join(usage.select("question_id", "tokens_in", "tokens_out"), "question_id", "left")
    asked = F.col("outcome") != "skipped"
    dollars = F.when(asked, F.coalesce(F.col("tokens_in") * prices[0] + F.col("tokens_out") * prices[1], F.lit(0.0)) / 1e6).otherwise(0.0)
    return spent.groupBy(chapter).agg(F.count_if(asked).alias("attempted"), F.count_if(F.col("outcome") == "revised").alias("revised"), F.count_if(F.col("outcome") == "failed").alias("failed"), F.round(F.sum(dollars), 4).alias("cost"))


def rescue_by_gate(failures: DataFrame, answers: DataFrame) -> DataFrame:
    """failures with strategy, rescued, error and the options as rescued.

    failures: question_id, gate, options.  answers: question_id, content, error, one row a question.  The correct option's rescue takes
    text and explanation from the answer itself, the others a list of rewrites by letter; a letter without a text
    keeps its option, and only the options of the strategy change.  error: no_strategy (a gate without one),
    no_correct_option, no_answer, the answer's own error, no_parsed, missing_text_in_response, missing_distractors_in_response, missing_options_in_response.
    """
    joined = failures.join(_answer(answers).withColumnRenamed("error", "__said"), "question_id", "left")
    listed = {name: rewrites_of(F.col("v"), f"$.{name}") for name in ("distractors", "options")}
    right = F.get(F.filter("options", lambda o: F.coalesce(o.is_correct, F.lit(False))), F.lit(0)).letter
    own = F.array(F.struct(right.alias("letter"), _member(F.col("v"), "$.text").alias("text"), _member(F.col("v"), "$.explanation").alias("explanation")))
    asks = lambda name: F.col("gate").isin(*(g for g, (n, _) in GATE_STRATEGIES.items() if n == name))
    whole = F.coalesce(F.col("gate").isin(*(g for g, (n, _) in GATE_STRATEGIES.items() if n is None)), F.lit(False))
    told = joined.withColumn("__new", F.when(whole, own).when(asks("distractors"), listed["distractors"]).when(asks("options"), listed["options"]))
    error = (
        F.when(~F.coalesce(F.col("gate").isin(*GATE_STRATEGIES), F.lit(False)), "no_strategy").when(right.isNull(), "no_correct_option").when(F.col("asked").isNull(), "no_answer").when(F.col("__said").isNotNull(), F.col("__said"))
        .when(F.col("v").isNull(), "no_parsed").when(whole & (F.coalesce(F.get("__new", F.lit(0)).text, F.lit("")) == ""), "missing_text_in_response")
        .when(asks("distractors") & (F.size("__new") == 0), "missing_distractors_in_response").when(asks("options") & (F.size("__new") == 0), "missing_options_in_response")
    )
    told = told.withColumn("error", error)
    may = {kind: F.col("gate").isin(*(g for g, (_, k) in GATE_STRATEGIES.items() if k == kind)) for kind in ("correct", "wrong", "all")}
    changed = F.when(F.col("error").isNotNull(), F.col("options"))
    for kind, rule in may.items():
        changed = changed.when(rule, rewritten(F.col("options"), F.col("__new"), kind))
    rest = [c for c in failures.columns if c != "options"]
    return told.select(*rest, F.when(~F.col("error").eqNullSafe("no_strategy"), F.col("gate")).alias("strategy"), F.col("error").isNull().alias("rescued"), "error", changed.alias("options"))


def rubric_verdicts(questions: DataFrame, answers: DataFrame, field: str, classes: tuple[str, ...], unknown_as: str | None = None) -> DataFrame:
    """question_id, class, n_issues, summary, error: one rubric's verdict for each question.

    field: the class's name in the answer.  A class that is not in `classes` becomes `unknown_as` with a summary
    that says so, or, without one, the error "unknown_class".  Answers that are missing, failed or can't be read have no class.
    """
    joined = questions.select("question_id").join(_answer(answers).withColumnRenamed("error", "__said"), "question_id", "left")
    said = _member(F.col("v"), f"$.{field}")
    good = F.coalesce(said.isin(*classes), F.lit(False))
    name = F.coalesce(said, F.lit("None"))
    broken = F.when(F.col("asked").isNull(), "no_answer").when(F.col("__said").isNotNull(), F.concat(F.lit("api_error: "), "__said")).when(F.col("v").isNull(), "parse_failed")
    error = broken if unknown_as is not None else F.coalesce(broken, F.when(~good, F.concat(F.lit("unknown_class: "), name)))
    issues = F.coalesce(F.size(F.try_variant_get("v", "$.issues", "array<variant>")), F.lit(0))
    summary = F.when(good, F.coalesce(_member(F.col("v"), "$.summary"), F.lit(""))).otherwise(F.concat(F.lit("unrecognized class '"), name, F.lit(f"'; coerced to {unknown_as}")))
    told = joined.withColumn("error", error)
    fine = F.col("error").isNull()
    return told.select("question_id", F.when(fine, F.when(good, said).otherwise(F.lit(unknown_as))).alias("class"), F.when(fine, issues).otherwise(0).alias("n_issues"), F.when(fine, summary).otherwise("").alias("summary"), "error")


def rubric_counts(verdicts: DataFrame, keys: list[str], classes: tuple[str, ...]) -> DataFrame:
    """Questions of each class, and errors, for each key: one aggregation."""
    return verdicts.groupBy(*keys).agg(F.count("*").alias("n"), *(F.count_if(F.col("class") == c).alias(c) for c in classes), F.count_if(F.col("error").isNotNull()).alias("errors"))
