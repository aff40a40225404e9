"""From a plan and written parts to a question, and back from logs and artefacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillmill.functions import text as T

# Letters, labels and cognitive levels of the tiers; the namespace of chapters and anchors.
TIER_LETTERS = {1: "E", 2: "M", 3: "H", 4: "X"}
TIER_LABELS = {1: "easy", 2: "medium", 3: "hard", 4: "expert"}
LEVELS = {1: ("remember", "understand"), 2: ("understand", "apply"), 3: ("apply", "analyze"), 4: ("evaluate", "analyze")}
QUESTION_SPACE = "e7a1c3d4b5f64890abcdef1234567890"
LETTERS = "ABCD"


def _of_tier(values: dict[int, str]) -> Column:
    return F.coalesce(*(F.when(F.col("tier") == t, F.lit(v)) for t, v in values.items()))


def metadata(tasks: DataFrame) -> DataFrame:
    """The fields of a question that follow from its task (P10).  tasks: domain_code,
    chapter_title, section_title, anchor_uid, anchor_id_v2, verbatim_anchor, tier, variant."""
    uuid = lambda name: T.name_uuid(F.concat("domain_code", F.lit(":"), name), QUESTION_SPACE)
    qid = F.concat(F.lit("QZ-"), "domain_code", F.lit("-"), "anchor_id_v2", F.lit("-"), _of_tier(TIER_LETTERS), F.lit("-"), F.format_string("%02d", F.col("variant").cast("int")))
    return tasks.withColumns(
        {
            "question_id": qid, "chapter_file": F.concat(T.slugify(F.col("chapter_title")), F.lit(".html")),
            "section_title": F.coalesce(F.nullif(F.col("section_title"), F.lit("")), F.col("chapter_title")),
            "chapter_uuid": uuid(F.col("chapter_title")), "anchor_uuid": uuid(F.col("anchor_uid")), "anchor_label": F.substring("verbatim_anchor", 1, 120),
            "difficulty_label": _of_tier(TIER_LABELS), "blooms_primary": _of_tier({t: a for t, (a, _) in LEVELS.items()}), "blooms_secondary": _of_tier({t: b for t, (_, b) in LEVELS.items()}),
        }
    )


def titled(slug: Column) -> Column:
    """A hyphenated id in words, a capital after all that is no letter (F32)."""
    return F.array_join(F.transform(F.split(F.replace(slug, F.lit("-"), F.lit(" ")), "(?<=[^A-Za-z])(?=[A-Za-z])"), F.initcap), "")


def flashcard_fronts(label: Column, involved: Column) -> Column:
    """The fronts of a concept, a comparison and a nuance card (F32).  involved: the concepts
    of the first misconception; the comparison names two of them, if there are two."""
    name = F.coalesce(label, F.lit("this concept"))
    two = F.concat(titled(F.get(involved, F.lit(0))), F.lit(" vs. "), titled(F.get(involved, F.lit(1))), F.lit(" — what are the key differences between these concepts?"))
    return F.struct(
        F.concat(F.lit("What is "), name, F.lit("? What are its key characteristics and functions?")).alias("concept_front"),
        F.when(F.size(involved) >= 2, two).otherwise(F.concat(F.lit("How does "), name, F.lit(" differ from its most commonly confused concept?"))).alias("comparison_front"),
        F.concat(F.lit("In what clinical or applied contexts does "), name, F.lit(" function differently or have important exceptions?")).alias("nuance_front"),
    )


def assembled(parts: DataFrame) -> DataFrame:
    """options by letter, and error where there are fewer than three wrong options or slots.

    parts: correct struct<text, explanation>, distractors array of the same,
    slots array of level and misconception_id, target_position.  Wrong options
    take the letters left over, in order.  Reasons are cut off afterwards (P12).
    """
    at = F.array_position(F.array(*map(F.lit, LETTERS)), F.col("target_position")).cast("int") - 1

    def option(i: int) -> Column:
        k = F.when(F.lit(i) > at, i - 1).otherwise(i)
        right, wrong, slot = at == i, F.get("distractors", k), F.get("slots", k)
        pick = lambda f: F.when(right, F.col(f"correct.{f}")).otherwise(wrong[f])
        return F.struct(F.lit(LETTERS[i]).alias("letter"), pick("text").alias("text"), right.alias("is_correct"), F.coalesce(pick("explanation"), F.lit("")).alias("explanation"), F.when(~right, slot.level).alias("distractor_level"), F.when(~right, slot.misconception_id).alias("misconception_id"))

    few = F.coalesce(F.least(F.size("distractors"), F.size("slots")), F.lit(0)) < 3
    return parts.withColumn("error", F.when(few, "distractor count mismatch")).withColumn("options", F.when(~few, F.array(*map(option, range(4)))))


def rebuilt(failures: DataFrame) -> DataFrame:
    """Questions from the log of failed validations (S22): what the id says, and the gate
    that the reason names."""
    told = T.question_id_parts(F.col("question_id"))
    rows = failures.withColumn("__id", told)
    anchors = F.when(F.coalesce("__id.anchor", F.lit("")) != "", F.array("__id.anchor")).otherwise(F.array().cast("array<string>"))
    return rows.select("question_id", F.col("__id.domain").alias("domain_code"), F.col("__id.tier").alias("difficulty_tier"), F.coalesce("question_stem", F.lit("")).alias("question_stem"), anchors.alias("anchor_uids"), F.lit("validation_fail_log").alias("rescued_from"), T.gate_of_reason(F.col("reason")).alias("original_gate"), F.col("reason").alias("original_reason"))


def from_artefact(records: DataFrame, prefix: str) -> DataFrame:
    """Questions from the records of a report (F46): source_qid, domain, tier,
    generated_stem_preview, generated_options; absent texts are empty."""
    options = F.transform("generated_options", lambda o: F.struct(o.letter.alias("letter"), F.coalesce(o.text, F.lit("")).alias("text"), F.coalesce(o.is_correct, F.lit(False)).alias("is_correct")))
    return records.select(
        F.concat(F.lit(prefix), F.coalesce("source_qid", F.lit("?"))).alias("question_id"), F.col("domain").alias("domain_code"), F.col("tier").alias("difficulty_tier"),
        F.coalesce("generated_stem_preview", F.lit("")).alias("question_stem"), F.coalesce(options, F.array().cast("array<struct<letter:string,text:string,is_correct:boolean>>")).alias("options"),
    )


def representative(rows: DataFrame, id_col: str, steps: list[tuple[Column, int]], ord_col: str) -> DataFrame:
    """For each rule in turn its first rows, until the sample has so many.

    No id comes twice.  A step needs no more rows than its own total and what was
    taken before, so only that many are ever ordered together.
    """
    out, before = None, 0
    for step, (rule, until) in enumerate(steps):
        more = rows.where(rule).orderBy(ord_col).limit(before + until).withColumn("step", F.lit(step))
        every = more if out is None else out.unionByName(more.join(out.select(id_col), id_col, "left_anti"))
        out = every.withColumn("__n", F.row_number().over(Window.orderBy("step", ord_col))).where(F.col("__n") <= until).drop("__n")
        before = until
    return out


def first_of_group(rows: DataFrame, key: str, value: str, ord_col: str) -> DataFrame:
    """The value of each group's first row."""
    return rows.groupBy(key).agg(F.min_by(value, ord_col).alias(value))


def run_limit(rows: DataFrame, ord_col: str, n: int) -> DataFrame:
    """The first n targets of a run."""
    return rows.orderBy(ord_col).limit(n)


def utc_stamp(at: Column) -> Column:
    """ISO 8601, to the second."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def latency_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds between two times."""
    return F.timestamp_diff("MILLISECOND", start, end)


def known(cls: Column, classes: list[str]) -> Column:
    """Whether a class belongs to a taxonomy; null does not."""
    return F.coalesce(cls.isin(*classes), F.lit(False))


def question_record(parts: DataFrame) -> DataFrame:
    """question_id, error, options, tested_concept, flashcard_seeds, topic_keywords, book_reference (P11, all but the plain fields of metadata()).

    parts: question_id, chapter_title, section_title, anchor_label, target_position, correct (text, explanation),
    distractors (array of text, explanation, concept_id, concept_label, misconception_id, misconception_label, misconception_type),
    slots (array of distractor_level and the same three of a misconception), pre_tested and tested_concept (concept_id, concept_label,
    knowledge_tested), flashcard_seeds (a map of front, back), flashcard_fronts (as flashcard_fronts() gives), topic_keywords, own_keywords.

    The concept planned beforehand goes before the one written, but what is tested of it is always as written.  A slot's
    misconception goes before the written one; a written front and written keywords before those of the templates.  error
    tells, in this order, a missing concept and too few wrong options or slots; such rows have no options.
    """
    planned = F.coalesce(F.col("pre_tested.concept_id"), F.lit("")) != ""
    pick = lambda f: F.when(planned, F.col(f"pre_tested.{f}")).otherwise(F.col(f"tested_concept.{f}")).alias(f)
    concept = F.struct(pick("concept_id"), pick("concept_label"), F.coalesce("tested_concept.knowledge_tested", F.lit("")).alias("knowledge_tested"))
    at = F.array_position(F.array(*map(F.lit, LETTERS)), F.col("target_position")).cast("int") - 1
    filled = lambda c: F.nullif(c, F.lit(""))

    def option(i: int) -> Column:
        k = F.when(F.lit(i) > at, i - 1).otherwise(i)
        right, wrong, slot = at == i, F.get("distractors", k), F.get("slots", k)
        only = lambda c: F.when(~right, c)
        both = lambda f: F.when(right, F.col(f"correct.{f}")).otherwise(wrong[f])
        return F.struct(
            F.lit(LETTERS[i]).alias("letter"), both("text").alias("text"), right.alias("is_correct"), F.coalesce(both("explanation"), F.lit("")).alias("explanation"),
            *(F.when(right, F.col(f"__concept.{f}")).otherwise(wrong[f]).alias(f) for f in ("concept_id", "concept_label")), only(slot.distractor_level).alias("distractor_level"), only(F.col("__concept.concept_id")).alias("confused_with"),
            *(only(F.coalesce(filled(slot[f]), wrong[f])).alias(f) for f in ("misconception_id", "misconception_label", "misconception_type")),
        )

    few = F.coalesce(F.least(F.size("distractors"), F.size("slots")), F.lit(0)) < 3
    error = F.when(F.coalesce(F.col("__concept.concept_id"), F.lit("")) == "", "missing tested_concept").when(few, "distractor count mismatch")
    seed = lambda kind, side: filled(F.try_element_at("flashcard_seeds", F.lit(kind))[side])
    cards = F.create_map(*(x for kind in ("concept", "comparison", "nuance") for x in (F.lit(kind), F.struct(F.coalesce(seed(kind, "front"), F.col(f"flashcard_fronts.{kind}_front"), F.lit("")).alias("front"), F.coalesce(seed(kind, "back"), F.lit("")).alias("back")))))
    words = F.when(F.size(F.coalesce("topic_keywords", F.array().cast("array<string>"))) > 0, F.col("topic_keywords")).otherwise(F.col("own_keywords"))
    book = F.struct(F.col("chapter_title").alias("chapter"), F.coalesce(filled(F.col("section_title")), F.col("chapter_title")).alias("section"), F.coalesce("anchor_label", F.lit("")).alias("anchor"))
    told = parts.withColumn("__concept", concept).withColumn("__error", error)
    return told.select(
        "question_id", F.col("__error").alias("error"), F.when(F.col("__error").isNull(), F.array(*map(option, range(4)))).alias("options"), F.col("__concept").alias("tested_concept"), cards.alias("flashcard_seeds"),
        F.coalesce(words, F.array().cast("array<string>")).alias("topic_keywords"), book.alias("book_reference"),
    )
