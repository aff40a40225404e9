"""The question document and its derived test view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPTION = "struct<letter:string,text:string,is_correct:boolean,explanation:string>"


#: Documents hold none of the phrases that rules look for: each window's stem and options
#: begin with one of these in turn, some with none.
STEM_PHRASES = ["", "A 40-year-old patient presents with this: ", "All of the following are true except ", "Which option best describes ", "Bilateral damage, yet memory is preserved: ", "Dr. Moss argues so. However, others insist! ", "What is the most appropriate critique of ", "At 9:6 the ratio 1:3 is seen in childhood. ", "The agonist versus antagonist left effect: "]
OPTION_PHRASES = ["", "", "Predict from ", "Identify all ", "It is so because ", "This is correct: ", "Unilateral loss erases all ", "Whereas rather than ", "The adulthood WISC-V ratio 2:5 right ", "Determine via antagonist "]
#: Words of a window, and how many the last one needs.
WINDOW, LEAST = 65, 60


def from_documents(docs: DataFrame) -> DataFrame:
    """One question from each window of 65 words of a document (60 do for the last)."""
    words = docs.select("doc_id", "lang", "source", F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("w")).where(F.size("w") >= LEAST)

    def made(k: Column) -> Column:
        cut = lambda a, n: F.array_join(F.slice("w", k * WINDOW + a, F.lit(n)), " ")
        right = F.substring(F.lit("ABCD"), (F.pmod(F.floor(F.col("doc_id") / 4) + k, F.lit(4)) + 1).cast("int"), F.lit(1))
        phrase = lambda xs, at: F.element_at(F.array(*map(F.lit, xs)), (F.pmod(at, F.lit(len(xs))) + 1).cast("int"))
        option = lambda x, at: F.struct(F.lit(x).alias("letter"), F.concat(phrase(OPTION_PHRASES, F.col("doc_id") + 3 * k + 7 * "ABCD".index(x)), cut(at, 10)).alias("text"), (right == x).alias("is_correct"), cut(at + 5, 10).alias("explanation"))
        return F.struct(
            F.col("doc_id").alias("doc_id"), F.concat(F.lit("QZ-"), F.upper("lang"), F.lit("-"), F.col("doc_id"), F.lit("-"), k).alias("question_id"), F.col("lang").alias("domain"), F.col("source").alias("chapter"),
            (F.pmod(F.col("doc_id") + k, F.lit(4)) + 1).cast("int").alias("difficulty_tier"), F.concat(phrase(STEM_PHRASES, F.col("doc_id") + k), cut(1, 20)).alias("question_stem"),
            F.array(option("A", 21), option("B", 31), option("C", 41), option("D", 51)).alias("options"),
        )

    windows = F.sequence(F.lit(0), F.floor((F.size("w") - LEAST) / WINDOW).cast("int"))
    # The generator keeps the optimizer from cutting the text again wherever a gate reads a column.
    return words.select(F.explode(F.transform(windows, made)).alias("q")).select("q.*")


def correct(field: str = "text") -> Column:
    """A field of the first correct option."""
    return F.get(F.filter("options", lambda o: o.is_correct), F.lit(0))[field]


def distractors(field: str = "text") -> Column:
    return F.transform(F.filter("options", lambda o: ~F.coalesce(o.is_correct, F.lit(False))), lambda o: o[field])


def all_texts() -> Column:
    return F.transform("options", lambda o: o.text)


def by_tier(table: dict[int, float], default: float | int | None = None) -> Column:
    out = F.lit(default)
    for tier, value in table.items():
        out = F.when(F.col("difficulty_tier") == tier, F.lit(value)).otherwise(out)
    return out
