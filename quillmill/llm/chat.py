"""Chat formatting by prefix-target expansion (operator 3), in built-in functions only.

A turn becomes ``### role: text</turn>`` and a line feed.  Inside texts and roles
the characters that could form a control string are written as a backslash and a
letter, and the backslash itself too, so each text can be read back.

Every assistant turn becomes an example of its own: all turns up to it as one
string, of which only its reply is under the loss mask.  A conversation whose
last turn is not the assistant's (or that has no assistant turn) gives one more
row, the whole conversation with nothing under the mask, so no turn is lost.

Turns are in the order (turn, role, text); nulls come first and count as empty
text or role; repeated rows are turns of their own.  A null conversation id is a
conversation too.  Extra columns are ignored.  The unit is a conversation: its
transcript is one string and has to fit one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template: escapes in the order in which they are written.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    """The reverse, the backslash last: its escape never makes another escape."""
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def expand_targets(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", target_role: str = "assistant") -> DataFrame:
    """conv_col, example int (from 0), text string, loss_start int, loss_chars int
    (of the escaped reply inside text, from 0; null and 0 without a target),
    last boolean (the row that holds the whole conversation).

    One shuffle, of the turns by conversation.
    """
    shown = turns.select(
        F.col(conv_col).alias("conv"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    whole = shown.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    written = whole.select(
        "conv",
        F.transform("turns", lambda t: F.struct(F.concat(F.lit(OPEN), escape(t.role), F.lit(AFTER_ROLE)).alias("head"), escape(t.text).alias("body"), (t.role == target_role).alias("target"))).alias("w"),
    )
    # Only lengths are folded: (end of the turn, start of its body, its length, whether it is a target).
    tail = F.lit(len(CLOSE))
    spans = F.aggregate(
        "w",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<stop:int,start:int,chars:int,target:boolean>>)").alias("found")),
        lambda acc, t: F.struct(
            (acc.at + F.length(t.head) + F.length(t.body) + tail).alias("at"),
            F.concat(acc.found, F.array(F.struct((acc.at + F.length(t.head) + F.length(t.body) + tail).alias("stop"), (acc.at + F.length(t.head)).alias("start"), F.length(t.body).alias("chars"), t.target.alias("target")))).alias("found"),
        ),
        lambda acc: acc.found,
    )
    placed = written.select(
        "conv",
        F.array_join(F.transform("w", lambda t: F.concat(t.head, t.body, F.lit(CLOSE))), "").alias("formatted"),
        F.when(F.exists("w", lambda t: t.target), spans).otherwise(F.expr("cast(array() as array<struct<stop:int,start:int,chars:int,target:boolean>>)")).alias("spans"),
    )
    size = F.length("formatted")
    targets = F.filter("spans", lambda s: s.target)
    rest = F.when(F.coalesce(F.try_element_at(F.transform(targets, lambda s: s.stop), F.lit(-1)), F.lit(-1)) != size, F.array(F.struct(size.alias("stop"), F.lit(None).cast("int").alias("start"), F.lit(0).alias("chars"), F.lit(False).alias("target"))))
    examples = placed.select("conv", "formatted", F.posexplode(F.concat(targets, F.coalesce(rest, F.expr("cast(array() as array<struct<stop:int,start:int,chars:int,target:boolean>>)")))).alias("example", "s"))
    return examples.select(
        F.col("conv").alias(conv_col), "example", F.substring("formatted", F.lit(1), F.col("s.stop")).alias("text"),
        F.col("s.start").alias("loss_start"), F.col("s.chars").alias("loss_chars"), (F.col("s.stop") == size).alias("last"),
    )


def read_turns(text: Column) -> Column:
    """The (role, text) pairs of a formatted string."""
    parts = F.filter(F.split(text, CLOSE), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(unescape(F.substring_index(F.substring(p, len(OPEN) + 1, 1 << 30), AFTER_ROLE, 1)).alias("role"), unescape(F.substring(p, F.locate(AFTER_ROLE, p) + len(AFTER_ROLE), F.lit(1 << 30))).alias("text")))


def read_loss(examples: DataFrame) -> Column:
    """The unescaped text under the mask of an example."""
    return unescape(F.when(F.col("loss_start").isNotNull(), F.substring("text", F.col("loss_start") + 1, F.col("loss_chars"))).otherwise(""))
