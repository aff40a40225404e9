"""Text functions as Column builders: everything stays in built-in expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as t

from quillmill.functions import refdata

LATIN = "a-zà-öø-ÿ"
# Broken sequences and the characters they were (two dashes, four quotes, the no-break space).
MOJIBAKE = [("â€\u201d", "—"), ("â€\u201c", "–"), ("â€™", "’"), ("â€˜", "‘"), ("â€œ", "“"), ("â€\x9d", "”"), ("Â\xa0", "\xa0")]
#: The namespace of name-based ids, as hex.
NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def words_array(items: Iterable[str]) -> Column:
    return F.array(*map(F.lit, items))


def tokens(text: Column, least: int = 4, stop: Iterable[str] = ()) -> Column:
    """Lower-case Latin words of at least `least` letters, duplicates kept.

    One pass over the text; the word borders are written out over letters, digits
    and the underscore.
    """
    word = rf"(?<![\p{{L}}\p{{N}}_])[{LATIN}]{{{least},}}(?![\p{{L}}\p{{N}}_])"
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(word), 0)
    stop = [*stop]
    return F.filter(found, lambda w: ~w.isin(*stop)) if stop else found


def folded(text: Column) -> Column:
    """Every character from À to ɏ as an x, a letter like the others."""
    return F.regexp_replace(text, "[\u00c0-\u024f]", "x")


def token_set(text: Column, least: int = 4, stop: Iterable[str] = ()) -> Column:
    return F.array_distinct(tokens(text, least, stop))


def slug_tokens(slug: Column, least: int = 3) -> Column:
    """Parts of a hyphenated id."""
    return F.array_distinct(F.filter(F.split(F.lower(slug), "-"), lambda t: F.length(t) >= least))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once a row, however often use reads it, also in lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ngrams(words: Column, n: int = 5) -> Column:
    """The distinct word n-grams; fewer words than n give none."""

    def cut(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))

    return bound(words, cut)


def appears_in(word: Column, texts: Column) -> Column:
    """Substring containment in any of the texts."""
    return F.exists(texts, lambda t: F.contains(t, word))


def has_word(text: Column, word: str) -> Column:
    """Whole-word presence, any case."""
    return F.coalesce(text.rlike(rf"(?i)\b\Q{word}\E\b"), F.lit(False))


def begin_within(a: str, b: str, most: int, flags: str = "") -> str:
    """A pattern: a word of `a` and one of `b`, in either order, that begin at most so
    many characters apart (F07)."""
    one = lambda x, y: rf"\b(?=(?:{x})\b)(?=(?s:.{{0,{most}}})\b(?:{y})\b)"
    return f"{flags}(?:{one(a, b)}|{one(b, a)})"


def jaccard(a: Column, b: Column) -> Column:
    """Share of the union; 0 for two empty sets."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0)), F.lit(0.0))


def jaccard_distance(a: Column, b: Column) -> Column:
    """1 for two empty sets."""
    return F.lit(1.0) - jaccard(a, b)


def slugify(text: Column, most: int = 60) -> Column:
    """Hyphenated lower-case name; cut after trimming, so it may end in a hyphen."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, most)


def normalise_label(text: Column) -> Column:
    """Letters, digits and single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9 ]", " "), " +", " "))


def repair_mojibake(text: Column) -> Column:
    """Seven characters whose UTF-8 was read as a one-byte code page."""
    for broken, right in MOJIBAKE:
        text = F.replace(text, F.lit(broken), F.lit(right))
    return text


def repair_mojibake_deep(value: Column, kind: t.DataType) -> Column:
    """The same in every string of a nested value; keys of maps stay."""
    if isinstance(kind, t.StringType):
        return repair_mojibake(value)
    if isinstance(kind, t.ArrayType):
        return F.transform(value, lambda x: repair_mojibake_deep(x, kind.elementType))
    if isinstance(kind, t.MapType):
        return F.transform_values(value, lambda _, x: repair_mojibake_deep(x, kind.valueType))
    if isinstance(kind, t.StructType):
        return F.when(value.isNotNull(), F.struct(*(repair_mojibake_deep(value[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    return value


def name_uuid(name: Column, namespace: str = NAMESPACE) -> Column:
    """Version-5 UUID: SHA-1 of namespace and name, with version and variant set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def hash_slot(key: Column, at: int, digits: int, slots: int) -> Column:
    """A slot by a slice of the key's SHA-256 (F16)."""
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), at, digits), 16, 10).cast("long") % slots


def strip_fence(text: Column) -> Column:
    """The body of a fenced block."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))


def gate_of_reason(reason: Column) -> Column:
    """The name before the first colon."""
    return F.coalesce(F.nullif(F.regexp_extract(reason, r"^([\w_]+):", 1), F.lit("")), F.lit("unknown"))


def question_id_parts(qid: Column) -> Column:
    """domain, anchor, tier letter and tier of an id such as QZ-DOM-AP-D7-PHY-058-M-01.

    The domain is the second part ("?" for fewer than three parts), the anchor
    stands from the fourth part to the last tier letter before the end (null for
    fewer than five parts or without one), the tier is that of the part before
    the last (0 for other letters).
    """
    parts = F.split(qid, "-")
    n = F.size(parts)
    letters = F.filter(F.sequence(F.lit(3), n - 2), lambda i: F.get(parts, i).isin("E", "M", "H", "X"))
    at = F.when(n >= 5, F.get(letters, F.size(letters) - 1))
    letter = F.get(parts, n - 2)
    return F.struct(
        F.when(n > 2, F.get(parts, F.lit(1))).otherwise("?").alias("domain"),
        F.when(at.isNotNull(), F.array_join(F.slice(parts, F.lit(4), at - 3), "-")).alias("anchor"),
        letter.alias("tier_letter"),
        F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, "EMHX")), F.coalesce(letter, F.lit(""))).cast("int"), F.lit(0)), F.lit(0)).alias("tier"),
    )


def ages(text: Column) -> Column:
    """Every age of a text in years: 16:11, "aged 16", "16 year old", "16 years, 11 months" (F21)."""
    def told(pattern: str, months: bool) -> Column:
        parts = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), lambda m: F.struct(F.regexp_extract(m, pattern, 1).cast("int").alias("y"), (F.regexp_extract(m, pattern, 2).cast("int") if months else F.lit(0)).alias("m")))
        return F.filter(parts, lambda p: p.m < 12)

    clock = F.filter(told(r"\b(\d{1,2}):(\d{1,2})\b", True), lambda p: p.y.between(1, 109))
    every = F.concat(clock, told(r"(?i)\b(?:age|aged|ages)\s+(\d{1,3})\b", False), told(r"(?i)\b(\d{1,3})[-\s]year[-\s]old\b", False), told(r"(?i)\b(\d{1,3})\s+years?\s*,?\s*(\d{1,2})\s+months?\b", True))
    return F.transform(every, lambda p: p.y + p.m / 12.0)


def lead_shape(text: Column) -> Column:
    """How an option begins; the first rule that holds."""
    t = F.trim(F.coalesce(text, F.lit("")))
    first = F.regexp_extract(t, r"^(\S+)", 1)
    return (
        F.when(t == "", "EMPTY").when(t.rlike("(?i)^(the|a|an)\\s+"), "DEF_ART_NP").when(t.rlike("(?i)^(when|if)\\b"), "WHEN_IF")
        .when(first.rlike("(?i)^[a-z]+ing$"), "VERB_ING").when(first.rlike("(?i)^[a-z]+ed$"), "VERB_PAST")
        .when(t.rlike("^[A-Z][a-z]+\\s+[A-Z]"), "PROPER_NP").otherwise("NP")
    )


def weighted_similarity(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Half the slug's, three tenths the label's, a fifth the description's similarity."""
    return 0.5 * jaccard(a["slug"], b["slug"]) + 0.3 * jaccard(a["label"], b["label"]) + 0.2 * jaccard(a["description"], b["description"])


def coverage(keywords: Column, source: Column) -> Column:
    """Share of keywords that stand in the source; 1 without keywords."""
    n = F.size(keywords)
    return F.when(n == 0, 1.0).otherwise(F.size(F.filter(keywords, lambda k: F.contains(source, k))) / n)


def sorted_by_length(terms: Column, k: int) -> Column:
    """The k longest terms, ties in their own order."""
    ranked = F.array_sort(F.transform(terms, lambda t, i: F.struct((-F.length(t)).alias("n"), i.alias("i"), t.alias("t"))))
    return F.transform(F.slice(ranked, 1, k), lambda x: x.t)


def specific_case(stem: Column) -> Column:
    """The first kind of concrete detail in a stem, else null."""
    s = F.coalesce(stem, F.lit(""))
    out = (
        F.when(s.rlike(r"\b(?:Dr|Mr|Mrs|Ms)\.?\s+\w+"), "named_subject").when(s.rlike(r"(?i)\bage\s+\d+\b"), "named_age")
        .when(s.rlike(r"\b\d+:\d+\b"), "specific_ratio").when(s.rlike(r"\b\d+\s*%"), "specific_percent")
        .when(s.rlike(r"(?i)\b\d+\s*(?:weeks?|months?|years?|days?|hours?)\b"), "specific_duration")
    )
    for marker in refdata.CASE_MARKERS:
        out = out.when(F.contains(F.lower(s), F.lit(marker)), f"stated_case:{marker}")
    return out


def replace_word(text: Column, old: str, new: str) -> Column:
    """Whole words in any case; where the first letter is a capital, the new word's is too."""
    word = lambda first: rf"\b{first}(?i:\Q{old[1:]}\E)\b" if len(old) > 1 else rf"\b{first}\b"
    if not old[0].isalpha():
        return F.regexp_replace(text, rf"(?i)\b\Q{old}\E\b", new)
    return F.regexp_replace(F.regexp_replace(text, word(old[0].upper()), new[0].upper() + new[1:]), word(old[0].lower()), new)
