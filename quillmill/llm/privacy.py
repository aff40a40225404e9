"""Personal data and information-theoretic sanitisation (operator 6).

Patterns find e-mail addresses, IP addresses, payment cards and phone numbers:
the protected entities.  The corpus then tells which words give an entity away.
With different texts as events, a word w of the texts of entity e discloses

    PMI(e; w) = log2( p(e|w) / p(e) ),  p(e|w) = df(e, w) / df(w),  p(e) = df(e) / N

of the IC(e) = -log2 p(e) bits that the entity carries.  A word that discloses a
share of at least `generalise_share` (and stands in at least `min_texts`
different texts of the entity) is replaced by a class mark wherever it stands,
in texts without the entity too; from `remove_share` on it is removed.

An entity in fewer than `min_texts` texts is judged by its part (mail domain,
network, card issuer, dialling code), or if that is in too few as well by its
kind: e is then the event that a text holds any entity of the class, and
p(e|w) = (df(e, w) + prior p(e)) / (df(w) + prior), so few texts alone convince
only of rare classes.  All counts cover the whole corpus; hot entities and words
are summed before any shuffle.

Defined results: null and empty texts have no spans.  A repeated row gets the
same spans again, and copies count once in all four counts (texts are told apart
by their hash).  Offsets are code points, ends exclusive.  Extra columns pass
through :func:`sanitise`; the finders ignore them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.arrow_text import numbered_words, text_slices, tidy
from quillmill.llm.durable import durable
from quillmill.llm.jaccard import Maps, node_map

#: The largest bit maps have this power of two of bits (32 MB each).
MAP_BITS = 28
#: Distinct words that a task counts before it hands them on.
COUNTED = 300_000

# The kinds in their order, and the patterns.
KINDS = ("email", "ip", "card", "phone", "term", "removed")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789«»„“”‘’…–—¡¿"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normalised value), sorted by start and kind."""
    found = []
    at = text.find("@")
    while at >= 0:
        # no match leaves the run of characters that addresses are made of
        begin = at
        while begin and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-@")):
            begin -= 1
        run = _EMAIL_RUN.match(text, begin)
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in _EMAIL.finditer(text, begin, run.end())]
        at = text.find("@", run.end())
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), "ip", m[0]))
    for m in _CARD.finditer(text):
        if len(m[0]) >= 12 and 12 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card", digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(digits := re.sub("[^0-9]", "", m[0])) <= 15:
                found.append((m.start(), m.end(), "phone", digits))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def part_of(kind: str, value: str) -> str:
    """What an entity shares with its like: mail domain, network, issuer, dialling code."""
    return value.rpartition("@")[2] if kind == "email" else value.rpartition(".")[0] if kind == "ip" else value[:6] if kind == "card" else value[:4]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def class_id(name: str) -> int:
    return signed(xxhash.xxh64_intdigest(name))


def placed_terms(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of texts without nulls; each piece's text, term, start and stop."""
    names, index, bounds = numbered_words(texts)
    cores = [n.strip(MARKS) for n in names]
    number: dict[str, int] = {}
    term = np.array([number.setdefault(c, len(number)) for c in cores], np.int64)
    whole, left, size = (np.array(x, np.int64)[index] for x in ([len(n) for n in names], [len(n) - len(n.lstrip(MARKS)) for n in names], [len(c) for c in cores]))
    begin = np.cumsum(whole + 1) - whole - 1  # lower-casing keeps the number of code points
    start = begin - np.repeat(begin[bounds[:-1]], np.diff(bounds)) + left
    return [*number], np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), term[index], start, start + size


def covered(spans: list[tuple], start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which pieces overlap one of the spans, which are sorted by their starts."""
    if not spans:
        return np.zeros(len(start), bool)
    reach = np.concatenate([[-1], np.maximum.accumulate([s[1] for s in spans])])
    return reach[np.searchsorted([s[0] for s in spans], stop, "left")] > start


_SPAN = "array<struct<start:bigint,stop:bigint,kind:string,entity:bigint>>"
_CLASS = "array<struct<entity:bigint,part:bigint,family:bigint>>"


def detect(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, text_key long, spans (base entities), classes of the entities, and
    the distinct terms outside the spans of a text that has some."""
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string()), ("entity", pa.int64())]))
    classed = pa.list_(pa.struct([("entity", pa.int64()), ("part", pa.int64()), ("family", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                texts = texts.fill_null("")
                keys, spans, classes, terms, held = [], [], [], [], []
                for t, likely in zip(texts.to_pylist(), pc.match_substring_regex(texts, "[0-9@]").to_pylist(), strict=True):
                    keys.append(signed(xxhash.xxh64_intdigest(t, seed=42)))  # as text_key()
                    own = find_entities(t) if likely else []
                    if own:
                        held.append((len(spans), own))
                    spans.append([{"start": a, "stop": b, "kind": k, "entity": class_id(f"{k}:{v}")} for a, b, k, v in own])
                    classes.append([{"entity": class_id(f"{k}:{v}"), "part": class_id(f"part {k}:{part_of(k, v)}"), "family": class_id(f"kind {k}")} for k, v in sorted({s[2:] for s in own})])
                    terms.append([])
                if held:
                    names, doc, term, start, stop = placed_terms(texts.take(pa.array([i for i, _ in held], pa.int64())))
                    edges = np.searchsorted(doc, np.arange(len(held) + 1))
                    for (i, own), a, b in zip(held, edges, edges[1:], strict=False):
                        free = ~covered(own, start[a:b], stop[a:b]) & (stop[a:b] > start[a:b])
                        terms[i] = [names[k] for k in np.unique(term[a:b][free]).tolist()]
                columns = [ids, pa.array(keys, pa.int64()), pa.array(spans, span), pa.array(classes, classed), pa.array(terms, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "text_key", "spans", "classes", "terms"])

    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(tidy(run), f"`{id_col}` {kind}, text_key bigint, spans {_SPAN}, classes {_CLASS}, terms array<string>")


def marked(keys: DataFrame):
    """A bit map, for every task, of the cells of the hashes in column a."""
    bits = min(MAP_BITS, max(20, math.ceil(math.log2(16 * keys.count() + 1))))
    return keys.sparkSession.sparkContext.broadcast(node_map(keys, bits))


def term_documents(docs: DataFrame, detected: DataFrame, *, text_col: str = "text") -> DataFrame:
    """term, df long: in how many different texts each word stands.

    Texts are counted where they are read, but for those that a bit map shows as
    copies: these meet first.  Two keys in one cell cost work, not results.
    """
    texts = docs.select(text_key(text_col).alias("a"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    copies = marked(detected.groupBy("text_key").count().where("count > 1").select(F.col("text_key").alias("a")))

    def chosen(batch: pa.RecordBatch, copied: bool) -> pa.RecordBatch:
        return batch.filter(pa.array(Maps.has(copies.value, np.asarray(batch.column(0)).view(np.uint64)) == copied))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            batch = chosen(batch, True)
            new = [not (k in seen or seen.add(k)) for k in batch.column(0).to_pylist()]
            yield batch.filter(pa.array(new, pa.bool_()))

    def counting(single: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()

            def counted() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())], ["term", "df"])
                counts.clear()
                return out

            for batch in batches:
                for _, own in text_slices(chosen(batch, False) if single else batch):
                    names, index, bounds = numbered_words(own)
                    number: dict[str, int] = {}
                    term = np.array([number.setdefault(n.strip(MARKS), len(number)) for n in names], np.int64)
                    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                    once = np.unique(doc * len(number) + term[index]) % len(number)
                    each = np.bincount(once, minlength=len(number)).tolist()
                    for t, n in zip(number, each, strict=True):
                        counts[t] += n
                    del counts[""]
                    if len(counts) > COUNTED:
                        yield counted()
            if counts:
                yield counted()

        return run

    met = texts.mapInArrow(tidy(gather), "a bigint, text string").dropDuplicates(["a"])
    found = texts.mapInArrow(tidy(counting(True)), "term string, df bigint").unionByName(met.mapInArrow(tidy(counting(False)), "term string, df bigint"))
    return found.groupBy("term").agg(F.sum("df").alias("df"))


def disclosures(docs: DataFrame, detected: DataFrame, *, text_col: str = "text", min_texts: int = 3, generalise_share: float = 0.9, remove_share: float = 0.98, prior: float = 1.0) -> DataFrame:
    """entity (or the class that it is judged by), term, kind (term or removed), bits disclosed."""
    total = detected.select("text_key").distinct().count()
    texts = detected.where(F.size("spans") > 0).select("text_key", "classes", "terms").dropDuplicates(["text_key"])
    things = F.array_distinct(F.flatten(F.transform("classes", lambda c: F.array(c.entity, c.part, c.family))))
    held = texts.select("text_key", F.explode(things).alias("thing"))
    enough = durable(held.groupBy("thing").agg(F.count("*").alias("df_thing")).where(F.col("df_thing") >= min_texts))
    families = F.broadcast(enough.where(F.col("thing").isin([class_id(f"kind {k}") for k in KINDS[:4]])))  # at most four rows
    named = texts.select(F.explode("classes").alias("c")).select("c.*").distinct()
    for level, known in (("entity", enough), ("part", enough), ("family", families)):
        named = named.join(known.select(F.col("thing").alias(level), F.col("thing").alias(f"by_{level}")), level, "left")
    used = named.select(F.coalesce("by_entity", "by_part", "by_family").alias("thing"), F.col("by_entity").isNull().alias("pooled")).where("thing is not null").distinct()
    judging = held.join(used.join(enough, "thing"), "thing")
    pairs = (
        judging.join(texts.select("text_key", "terms"), "text_key").select("thing", "pooled", "df_thing", F.explode("terms").alias("term"))
        .groupBy("thing", "pooled", "df_thing", "term").agg(F.count("*").alias("df_pair")).where(F.col("df_pair") >= min_texts)
    )
    known = pairs.join(term_documents(docs, detected, text_col=text_col), "term")
    content = F.log2(F.lit(float(max(total, 2))) / F.col("df_thing"))
    seen = F.when(F.col("pooled"), (F.col("df_pair") + prior * F.col("df_thing") / float(max(total, 2))) / (F.col("df") + prior)).otherwise(F.col("df_pair") / F.col("df"))
    bits = content + F.log2(F.least(F.lit(1.0), seen))
    share = F.when(content > 0, F.col("bits") / content).otherwise(0.0)
    judged = known.withColumn("bits", bits).withColumn("share", share).where(F.col("share") >= generalise_share)
    return judged.select(F.col("thing").alias("entity"), "term", F.when(F.col("share") >= remove_share, "removed").otherwise("term").alias("kind"), "bits")


def mentions(docs: DataFrame, terms: DataFrame, *, text_col: str = "text") -> DataFrame:
    """text_key, term, start, stop: every place, outside entities, of (at least) the terms."""
    wanted = marked(terms.select(F.xxhash64("term").alias("a")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for keys, texts in text_slices(batch):
                new = [not (k in seen or seen.add(k)) for k in keys.to_pylist()]  # copies in one task
                keys, texts = keys.filter(pa.array(new, pa.bool_())), texts.filter(pa.array(new, pa.bool_()))
                names, doc, term, start, stop = placed_terms(texts)
                hit = Maps.has(wanted.value, np.fromiter((xxhash.xxh64_intdigest(n, seed=42) for n in names), np.uint64, len(names)))
                at = np.flatnonzero(hit[term] & (stop > start)) if len(names) else np.zeros(0, np.int64)
                edges = np.flatnonzero(np.diff(doc[at], prepend=-1))
                free = [own[~covered(find_entities(texts[int(doc[own[0]])].as_py()), start[own], stop[own])] for own in np.split(at, edges[1:]) if len(own)]
                at = np.concatenate([np.zeros(0, np.int64), *free])
                columns = [keys.take(pa.array(doc[at], pa.int64())), pa.array([names[k] for k in term[at].tolist()], pa.string()), pa.array(start[at], pa.int64()), pa.array(stop[at], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["text_key", "term", "start", "stop"])

    return docs.select(text_key(text_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).mapInArrow(tidy(run), "text_key bigint, term string, start bigint, stop bigint")


def find_private(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """id_col, text_key, spans: array of (start, stop, kind, entity), sorted; a
    word's entity is the one (or the class) of which it discloses most.

    Detection runs once and is kept in the checkpoint folder (no text but the
    terms of texts with entities); the second pass over the texts counts words,
    the third finds the judged ones wherever they stand.
    """
    detected = durable(detect(docs, id_col=id_col, text_col=text_col))
    risky = disclosures(docs, detected, text_col=text_col, **thresholds)
    worst = durable(risky.groupBy("term").agg(F.min("kind").alias("kind"), F.max(F.struct("bits", "entity")).entity.alias("entity")))  # "removed" before "term"
    extra = (
        mentions(docs, worst, text_col=text_col).join(worst, "term").select("text_key", F.struct("start", "stop", "kind", "entity").alias("s"))
        .groupBy("text_key").agg(F.collect_set("s").alias("extra"))
    )  # fmt: skip  # at most the words of one text
    return detected.join(extra, "text_key", "left").select(id_col, "text_key", sorted_spans(F.concat("spans", F.coalesce("extra", F.expr(f"cast(array() as {_SPAN})")))).alias("spans"))


def sorted_spans(spans: Column) -> Column:
    order = F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s.kind).alias("rank"), s.stop.alias("stop"), s.kind.alias("kind"), s.entity.alias("entity")))
    return F.transform(F.array_sort(order), lambda s: F.struct(s.start.alias("start"), s.stop.alias("stop"), s.kind.alias("kind"), s.entity.alias("entity")))


def redact(text: str, spans: list[dict]) -> str:
    """text with each span replaced by its kind's mark; overlapping spans become
    one, under the first's kind.  Words to be removed leave no mark."""
    out, done = [], 0
    i = 0
    while i < len(spans):
        start, stop, kind = spans[i]["start"], spans[i]["stop"], spans[i]["kind"]
        i += 1
        while i < len(spans) and spans[i]["start"] < stop:
            stop = max(stop, spans[i]["stop"])
            i += 1
        out += [text[done:start], "" if kind == "removed" else f"[{kind.upper()}]"]
        done = stop
    return "".join([*out, text[done:]])


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """docs with the spans of :func:`find_private` replaced in the text; every
    row and column stays, a null text too."""
    found = find_private(docs, id_col=id_col, text_col=text_col, **thresholds).where(F.size("spans") > 0)
    key, known, spans = (unlike(name, docs.columns) for name in ("key", "known", "spans"))
    plans = found.groupBy(F.col("text_key").alias(known)).agg(F.first("spans").alias(spans))  # equal texts have equal spans
    keyed = docs.withColumn(key, text_key(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts, spans = batch.column(at), batch.column(batch.num_columns - 1)
            new = [redact(t.as_py(), s) if s and t.is_valid else t.as_py() for t, s in zip(texts, spans.to_pylist(), strict=True)]
            columns = [*batch.columns[:-1]]
            columns[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    joined = keyed.join(plans, F.col(key) == F.col(known), "left")
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), spans).mapInArrow(tidy(run), docs.schema)


def unlike(name: str, taken: list[str]) -> str:
    """name, with underscores before it until no column is called so."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def text_key(text_col: str) -> Column:
    """The hash by which detect() tells texts apart, as a built-in."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
