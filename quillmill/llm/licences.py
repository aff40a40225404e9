"""Licence scans (operator 4).

One Aho-Corasick automaton over the words of a text finds notice phrases and
identifier tags.  What follows a tag (``SPDX-License-Identifier:``) or
"licensed under" is read as a licence expression: a shunting-yard parser turns
it into postfix form (WITH binds closest, then AND, then OR), and the postfix
form is evaluated to the labels it names and to how permissive the choice is.

Only texts that hold a word with which some phrase could match reach the
automaton; words are counted in every text.

Defined results: null and empty texts have no words, no spans and score 0.
Repeated rows are scanned each on its own.  Extra columns are ignored.  A
malformed expression keeps the labels of its known identifiers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.arrow_text import text_slices, tidy

# The phrases whose places are counted, with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Further notice phrases with their labels and the weight of the evidence.
NOTICE_PHRASES = {
    "mit licence": ("mit", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.8),
    "apache licence": ("apache", 0.9),
    "apache software license": ("apache", 0.9),
    "general public licence": ("gpl", 0.9),
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "bsd license": ("bsd", 0.9),
    "2 clause bsd": ("bsd", 0.8),
    "3 clause bsd": ("bsd", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "isc license": ("isc", 0.9),
    "creative commons": ("cc", 0.7),
    "cc by": ("cc", 0.7),
    "cc0 1 0": ("cc", 0.8),
    "public domain": ("public-domain", 0.4),
    "unlicense": ("public-domain", 0.7),
    "all rights reserved": ("proprietary", 0.6),
    "proprietary and confidential": ("proprietary", 0.9),
}
# Words after which a licence expression stands.
TAGS = ("spdx license identifier", "spdx licence identifier", "licensed under", "released under", "dual licensed under")
# Identifier stems in expressions, their labels, and how permissive they are.
IDENTIFIERS = {"mit": ("mit", 1.0), "isc": ("isc", 1.0), "bsd": ("bsd", 1.0), "apache": ("apache", 0.9), "unlicense": ("public-domain", 1.0), "cc0": ("cc", 1.0), "cc": ("cc", 0.6), "mpl": ("mpl", 0.6), "epl": ("epl", 0.5), "lgpl": ("lgpl", 0.4), "gpl": ("gpl", 0.2), "agpl": ("agpl", 0.1), "gnu": ("gpl", 0.2), "proprietary": ("proprietary", 0.0)}
_RE2_GAP = r"[\x{00}-\x{2f}\x{3a}-\x{40}\x{5b}-\x{60}\x{7b}-\x{7f}]"
#: Single words (or parts of them) of which every phrase and tag holds one, so the
#: filter may let a text pass in vain and never stops one that matches.
ANCHORS = rf"(?i)licen[sc]e|clause|reserved|permission|redistribution|creative|domain|proprietary|released|(?:^|{_RE2_GAP})cc(?:0|$|{_RE2_GAP})"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_RE2_WORD = r"[^\x{00}-\x{2f}\x{3a}-\x{40}\x{5b}-\x{60}\x{7b}-\x{7f}]+"
_TO_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
_PART = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+-]*")
_EMPTY_LINE = re.compile(r"\n[ \t\r]*\n")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def postfix(parts: list[str]) -> list[str]:
    """Shunting-yard; unbalanced brackets are dropped."""
    out, held = [], []
    for p in parts:
        if p == "(":
            held.append(p)
        elif p == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if held:
                held.pop()
        elif p in PRECEDENCE:
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[p]:
                out.append(held.pop())
            held.append(p)
        else:
            out.append(p)
    return out + [h for h in reversed(held) if h != "("]


def identifier(name: str) -> tuple[str, float] | None:
    """The label and permissiveness of one identifier, by its longest known stem."""
    stem = re.split(r"[-.+]", name)[0].rstrip("0123456789") if name != "cc0" and not name.startswith("cc0") else "cc0"
    return IDENTIFIERS.get(stem)


def evaluate(parts: list[str]) -> tuple[frozenset[str], float | None]:
    """Labels named by an expression, and the permissiveness of what it grants:
    OR lets the reader choose (the larger), AND binds to both (the smaller), an
    exception after WITH moves it halfway to free use."""
    stack: list[tuple[frozenset[str], float | None]] = []
    for p in postfix(parts):
        if p in PRECEDENCE:
            right = stack.pop() if stack else (frozenset(), None)
            left = stack.pop() if stack else (frozenset(), None)
            values = [v for v in (left[1], right[1]) if v is not None]
            if p == "with":
                value = None if left[1] is None else (1 + left[1]) / 2
                stack.append((left[0], value))
            else:
                value = (max if p == "or" else min)(values) if values else None
                stack.append((left[0] | right[0], value))
        else:
            known = identifier(p)
            stack.append((frozenset([known[0]]), known[1]) if known else (frozenset(), None))
    values = [v for _, v in stack if v is not None]
    return frozenset().union(*(s for s, _ in stack)), min(values) if values else None


def expression_parts(text: str, at: int = 0) -> list[str]:
    """The expression that stands in a text from a place on: identifiers joined by
    operators.  A line feed counts as a blank; a full stop or an empty line ends it."""
    parts: list[str] = []
    wants, done, stopped = True, at, False
    for m in _PART.finditer(text, at):
        if stopped or _EMPTY_LINE.search(text, done, m.start()):
            break
        done, stopped = m.end(), m[0].endswith(".")
        p = m[0].rstrip(".-") or m[0]
        if p in ("the", "version", "license", "licence", "licenses", "a", "terms", "of", "either") or re.fullmatch(r"v?[0-9.]+", p):
            continue
        if p == "(":
            parts.append(p)
        elif p == ")":
            parts.append(p)
        elif p in PRECEDENCE:
            if wants:
                break
            parts.append(p)
            wants = True
        else:
            if not wants:
                if p in ("public", "general", "lesser", "software"):
                    continue
                break
            if identifier(p) is None and not (parts and parts[-1] == "with"):
                break
            parts.append(p)
            wants = False
    while parts and parts[-1] in (*PRECEDENCE, "("):
        parts.pop()
    return parts


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in BASE_PHRASES.items():
        found.add_word(f" {phrase} ", ("base", label, 1.0, phrase.count(" ") + 1))
    for phrase, (label, weight) in NOTICE_PHRASES.items():
        found.add_word(f" {phrase} ", ("notice", label, weight, phrase.count(" ") + 1))
    for tag in TAGS:
        found.add_word(f" {tag} ", ("tag", "", 0.95, tag.count(" ") + 1))
    found.make_automaton()
    return found


def scan(text: str) -> tuple[list[dict], float, float | None]:
    """Spans in order of their first word, the evidence score, the permissiveness."""
    low = text.translate(_TO_LOWER)
    places = [m.span() for m in WORD.finditer(low)]
    joined = " " + " ".join([low[a:b] for a, b in places]) + " "
    starts = np.cumsum([0] + [b - a + 1 for a, b in places])
    spans, doubt, permissive = [], 1.0, []
    for end, (kind, label, weight, size) in _automaton().iter(joined):
        last = int(np.searchsorted(starts, end)) - 1
        first = last - size + 1
        if kind == "tag":
            parts = expression_parts(low, places[last][1])
            labels, value = evaluate(parts)
            if not labels:
                continue
            if value is not None:
                permissive.append(value)
            spans += [{"kind": "expression", "label": x, "first_word": first, "last_word": last} for x in sorted(labels)]
        else:
            if label in (v for v, _ in IDENTIFIERS.values()):
                permissive.append(next(p for v, p in IDENTIFIERS.values() if v == label))
            spans.append({"kind": kind, "label": label, "first_word": first, "last_word": last})
        doubt *= 1 - 0.99 * weight
    spans.sort(key=lambda s: (s["first_word"], s["last_word"], s["kind"], s["label"]))
    return spans, 1 - doubt, min(permissive) if permissive else None


def scan_licences(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_words long, spans array of (kind base, notice or expression;
    label; first_word, last_word long, from 0), score double (how sure it is
    that a licence is stated), permissive double (null: none known)."""
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                texts = texts.fill_null("")
                words = pc.cast(pc.count_substring_regex(texts, _RE2_WORD), pa.int64())
                likely = np.asarray(pc.match_substring_regex(texts, ANCHORS))
                spans: list[list[dict]] = [[]] * len(ids)
                scores, permissive = [0.0] * len(ids), [None] * len(ids)
                for i in np.flatnonzero(likely).tolist():
                    spans[i], scores[i], permissive[i] = scan(texts[i].as_py())
                yield pa.RecordBatch.from_arrays([ids, words, pa.array(spans, pa.list_(span)), pa.array(scores, pa.float64()), pa.array(permissive, pa.float64())], [id_col, "n_words", "spans", "score", "permissive"])

    out = f"`{id_col}` {kind}, n_words bigint, spans array<struct<kind:string,label:string,first_word:bigint,last_word:bigint>>, score double, permissive double"
    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(tidy(run), out)
