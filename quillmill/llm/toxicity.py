"""Toxicity by a weighted finite-state pattern grammar (operator 5).

A text is read as symbols: a lexicon writes each word's class (learned, from
labelled texts as whole words and word beginnings with their log odds; paired,
the second word of a learned pair of neighbours; intent, harm, target, negation,
reporting and strengthening words from fixed lists), and quotation marks, stops
and line ends are symbols of their own.  Six transducers, given as tables of
arcs (state, symbol) -> (state, symbol, factor), read these symbols in turn:

* insult makes learned words insults, stronger ones behind a strengthening word;
* threat makes paired words threats, and the last word of an intent, a harm and
  a target (or an intent, a target and a harm) in one clause;
* negation turns the insults and threats among the next few words over;
* reported speech does so up to the end of a clause, or inside quotation marks;
* target tells which of the others a clause aims at somebody;
* the clause machine marks where a clause with a match ends.

:func:`compose` multiplies them into one machine when the grammar is built; only
the product runs over texts.  A text is scored by its matched clauses: what they
hold by kind, the strongest, and how much of the text they are.  A logistic
function of these, fitted on the part of the labelled sample that the lexicon has
not seen, gives the score.  Its weights can't be negative and every feature grows
with its matches, so the grammar's order stands whatever the labels say: a match
never lowers a score, and negated or reported matches never raise it as much as
plain ones.  The model is a few thousand entries, bounded by a parameter.

Defined results: null and empty texts match no clause and get the score of a
text without any; repeated rows get equal scores; extra columns are ignored; an
empty table gives no rows.  Without labelled rows, or with one label only, the
score is the same for every text.  Held-out labels are never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.arrow_text import numbered_words, released, slices, text_slices, tidy
from quillmill.llm.labelled import labelled_sample, unique_texts

#: Labelled texts used for fitting at most, and lexicon entries kept at most.
SAMPLE = 8_000
LEXICON = 4_000
#: Lengths of word beginnings that may be lexicon entries.
BEGINNINGS = (4, 5, 6, 7, 8, 9)
#: Share of the toxic texts that a pair must stand in: fewer are turns of phrase of near copies.
PAIR_SHARE = 0.01
#: Words that a negation reaches, and words from one part of a threat to the next.
REACH = 5
SPAN = 4
#: Log odds of a threat that the fixed lists tell, as learned words have theirs.
THREAT_WEIGHT = 3.0

# Words of the transducers that are not learned.
TARGETS = frozenset("you your yours u he she they him her them this that these those people du dich dir ihr euch sie er tu te toi vous il elle ils usted tú ti él ella ellos".split())
NEGATIONS = frozenset("not no never nor without n't don't isn't aren't nicht kein keine keinen nie niemals ohne pas jamais aucun sans nunca jamás sin ni".split())
REPORTS = frozenset("said says say told wrote called calls quoted claims claimed sagt sagte meinte schrieb nannte dit disait écrit appelle dijo dice escribió llamó".split())
INTENTS = frozenset("will shall must gonna going want werde werden wird wollen soll muss vais va vas allons veux voy va vamos quiero".split())
HARMS = frozenset("kill hurt destroy beat shoot burn hang stab strangle punch töten umbringen schlagen verbrennen erschießen zerstören tuer frapper brûler détruire matar golpear quemar destruir".split())
STRONG_WORDS = frozenset("so such very total totally complete completely utter utterly absolute absolutely sehr völlig très tellement muy tan".split())
_STRIP = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‘’…–—¡¿"
_QUOTES, _STOPS = frozenset("\"«»„“”"), frozenset(".!?;|…")

#: Stands behind a whole word among lexicon entries, and between the words of a pair; never part of a word.
WHOLE, BETWEEN = "\n", " "

# Symbols: first those that the lexicon writes, then those that the transducers add.
OTHER, TARGET, NEGATION, REPORT, QUOTE, STOP, LINE, INTENT, HARM, STRONG, LEARNED, PAIRED = range(12)
INSULT, THREAT, NEGATED_INSULT, NEGATED_THREAT, REPORTED_INSULT, REPORTED_THREAT, AIMED_INSULT, AIMED_THREAT, LATE_TARGET, CLAUSE = range(12, 22)
SYMBOLS = 22
HITS = (INSULT, THREAT, NEGATED_INSULT, NEGATED_THREAT, REPORTED_INSULT, REPORTED_THREAT, AIMED_INSULT, AIMED_THREAT)
OUTRIGHT = (INSULT, THREAT, AIMED_INSULT, AIMED_THREAT)
INSULTS, THREATS, AIMED = (INSULT, AIMED_INSULT), (THREAT, AIMED_THREAT), (AIMED_INSULT, AIMED_THREAT)
#: Symbols that single words can be, once insults and threats are told.
WORDS = (OTHER, TARGET, REPORT, INTENT, HARM, STRONG, INSULT, THREAT)
N_FEATURES = 8

Arcs = dict[tuple[int, int], tuple[int, int, float]]


@dataclass
class Transducer:
    """Arcs by (state, symbol); where there is none, the state stays and the symbol
    is written as it is.  State 0 is the first."""

    states: int
    arcs: Arcs

    def arc(self, state: int, symbol: int) -> tuple[int, int, float]:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))

    def run(self, symbols: Iterable[int]) -> list[tuple[int, float]]:
        state, out = 0, []
        for s in symbols:
            state, written, factor = self.arc(state, s)
            out.append((written, factor))
        return out


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that writes what `second` writes on reading what `first` writes:
    the reachable pairs of states, factors multiplied."""
    number, queue, arcs = {(0, 0): 0}, [(0, 0)], {}
    for p, q in queue:
        for s in range(SYMBOLS):
            p2, middle, f = first.arc(p, s)
            q2, written, g = second.arc(q, middle)
            if (p2, q2) not in number:
                number[p2, q2] = len(queue)
                queue.append((p2, q2))
            arcs[number[p, q], s] = number[p2, q2], written, f * g
    return Transducer(len(queue), arcs)


def insult() -> Transducer:
    """States: nothing, a strengthening word just before."""
    arcs: Arcs = {(1, s): (0, s, 1.0) for s in (OTHER, TARGET, NEGATION, REPORT, STOP, LINE, INTENT, HARM, PAIRED)}
    for state, factor in ((0, 1.0), (1, 1.25)):
        arcs[state, STRONG] = 1, STRONG, 1.0
        arcs[state, LEARNED] = 0, INSULT, factor
    return Transducer(2, arcs)


def threat() -> Transducer:
    """States: nothing; an intent, an intent and a harm, or an intent and a target,
    each with the number of words in which the next part has to come."""
    intent, harm, meant = (lambda left, row=row: row * SPAN + left if left else 0 for row in range(3))
    arcs: Arcs = {}
    for state in range(3 * SPAN + 1):
        for s in (OTHER, TARGET, NEGATION, REPORT, HARM, STRONG, INSULT):
            row, left = divmod(max(0, state - 1), SPAN)
            arcs[state, s] = (intent, harm, meant)[row](left), s, 1.0
        for end in (STOP, LINE):
            arcs[state, end] = 0, end, 1.0
        arcs[state, INTENT] = intent(SPAN), INTENT, 1.0
        arcs[state, PAIRED] = 0, THREAT, 1.0
    for left in range(1, SPAN + 1):
        arcs[intent(left), HARM] = arcs[harm(left), HARM] = harm(SPAN), HARM, 1.0
        arcs[intent(left), TARGET] = arcs[meant(left), TARGET] = meant(SPAN), TARGET, 1.0
        arcs[harm(left), TARGET] = arcs[meant(left), HARM] = 0, THREAT, 1.0
    return Transducer(3 * SPAN + 1, arcs)


def negation() -> Transducer:
    """States: how many of the next words are still negated."""
    arcs: Arcs = {}
    turned = {INSULT: NEGATED_INSULT, THREAT: NEGATED_THREAT}
    for left in range(REACH + 1):
        arcs[left, NEGATION] = REACH, NEGATION, 1.0
        for end in (STOP, LINE):
            arcs[left, end] = 0, end, 1.0
        for word in WORDS:
            arcs[left, word] = max(0, left - 1), turned.get(word, word) if left else word, 0.25 if left and word in turned else 1.0
    return Transducer(REACH + 1, arcs)


def reported_speech() -> Transducer:
    """States: the writer speaks, somebody is said to speak, words in quotation marks."""
    arcs: Arcs = {(0, REPORT): (1, REPORT, 1.0), (1, STOP): (0, STOP, 1.0)}
    for state, after in ((0, 2), (1, 2), (2, 0)):
        arcs[state, QUOTE] = after, QUOTE, 1.0
        arcs[state, LINE] = 0, LINE, 1.0
        if state:
            arcs[state, INSULT] = state, REPORTED_INSULT, 0.5
            arcs[state, THREAT] = state, REPORTED_THREAT, 0.5
    return Transducer(3, arcs)


def target() -> Transducer:
    """States: nobody is meant yet, somebody is, a match came before anybody was."""
    arcs: Arcs = {(0, TARGET): (1, TARGET, 1.0), (2, TARGET): (1, LATE_TARGET, 1.0)}
    for hit, aimed in ((INSULT, AIMED_INSULT), (THREAT, AIMED_THREAT)):
        arcs[0, hit] = 2, hit, 1.0
        arcs[1, hit] = 1, aimed, 1.25
    for state in range(3):
        for end in (STOP, LINE):
            arcs[state, end] = 0, end, 1.0
    return Transducer(3, arcs)


def clause() -> Transducer:
    """States: no match yet, a match."""
    arcs: Arcs = {(0, hit): (1, hit, 1.0) for hit in HITS}
    arcs |= {(1, end): (0, CLAUSE, 1.0) for end in (STOP, LINE)}
    return Transducer(2, arcs)


class Machine:
    """The composed transducer as flat tables, for running over texts."""

    def __init__(self, whole: Transducer):
        flat = [whole.arc(p, s) for p in range(whole.states) for s in range(SYMBOLS)]
        self.after = [n * SYMBOLS for n, _, _ in flat]
        self.written = [w for _, w, _ in flat]
        self.factor = [f for _, _, f in flat]

    def matches(self, symbols: list[int]) -> tuple[list[int], list[int], list[float]]:
        """Places, symbols and factors of everything from INSULT on that is written."""
        after, written, factor = self.after, self.written, self.factor
        places, kinds, factors = [], [], []
        state = 0
        for at, s in enumerate(symbols):
            s += state
            if (w := written[s]) >= INSULT:
                places.append(at)
                kinds.append(w)
                factors.append(factor[s])
            state = after[s]
        return places, kinds, factors


def parts() -> list[Transducer]:
    return [insult(), threat(), negation(), reported_speech(), target(), clause()]


@cache
def composed() -> Machine:
    return Machine(reduce(compose, parts()))


@dataclass
class Grammar:
    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    pairs: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES + 1))
    machine: Machine = field(default_factory=composed)

    def __post_init__(self):
        halves = [p.split(BETWEEN) for p in self.pairs]
        self.openers = {w: i for i, w in enumerate(sorted({a for a, _ in halves}))}
        self.closers = {w: i for i, w in enumerate(sorted({b for _, b in halves}))}
        known = sorted((self.openers[a] * len(self.closers) + self.closers[b], self.pairs[a + BETWEEN + b]) for a, b in halves)
        self.pair_keys = np.array([k for k, _ in known], np.int64)
        self.pair_weights = np.array([w for _, w in known])

    def word(self, core: str) -> tuple[int, float]:
        """The class and weight of one word; targets and harms have that of a threat they may end."""
        if core in NEGATIONS or core.endswith("n't"):
            return NEGATION, 0.0
        if core in REPORTS:
            return REPORT, 0.0
        if core in self.words:
            return LEARNED, self.words[core]
        for n in BEGINNINGS:
            if n > len(core):
                break
            if core[:n] in self.beginnings:
                return LEARNED, self.beginnings[core[:n]]
        if core in TARGETS:
            return TARGET, THREAT_WEIGHT
        if core in HARMS:
            return HARM, THREAT_WEIGHT
        if core in INTENTS or core.endswith("'ll"):
            return INTENT, 0.0
        return (STRONG if core in STRONG_WORDS else OTHER), 0.0

    def read(self, piece: str) -> tuple[list[int], int, float]:
        """A piece's symbols, the word's place among them (-1: no word), its weight."""
        if piece == "\n":
            return [LINE], -1, 0.0
        core = piece.strip(_STRIP)
        if not core:
            return [QUOTE if c in _QUOTES else STOP for c in piece if c in _QUOTES or c in _STOPS], -1, 0.0
        before = piece[: piece.index(core[0])] if piece[0] != core[0] else ""
        kind, weight = self.word(core)
        marks = [QUOTE if c in _QUOTES else STOP for c in piece[len(before) + len(core) :] if c in _QUOTES or c in _STOPS]
        lead = [QUOTE for c in before if c in _QUOTES]
        return [*lead, kind, *marks], len(lead), weight

    def features(self, symbols: list[int], weights: np.ndarray, words: int) -> np.ndarray:
        """What the matched clauses hold of outright insults, of threats, of aimed ones, of
        all with those turned over, their late targets and their number, each against the
        square root of the text's length; the strongest clause; the strength a word."""
        places, kinds, factors = self.machine.matches(symbols)
        out = np.zeros(N_FEATURES)
        if kinds:
            kind, weight = np.array(kinds), weights[places] * np.array(factors)
            sums = np.bincount(kind, weight, SYMBOLS)
            each = np.bincount(np.cumsum(kind == CLAUSE), np.where(np.isin(kind, OUTRIGHT), weight, 0.0))
            held = [sums[list(ks)].sum() for ks in (INSULTS, THREATS, AIMED, HITS)]
            out[:6] = np.array([*held, np.count_nonzero(kind == LATE_TARGET), np.count_nonzero(each)]) / np.sqrt(words + 20)
            out[6:] = np.log1p(each.max()), each.sum() / (words + 20)
        return out

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights[:-1] + self.weights[-1], -30, 30)))

    def slice_features(self, texts: pa.Array) -> np.ndarray:
        """Features of texts without nulls; only texts with a match run the machine."""
        names, index, bounds = numbered_words(texts, lines=True)
        read = [self.read(n) for n in names]
        cores = [n.strip(_STRIP) for n in names]
        places = np.array([r[1] for r in read], np.int64)
        weight = np.array([r[2] for r in read])
        kind = np.array([r[0][r[1]] if r[1] >= 0 else OTHER for r in read], np.int64)[index]
        weights = weight[index] if len(names) else np.zeros(0)
        if len(self.pair_keys) and len(index) > 1:
            opener = np.array([self.openers.get(c, -1) if r[1] + 1 == len(r[0]) else -1 for c, r in zip(cores, read, strict=True)], np.int64)[index]
            closer = np.array([self.closers.get(c, -1) if r[1] == 0 else -1 for c, r in zip(cores, read, strict=True)], np.int64)[index]
            key = np.where((opener[:-1] >= 0) & (closer[1:] >= 0), opener[:-1] * len(self.closers) + closer[1:], -1)
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            hit = self.pair_keys[at] == key
            hit[bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(index))] - 1] = False  # not across texts
            hit &= kind[1:] != LEARNED
            kind[1:][hit] = PAIRED
            weights[1:][hit] = self.pair_weights[at[hit]]
        wordy = np.concatenate([[0], np.cumsum(places[index] >= 0)]) if len(names) else np.zeros(1, np.int64)
        hot = np.concatenate([[0], np.cumsum(np.isin(kind, (LEARNED, PAIRED, HARM)))])
        features = np.zeros((len(texts), N_FEATURES))
        for i in np.flatnonzero(hot[bounds[1:]] > hot[bounds[:-1]]).tolist():
            a, b = int(bounds[i]), int(bounds[i + 1])
            symbols, own = [], []
            for name, k, w in zip(index[a:b].tolist(), kind[a:b].tolist(), weights[a:b].tolist(), strict=True):
                marks, place, _ = read[name]
                if len(marks) == 1 and place == 0:
                    symbols.append(k)
                    own.append(w)
                else:
                    for j, s in enumerate(marks):
                        symbols.append(k if j == place else s)
                        own.append(w if j == place else 0.0)
            features[i] = self.features(symbols, np.array(own), int(wordy[b] - wordy[a]))
        return features

    def score_slice(self, texts: pa.Array) -> np.ndarray:
        return self.probability(self.slice_features(texts))


def _pieces(text: str) -> list[str]:
    return text.lower().replace("\n", " \n ").split(" ")


def _entries(text: str) -> set[str]:
    """Word beginnings, whole words with a mark behind them, and pairs of neighbours."""
    found, before = set(), ""
    for piece in _pieces(text):
        core = piece.strip(_STRIP)
        if len(core) >= 3 and not core.isdigit() and core + WHOLE not in found:
            found.add(core + WHOLE)
            found.update(core[:n] for n in BEGINNINGS if n <= len(core))
        if before and core and piece[0] == core[0]:
            found.add(before + BETWEEN + core)
        before = core if piece and core and piece[-1] == core[-1] else ""
    return found


def learn_lexicon(texts: list[str], labels: list[int], most: int) -> tuple[dict[str, float], dict[str, float], dict[str, float]]:
    """Words, word beginnings and pairs of words that stand in toxic texts far more
    often; pairs only of words that say nothing alone."""
    rows = Counter(labels)
    # Most entries are rare; counting their hashes first keeps the strings out of memory.
    hashes = [np.fromiter(map(hash, _entries(t)), np.int64) for t, y in zip(texts, labels, strict=True) if y == 1]
    seen, times = np.unique(np.concatenate(hashes), return_counts=True)
    often = set(seen[times >= 4].tolist())
    del hashes, seen, times
    toxic, clean = Counter(), Counter()
    for t, y in zip(texts, labels, strict=True):
        (toxic if y == 1 else clean).update(e for e in _entries(t) if hash(e) in often)
    entries: list[tuple[float, str]] = []
    n1, n0 = max(1, rows[1]), max(1, rows[0])
    for key, a in toxic.items():
        b, pair = clean[key], BETWEEN in key
        p, q = (a + 0.5) / (n1 + 1), (b + 0.5) / (n0 + 1)
        if a < 4 or pair and p < PAIR_SHARE:
            continue
        gap = (p - q) / np.sqrt(max(1e-12, p * (1 - p) / n1 + q * (1 - q) / n0))
        if np.log(p / q) >= 2.0 and gap >= 2.5:
            entries.append((float(np.log(p / q)), key))
    entries.sort(key=lambda e: (-e[0] * np.sqrt(toxic[e[1]]), e[1]))
    words = {k[:-1]: w for w, k in entries[:most] if k.endswith(WHOLE)}
    pairs = {k: w for w, k in entries[:most] if BETWEEN in k}
    beginnings = {k: w for w, k in entries[:most] if not k.endswith(WHOLE) and k not in pairs}
    for name in [*beginnings]:  # one word makes the beginning telling: the word is enough
        if any(w.startswith(name) and toxic[w + WHOLE] >= 0.8 * toxic[name] for w in words):
            del beginnings[name]
    # a longer beginning adds nothing to a shorter one that is already as telling
    for name in sorted(beginnings, key=len, reverse=True):
        if any(beginnings.get(name[:n], -1.0) >= 0.8 * beginnings[name] for n in BEGINNINGS if n < len(name)):
            del beginnings[name]
    alone = Grammar(words, beginnings)
    pairs = {k: w for k, w in pairs.items() if all(alone.word(h)[0] != LEARNED for h in k.split(BETWEEN))}
    return words, beginnings, pairs


def fit_logistic(x: np.ndarray, y: np.ndarray, sample_weight: np.ndarray, penalty: float = 0.02) -> np.ndarray:
    """Projected Newton steps with a ridge on scaled features: weights below 0 become 0,
    and those at 0 that the gradient would push below it rest; each step is halved until
    the loss falls, so separable data converge too.  The last weight is the constant,
    of any sign."""
    scale = x.std(0) + 1e-9
    x = np.hstack([x / scale, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.append(np.full(x.shape[1] - 1, penalty), 1e-6)
    least = np.append(np.zeros(x.shape[1] - 1), -np.inf)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(sample_weight @ (np.logaddexp(0, z) - y * z) + 0.5 * ridge @ w**2)

    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        uphill = x.T @ (sample_weight * (y - p)) - ridge * w
        free = (w > least) | (uphill > 0)
        h = (x[:, free] * (sample_weight * p * (1 - p))[:, None]).T @ x[:, free] + np.diag(ridge[free] + 1e-9)
        step = np.zeros(len(w))
        step[free] = np.linalg.solve(h, uphill[free])
        for _ in range(40):
            if (following := loss(ahead := np.maximum(least, w + step))) <= now:
                break
            step /= 2
        else:
            break
        w, gain, now = ahead, now - following, following
        if gain < 1e-9 * max(1.0, now):
            break
    return np.append(w[:-1] / scale, w[-1])


def fit(texts: list[str], labels: list[int], prior: float | None = None, most: int = LEXICON) -> Grammar:
    """The lexicon from two thirds of the texts, the weights from the others.

    prior: the share of toxic texts to expect, where the sample's differs.
    """
    texts, labels = unique_texts(texts, labels)
    if len(set(labels)) < 2:
        g = Grammar()
        g.weights[-1] = 4.0 if labels and labels[0] else -4.0
        return g
    part = np.array([sum(t.encode()[:64]) % 3 for t in texts])
    split = [([t for t, p in zip(texts, part, strict=True) if (p == 0) == own], [y for y, p in zip(labels, part, strict=True) if (p == 0) == own]) for own in (False, True)]
    (lt, ly), (wt, wy) = split if len(set(split[0][1])) == 2 and len(set(split[1][1])) == 2 else [(texts, labels)] * 2
    grammar = Grammar(*learn_lexicon(lt, ly, most))
    x = np.concatenate([grammar.slice_features(pa.array(wt[a:b], pa.string())) for a, b in slices(map(len, wt), 2_000_000)])
    y = np.array(wy, float)
    prior = max(0.01, min(0.99, prior if prior else float(y.mean())))
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    grammar.weights = fit_logistic(x, y, weight)
    return grammar


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", folds: int = 5, held_out: int = 0, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Grammar:
    """Fitted on a bounded sample of the labels outside the held-out fold."""
    grammar = fit(*labelled_sample(docs, labels, label_col, folds=folds, held_out=held_out, most=most, text_col=text_col, id_col=id_col))
    released()
    return grammar


def score_toxicity(docs: DataFrame, grammar: Grammar, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score double (0 to 1)."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(grammar)  # bounded by LEXICON

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                yield pa.RecordBatch.from_arrays([ids, pa.array(shared.value.score_slice(texts.fill_null("")), pa.float64())], [id_col, "score"])

    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(tidy(run), f"`{id_col}` {kind}, score double")


def keep_clean(docs: DataFrame, grammar: Grammar, *, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs that score below the threshold, all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            done = 0
            for rows, texts in text_slices(pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows), batch.column(at).cast(pa.string())], ["", "t"])):
                scores = shared.value.score_slice(texts.fill_null(""))
                yield batch.slice(done, len(rows)).filter(pa.array(scores < threshold))
                done += len(rows)

    return docs.mapInArrow(tidy(run), docs.schema)
