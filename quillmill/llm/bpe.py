"""Byte-pair encoding of whole texts and decoding through an offset table.

Two encoders share one word splitter:

* :class:`BacktrackingEncoder` (operator 10): an Aho-Corasick pass gives the
  longest vocabulary token at each position; a candidate is kept only if it
  may follow the previous token (a pair-compatibility table, filled lazily),
  otherwise shorter prefixes are tried and the previous token is taken back.
  Each position is marked dead at most once, so the work is linear.
* :class:`LibraryEncoder`: the tokenizers library, called once a batch for the
  words that are not in the cache.

Words never span white space in this vocabulary's pre-tokenizer, so a text's
ids are the concatenation of its white-space-separated pieces' ids.  Pieces
and words are memoised in a dictionary of bounded size; the values are packed
little-endian unsigned 32-bit ids.

Defined results: a null or empty text has no ids and decodes to ''.  Repeated
rows are encoded each on its own.  Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillmill.llm.arrow_text import text_slices, tidy

#: Entries after which the memo is emptied; one takes about 200 bytes.
WORD_MEMO = 300_000
PAIR_MEMO = 200_000

END = "</w>"
_END_SHIFT = 0x2000  # a word's last symbol is moved out of the range of the others

# Below U+0250 nothing composes, and lower() gives one character below U+0250 but for three.
_WIDE = r"[^\x{0}-\x{12f}\x{131}-\x{239}\x{23b}-\x{23d}\x{23f}-\x{24f}]"
# Marks that end a piece are a word of their own; an apostrophe could belong to more.
_LAST_MARKS = r"(\p{L})([^\p{L}\p{N}\s']+) "
_LETTERS = "".join(re.escape(chr(i)) for i in range(0x250) if unicodedata.category(chr(i)).startswith("L"))
_NUMBERS = "".join(re.escape(chr(i)) for i in range(0x250) if unicodedata.category(chr(i)).startswith("N"))
_SPACES = "\\t-\\r \x85\xa0"
_CONTRACTION = "'(?:s|t|re|ve|m|ll|d)"
_NARROW_WORD = re.compile(f"[{_LETTERS}]+|{_CONTRACTION}|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, spare = {}, 256
    for b in range(256):
        table[b] = chr(b) if b in shown else chr(spare)
        spare += b not in shown
    return [table[b] for b in range(256)]


class BacktrackingEncoder:
    """Exact merges of one word without replaying them."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        self.symbols = byte_symbols()
        vocab = {self._inner(t): i for t, i in model["vocab"].items()}
        size = max(vocab.values()) + 1
        self.length = [0] * size
        self.shorter = [-1] * size  # the longest token that is a proper prefix
        self.halves = [(i, i) for i in range(size)]
        self.merged: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in vocab.items():
            self.length[i] = len(t)
            self.automaton.add_word(t, (len(t), i))
            for n in range(len(t) - 1, 0, -1):
                if (p := vocab.get(t[:n])) is not None:
                    self.shorter[i] = p
                    break
        self.automaton.make_automaton()
        last = -1
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            i = vocab[self._inner(a + b)]
            if i <= last:
                raise ValueError("token ids must follow the order of the merges")
            last = i
            self.halves[i] = vocab[self._inner(a)], vocab[self._inner(b)]
            self.merged[self.halves[i]] = i
        self.fits: dict[tuple[int, int], bool] = {}
        self._map = {b: self.symbols[b] for b in range(256)}

    @staticmethod
    def _inner(token: str) -> str:
        """A token with its end mark folded into its last symbol."""
        if token.endswith(END):
            token = token[: -len(END)]
            return token[:-1] + chr(ord(token[-1]) + _END_SHIFT)
        return token

    def _compatible(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border between the two tokens.

        Undo both tokens' merges, the latest first; a crossing merge that would
        have come before the merge undone last breaks the pair.
        """
        bound = 1 << 32
        while True:
            if self.merged.get((left, right), bound) < bound:
                return False
            a, b = self.halves[left][1], self.halves[right][0]
            if left > right and a != left or b == right and a != left:
                bound, left = left, a
            elif b != right:
                bound, right = right + 1, b
            else:
                return True

    def word(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        s = "".join([self._map[b] for b in raw])
        s = s[:-1] + chr(ord(s[-1]) + _END_SHIFT)
        n = len(s)
        longest = [-1] * n
        for end, (size, i) in self.automaton.iter(s):
            longest[end - size + 1] = i  # ends only grow, so the longest stays
        length, shorter, fits = self.length, self.shorter, self.fits
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + length[token]
            if not dead[end]:
                if not out:
                    good = True
                elif (good := fits.get(pair := (out[-1], token))) is None:
                    good = fits[pair] = self._compatible(*pair)
                if good:
                    out.append(token)
                    at = end
                    token = longest[at] if at < n else -1
                    continue
            if shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
        return out

    def words(self, words: list[str]) -> list[list[int]]:
        if len(self.fits) > PAIR_MEMO:
            self.fits.clear()
        return [self.word(w) for w in words]


class LibraryEncoder:
    """The tokenizers library itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for t, i in self.tokenizer.get_vocab().items():
            self.last[i] = t.endswith(END)

    def words(self, words: list[str]) -> list[list[int]]:
        """All words as one text, cut after each token that ends a word; calls cost more than merges."""
        ids = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids if words else []
        ends = (np.flatnonzero(self.last[ids]) + 1).tolist() if ids else []
        if len(ends) != len(words):
            return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class TextEncoder:
    """Packed ids of whole texts.

    Narrow texts (every character below U+0250, where lower() and NFC act on
    each character alone) go through Arrow: lower-case, cut into pieces, give
    each distinct piece of the slice a number, look up only those.  Other
    texts, and texts that may hold a special token, are split in Python.
    """

    def __init__(self, path: str, encoder):
        self.encoder = encoder
        spec = json.load(open(path, encoding="utf-8"))
        self.special = {t["content"]: struct.pack("<I", t["id"]) for t in spec.get("added_tokens", [])}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.special_lead = os.path.commonprefix([*self.special]) if self.special else None
        self.rules = Tokenizer.from_file(path)  # its normalizer and pre-tokenizer cut wide texts: their Unicode tables are its own
        self.byte_of = {c: b for b, c in enumerate(byte_symbols())}
        self.memo: dict[str, bytes] = {"": b""}

    def _learn(self, pieces: set[str]) -> None:
        """Puts each piece that is new, and its words, into the memo."""
        memo = self.memo
        found = {p: _NARROW_WORD.findall(p) for p in pieces if p not in memo}
        words = [*{w for f in found.values() for w in f if w not in memo}]
        self._learn_words(words)
        for p, f in found.items():
            if len(f) != 1 or f[0] != p:
                memo[p] = b"".join([memo[w] for w in f])

    def _learn_words(self, words: list[str]) -> None:
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            for w, ids in zip(part, self.encoder.words(part), strict=True):
                self.memo[w] = struct.pack(f"<{len(ids)}I", *ids)

    def _wide(self, text: str) -> bytes:
        """One text of any characters, special tokens included."""
        parts = [text]
        if self.special_lead is not None and self.special_lead in text:
            parts = self.special_split.split(text)
        out = []
        for p in parts:
            if p in self.special:
                out.append(self.special[p])
                continue
            words = [bytes(map(self.byte_of.__getitem__, w)).decode() for w, _ in self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(p))] if p else []
            self._learn_words([*{w for w in words if w not in self.memo}])
            out += map(self.memo.__getitem__, words)
        return b"".join(out)

    def _narrow(self, texts: pa.Array) -> list[bytes]:
        low = pc.replace_substring(pc.utf8_lower(texts), "\n", " ")
        split = pc.split_pattern(pc.replace_substring_regex(low, _LAST_MARKS, r"\1 \2 "), " ")
        ends = np.asarray(split.offsets)
        coded = split.values.dictionary_encode()
        names = coded.dictionary.to_pylist()
        self._learn({n for n in names if n not in self.memo})
        ids = [self.memo[n] for n in names]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = np.cumsum(size) - size
        source = np.frombuffer(b"".join(ids), "<u4")
        index = np.asarray(coded.indices)
        each = size[index]
        until = np.cumsum(each)
        take = np.repeat(start[index] - (until - each), each)
        take += np.arange(len(take))
        flat = source[take].tobytes()
        bounds = np.concatenate([[0], until])[ends] * 4
        return [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def forget(self) -> None:
        """Drops the words that are remembered; a worker's next task may be of another kind."""
        self.memo = {"": b""}

    def encode(self, texts: pa.Array) -> list[bytes]:
        if len(self.memo) > WORD_MEMO:
            self.forget()
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, _WIDE)
        if self.special_lead is not None:
            odd = pc.or_(odd, pc.match_substring(texts, self.special_lead))
        if not pc.any(odd).as_py():
            return self._narrow(texts)
        plain = iter(self._narrow(texts.filter(pc.invert(odd))))
        return [self._wide(t.as_py()) if o else next(plain) for t, o in zip(texts, odd.to_pylist(), strict=True)]


class OffsetDecoder:
    """Decoding as the library does without a decoder: token strings joined by blanks."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        table = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max(table.values()) + 1
        texts = [b""] * size
        for t, i in table.items():
            texts[i] = t.encode("utf-8") + b" "
        self.starts = np.zeros(size + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=self.starts[1:])
        self.blob = np.frombuffer(b"".join(texts), np.uint8)

    def decode(self, packed: list[bytes]) -> list[bytes]:
        ids = np.frombuffer(b"".join(packed), "<u4")
        if not len(ids):
            return [b""] * len(packed)
        begin = self.starts[ids]
        size = self.starts[ids.astype(np.int64) + 1] - begin
        ends = np.cumsum(size)
        # 32-bit places: a slice of texts decodes to far less than 2 GB
        source = np.repeat((begin - (ends - size)).astype(np.int32), size)
        source += np.arange(ends[-1], dtype=np.int32)
        flat = self.blob[source].tobytes()
        out, at, done = [], 0, 0
        for p in packed:
            at += len(p) // 4
            stop = int(ends[at - 1]) if at else 0
            out.append(flat[done : max(done, stop - 1)])  # without the last blank
            done = stop
        return out


ENCODERS = {"backtracking": BacktrackingEncoder, "library": LibraryEncoder}


def found(path: str) -> str:
    """The vocabulary file on this machine: where the path says, else where the tokenizers are installed here."""
    return path if os.path.exists(path) else public_tokenizers.path(os.path.basename(path))


@lru_cache(maxsize=4)
def text_encoder(path: str, kind: str) -> TextEncoder:
    return TextEncoder(found(path), ENCODERS[kind](found(path)))


@lru_cache(maxsize=4)
def offset_decoder(path: str) -> OffsetDecoder:
    return OffsetDecoder(found(path))


def encode_documents(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids and their decoding.

    Returns id_col, n_tokens long, ids binary (little-endian unsigned 32-bit),
    decoded string.  No shuffle; the memory of a task is bounded by a slice of
    the texts and the memos.  Null and empty texts: 0 ids, decoded ''.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = text_encoder(path, "backtracking"), offset_decoder(path)
        for batch in batches:
            for ids, texts in text_slices(batch):
                packed = encoder.encode(texts)
                decoded = pa.array(decoder.decode(packed), pa.binary()).cast(pa.string())
                counts = pa.array([len(p) // 4 for p in packed], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, counts, pa.array(packed, pa.binary()), decoded], [id_col, "n_tokens", "ids", "decoded"])

    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(tidy(run), f"`{id_col}` {kind}, n_tokens bigint, ids binary, decoded string")
