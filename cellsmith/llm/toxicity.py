"""Toxicity scores of texts restored from obfuscation by a noisy-channel decoder.

Words that look disguised (symbols or digits among letters, a letter three times
in a row, letters set apart) become a lattice: every character can stand for the
letters of ``READINGS``, a repeat of the one before or a separator may vanish, and
at separators and between letters set apart a word may end; other signs end it.
Viterbi search finds the likeliest words under a trigram model of the corpus'
characters (counted over all training documents, 27**3 numbers). The plain words
of a text and its restored ones are then held against a lexicon: words that
labelled toxic documents hold far more often than others, weighted by the
logarithm of the odds. The score is the logistic of the prior and the weights of
the lexicon's words in the text, each counted once.

The lexicon is learned from a bounded sample of labelled documents (at most
``PER_CLASS`` a class, the smallest hashes of their ids), each read whole.

Defined cases: null and empty texts have no word and get the prior's score; a
document with conflicting labels counts as toxic; rows that repeat an id are
scored alike; without labels of the training folds every score is 0; a repeat of one
letter alone is no disguised word; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import LOWER, SPACE, crc_mod, cut, hashed_words, texts_of, word_spans

PER_CLASS = 4000
LEAST_ODDS, LEAST_DOCS = math.log(20), 4
#: The letters that a character of a disguised word may stand for.
READINGS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
            "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "h"}
_SEPARATORS = ".-_*~'`,"
#: Ends a run of letters that were set apart; stands in it for a gap wider than one character.
APART, WIDE = "\0", "\1"
_KEEP, _SWAP, _REPEAT, _DROP = (math.log(p) for p in (0.9, 0.6, 0.4, 0.05))
_MEMO, _MEMO_WORD = 200_000, 64  # words remembered, and their length; longer ones are decoded each time
_REPEATED = re.compile(r"(.)\1{3,}", re.S)
_HARD = re.compile("[^a-z\x80-\U0010ffff" + re.escape("".join(READINGS) + _SEPARATORS) + "]+")

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_NOT_WORD = ~_LETTER
_NOT_WORD[128:] = False  # letters beyond ASCII are more bytes of a word
_LEET = np.zeros(256, bool)
_LEET[[ord(c) for c in READINGS]] = True
_SEP = np.zeros(256, bool)
_SEP[[ord(c) for c in _SEPARATORS]] = True
_CODE = np.zeros(256, np.int64)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)


def trigram_counts(array: pa.Array) -> np.ndarray:
    """Counts of a..z trigrams with 0 for all else, over the texts in a row."""
    buf, _ = texts_of(array)
    out = np.zeros(27 ** 3, np.int64)
    for a in range(0, len(buf), 1 << 20):
        c = _CODE[buf[a:a + (1 << 20) + 2]]
        if len(c) > 2:
            out += np.bincount(c[:-2] * 729 + c[1:-1] * 27 + c[2:], minlength=27 ** 3)
    return out


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), smoothed with the letters' own shares."""
    n = counts.reshape(27, 27, 27).astype(np.float64)
    n[:, 0, 0] = 0  # runs of other characters say nothing about words
    one = (n.sum((0, 1)) + 1) / (n.sum() + 27)
    return np.log((n + 5 * one) / (n.sum(2, keepdims=True) + 5))


class Decoder:
    """Restores disguised words; remembers the words it has seen."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.memo: dict[str, str] = {}

    def restore(self, word: str) -> str:
        got = self.memo.get(word)
        if got is None:
            if word[-1:] == APART:
                got = self._viterbi(" ".join(_REPEATED.sub(r"\1\1\1", word[:-1])))
            else:
                got = " ".join(self._viterbi(_REPEATED.sub(r"\1\1\1", x)) for x in _HARD.split(word) if x)
            if len(self.memo) < _MEMO and len(word) <= _MEMO_WORD:
                self.memo[word] = got
        return got

    def _viterbi(self, word: str) -> str:
        """The likeliest words, blanks between them."""
        states: dict = {(0, 0): (0.0, None)}  # (letters before, 0 for none): score, (rest, letter)
        before = ""
        for c in word:
            arcs = [(ord(x) - 96, _SWAP) for x in READINGS.get(c, "")]
            if "a" <= c <= "z":
                arcs.append((ord(c) - 96, _KEEP))
            skip = _REPEAT if c == before and c != WIDE else None if "a" <= c <= "z" \
                else _DROP if c in READINGS or c == WIDE else 0.0
            ends = c in _SEPARATORS or c in (" ", WIDE)
            if c not in (" ", WIDE):
                before = c
            new: dict = {}
            for (a, b), (p, s) in states.items():
                if ends and not b:  # no letter since the last end
                    if p > new.get((a, b), (-1e300,))[0]:
                        new[a, b] = (p, s)
                elif skip is not None and p + skip > new.get((a, b), (-1e300,))[0]:
                    new[a, b] = (p + skip, s)
                row = self.model[a][b]
                if ends and b:
                    t = p + row[0]
                    if t > new.get((b, 0), (-1e300,))[0]:
                        new[b, 0] = (t, (s, " "))
                for x, q in arcs:
                    t = p + q + row[x]
                    if t > new.get((b, x), (-1e300,))[0]:
                        new[b, x] = (t, (s, chr(96 + x)))
            states = new
        # a word that has ended needs no other end
        _, s = max(((p + (self.model[a][b][0] if b or not a else 0.0), s) for (a, b), (p, s) in states.items()),
                   key=lambda x: x[0])
        out = []
        while s:
            s, c = s
            out.append(c)
        return "".join(reversed(out)).strip()


def disguised(array: pa.Array) -> tuple[np.ndarray, list[str]]:
    """(text number, word) of every word that looks disguised; A-Z lower-cased.

    Found over the batch's bytes: a symbol or digit before or between letters, a
    letter three times, letters with separators, and runs of three or more
    single letters (as one, with ``WIDE`` at wider gaps and ``APART`` behind).
    """
    buf, off = texts_of(array)
    low = LOWER[buf]
    s, e = word_spans(buf, off, SPACE)
    if not len(s):
        return np.zeros(0, np.int64), []
    pad = np.concatenate([low, np.full(4, 32, np.uint8)])
    letter, leet, sep = _LETTER[pad], _LEET[pad], _SEP[pad]
    n = len(low)
    prev = np.concatenate([[False], letter[:n - 1]])
    odd = leet[:n] & (letter[1:n + 1] | (leet[1:n + 1] & (letter[2:n + 2] | leet[2:n + 2] & letter[3:n + 3])))
    begins = np.zeros(n, bool)
    begins[s] = True
    odd &= prev | begins
    odd |= letter[:n] & (pad[:n] == pad[1:n + 1]) & (pad[:n] == pad[2:n + 2])
    odd |= letter[:n] & ~prev & sep[1:n + 1] & letter[2:n + 2] & sep[3:n + 3] & letter[4:n + 4]
    marks = np.concatenate([[0], np.cumsum(odd)])
    letters = np.concatenate([[0], np.cumsum(letter[:n])])
    length = e - s
    hit = (marks[e] > marks[s]) & (letters[e] > letters[s]) & (length >= 3)
    raw = low.tobytes()
    text = np.searchsorted(off, s, "right") - 1
    where, out = [], []
    for t, a, b in zip(text[hit].tolist(), s[hit].tolist(), e[hit].tolist(), strict=True):
        w = raw[a:b].decode("utf-8", "ignore").strip(_SEPARATORS + "\"?:;)")
        if w.strip(w[:1]):  # not one letter alone
            where.append(t)
            out.append(w)
    single = (length <= 2) & (letter[s] | leet[s]) & ((length == 1) | sep[np.minimum(s + 1, n)])
    i = np.flatnonzero(single)
    if len(i):
        runs = np.split(i, np.flatnonzero((np.diff(i) > 1) | (np.diff(text[i]) > 0)) + 1)
        for r in runs:
            if len(r) >= 3:
                gap = np.append(s[r[1:]] - e[r[:-1]], 1)
                where.append(text[r[0]])
                out.append("".join(chr(low[x]) + WIDE * (g > 1) for x, g in zip(s[r], gap.tolist(), strict=True)) + APART)
    return np.array(where, np.int64), out


def word_sets(array: pa.Array, decoder: Decoder) -> tuple[np.ndarray, np.ndarray]:
    """(text number, word hash): the distinct plain and restored words of each text."""
    h, first, _, _ = hashed_words(array, _NOT_WORD)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    where, odd = disguised(array)
    if odd:
        new = [decoder.restore(w) for w in odd]
        # a restored stretch may hold more than one word
        g, at, _, _ = hashed_words(pa.array(new, pa.string()), _NOT_WORD)
        h = np.concatenate([h, g])
        text = np.concatenate([text, np.repeat(where, np.diff(at))])
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return text[new], h[new]


_SLICE = 500


def _chars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(27 ** 3, np.int64)
    for b in batches:
        n += trigram_counts(b["text"])
    i = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(n[i])], ["i", "n"])


def learn(x: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, float]:
    """Lexicon (sorted word hashes), weights and prior log odds from (label, distinct word hashes)."""
    na, nb = sum(y for y, _ in x), sum(1 - y for y, _ in x)
    prior = math.log((na + 0.5) / (nb + 0.5))
    if not na:
        return np.zeros(0, np.uint64), np.zeros(0), prior
    words, a = np.unique(np.concatenate([w for y, w in x if y]), return_counts=True)
    b = np.zeros(len(words))
    for y, w in x:
        if not y:
            b[np.searchsorted(words, np.intersect1d(words, w, assume_unique=True))] += 1
    odds = np.log((a + 0.5) / (na + 1)) - np.log((b + 0.5) / (nb + 1))
    keep = (odds > LEAST_ODDS) & (a >= max(LEAST_DOCS, 0.01 * na))
    return words[keep], odds[keep], prior


def toxicity(docs: DataFrame, labels: DataFrame, *, folds: int = 5, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out (crc32 of the id modulo ``folds`` is 0), score, predicted."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("doc_id"), (crc_mod(F.col(id_col), folds) == 0).alias("held_out"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = d.where(~F.col("held_out")).select("text").mapInArrow(_chars, "i long, n long") \
        .groupBy("i").agg(F.sum("n").alias("n")).collect()  # 27 ** 3 rows at most
    counts = np.zeros(27 ** 3, np.int64)
    for r in rows:
        counts[r["i"]] = r["n"]
    model = log_model(counts)
    lexicon, weights, prior = _learned(d, labels, model, folds, id_col, label_col)
    shared = spark.sparkContext.broadcast((model, lexicon, weights, prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, lexicon, weights, prior = shared.value
        decoder = Decoder(model)
        for whole in batches:
            for k in range(0, whole.num_rows, _SLICE):
                b = whole.slice(k, _SLICE)
                text, h = word_sets(b["text"], decoder)
                odds = np.full(b.num_rows, prior)
                if len(lexicon):
                    i = np.minimum(np.searchsorted(lexicon, h), len(lexicon) - 1)
                    hit = lexicon[i] == h
                    odds += np.bincount(text[hit], weights[i[hit]], minlength=b.num_rows)
                score = np.where(np.isneginf(odds), 0.0, 1 / (1 + np.exp(-np.clip(odds, -500, 500))))
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"], b["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])

    schema = d.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    return d.mapInArrow(run, schema)


def _learned(d: DataFrame, labels: DataFrame, model: np.ndarray, folds: int, id_col: str,
             label_col: str) -> tuple[np.ndarray, np.ndarray, float]:
    known = labels.where((crc_mod(F.col(id_col), folds) != 0) & F.col(id_col).isNotNull()
                         & F.col(label_col).isNotNull())
    known = cut(known.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("y")), "labels")
    share = known.groupBy("y").count().collect()  # two rows
    n = {r["y"]: r["count"] for r in share}
    if not n.get(1):
        return np.zeros(0, np.uint64), np.zeros(0), -math.inf
    u = F.xxhash64(F.lit(9), "doc_id")
    parts = [known.where(F.col("y") == y).orderBy(u, "doc_id").limit(PER_CLASS) for y in (0, 1)]
    sample = cut(parts[0].unionByName(parts[1]), "sample")  # at most 2 * PER_CLASS rows of 12 bytes
    shared = d.sparkSession.sparkContext.broadcast(model)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for b in batches:
            text, h = word_sets(b["text"], decoder)
            at = np.searchsorted(text, np.arange(b.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [b["y"], pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))], ["y", "h"])

    rows = d.join(F.broadcast(sample), "doc_id").select("y", "text").mapInArrow(words, "y int, h array<long>").toArrow()
    x = [(y, np.asarray(h.values, dtype=np.int64).view(np.uint64)) for y, h in zip(rows["y"].to_pylist(), rows["h"], strict=True)]
    lexicon, weights, _ = learn(x)
    return lexicon, weights, math.log((n[1] + 0.5) / (n.get(0, 0) + 0.5))
