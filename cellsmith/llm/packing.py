"""Lexical retrieval packing of documents into token windows.

A document's whole windows are cut off from its front and are sequences of their
own; its tail (fewer tokens than a window) is packed with others. Tails are
sorted by a min hash of their words, so that alike tails come together, and every
task goes through its stretch in shards of ``SHARD`` tails. A shard has a BM25
inverted index (document frequencies and mean length of all tails of the corpus).
The first unused tail of a shard is the seed of a window; the index returns all its
unused neighbours in the shard, scored by all its words, best first, and the window takes those that fit whole, then
the front of the best one left, so that it is full; the rest of that one stays
unused. Where no neighbour shares a word, the next unused tail follows. What a
shard leaves in a window that is not full goes on to the next shard; so a task
pads one sequence at most.

The index numbers words by a hash of ``BUCKETS`` values; that table of document
frequencies is broadcast, and its size is fixed.

Defined cases: null and empty texts are the end token alone; rows that repeat an
id are packed each; null ids are kept; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import cut, mix64, partitions, stream64

WINDOW, END = 2048, 1
SHARD = 4096
QUERY_TERMS = None  # a seed's query has all its words
BUCKETS = 1 << 18
K1, B = 1.2, 0.75
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
_MEMO = 1_000_000
_SLICE = 1 << 22  # characters of texts that are split and gathered at a time
_BLOCK = 64  # tails whose words are hashed at a time
_U = np.uint64


def _objects(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()  # many times as fast as to_pylist


class Encoder:
    """Token ids by the tokenizer file, remembering the words it has seen.

    Between plain words the tokenizer always splits before a single blank or at a
    single line break, so such texts are split in Arrow, every distinct word is
    encoded once, and the texts are put together from the words' ids; a text with
    other white space or a special token's string is encoded whole.
    """

    _odd = ["  ", "\n\n", " \n", "\n ", "<|", *map(chr, (
        9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
        0x3000))]
    _signs = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.blank = np.array([n[:1] in ("Ġ", "Ċ") for n in self.names])
        self.line_break = len(self.whole("\n")) // 2
        self.stems: dict[str, bytes] = {}  # with the blank before it, or the line break that it begins with
        self.tails: dict[str, bytes] = {}  # runs of signs after a letter

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def plain(self, text: str) -> bool:
        return bool(text) and not (text[0].isspace() or text[-1].isspace() or any(map(text.__contains__, self._odd)))

    def _stems(self, stems: list[str]) -> list[bytes]:
        """Ids of distinct words; what one call encodes falls apart at the ids with a blank or line break."""
        known = list(map(self.stems.get, stems))
        new = [i for i, ids in enumerate(known) if ids is None]
        for k in range(0, len(new), 2048):
            some = new[k:k + 2048]
            text = (" " + " ".join([stems[i] for i in some])).replace(" \n", "\n")
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")
            raw = ids.tobytes()
            at = (2 * np.flatnonzero(self.blank[ids])).tolist()
            for i, x, y in zip(some, at, [*at[1:], len(raw)], strict=True):
                known[i] = raw[x:y]
        if len(self.stems) + len(new) <= _MEMO:
            self.stems.update((stems[i], known[i]) for i in new)
        return known

    def _words(self, words: pa.LargeStringArray) -> list[bytes]:
        """Ids of distinct words; the tokenizer splits letters from the signs after them."""
        stem = pc.utf8_rtrim(words, self._signs)
        split = pc.and_(pc.match_substring_regex(stem, "[A-Za-z]$"), pc.not_equal(stem, words))
        stem = pc.if_else(split, stem, words).dictionary_encode()
        stems, which = _objects(stem.dictionary), stem.indices.to_numpy()
        known = list(map(self._stems(stems).__getitem__, which.tolist()))
        at = np.flatnonzero(split.to_numpy(zero_copy_only=False))
        for i, k, w in zip(at.tolist(), which[at].tolist(), _objects(words.filter(split)), strict=True):
            signs = w[len(stems[k]):]
            if signs not in self.tails:
                if len(self.tails) >= _MEMO:
                    self.tails.clear()
                self.tails[signs] = self.whole(signs)
            known[i] += self.tails[signs]
        return known

    def _joined(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of plain texts; each has a line break put before it, whose ids are left out again."""
        if not texts:
            return []
        n_words = np.array([t.count(" ") + t.count("\n") + 1 for t in texts])
        text = ("\n" + "\n".join(texts)).replace("\n", " \n")[1:]
        words = pc.split_pattern(pa.array([text], pa.large_string()), " ").flatten().dictionary_encode()
        which, known = words.indices.to_numpy(), self._words(words.dictionary)
        size = np.fromiter(map(len, known), np.int32, len(known)) // 2
        n = size[which]
        end = np.cumsum(n, dtype=np.int32)  # a text of 2 GB has fewer ids
        ids = np.frombuffer(b"".join(known), "<u2")[
            np.arange(end[-1], dtype=np.int32) + np.repeat((np.cumsum(size, dtype=np.int32) - size)[which] - end + n, n)]
        last = end[np.cumsum(n_words) - 1].tolist()
        return [ids[a + self.line_break:b] for a, b in zip([0, *last], last)]

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, "<u2")] * len(texts)
        some, size = [], 0
        for i, text in enumerate(texts):
            if self.plain(text):
                some.append(i)
                size += len(text)
            else:
                out[i] = np.frombuffer(self.whole(text), "<u2")
            if size >= _SLICE or i == len(texts) - 1:
                for k, ids in zip(some, self._joined([texts[k] for k in some]), strict=True):
                    out[k] = ids
                some, size = [], 0
        return out

    def ids(self, text: str) -> bytes:
        return self.batch([text])[0].tobytes()

    def word_starts(self) -> np.ndarray:
        """For each id whether it begins a word: a blank or line break before it, or no letter or digit in it."""
        return np.array([not n or n[0] in "ĠĊ" or not any(c.isalnum() for c in n) for n in self.names] + [True])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_TOKEN = stream64(1 << 16, 31)
_BASE = _U(0x5851F42D4C957F2D)
_POW = np.multiply.accumulate(np.concatenate([[_U(1)], np.full(WINDOW, _BASE)]).astype(np.uint64))


def words_of(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of a tail."""
    return words_of_all([ids], starts)[0]


def words_of_all(tails: list[np.ndarray], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of tails one after another, and where each tail's begin."""
    ids = np.concatenate(tails)
    at = np.cumsum([0, *map(len, tails)])[:-1]
    first = starts[ids]
    first[at] = True
    s = np.flatnonzero(first)
    place = np.arange(len(ids)) - np.repeat(s, np.diff(np.append(s, len(ids))))
    return mix64(np.add.reduceat(_TOKEN[ids] * _POW[place], s)), np.searchsorted(s, at)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _encoded(path: str):
    """Pieces of whole windows, tails with their ids and sort key, and a row a task with the document frequencies
    of its tails' word buckets; bucket -1 has the number of tails, -2 their words."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                        ("offset", pa.int64()), ("key", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        starts = enc.word_starts()
        task, n = TaskContext.get().partitionId(), 0
        df, docs, total = np.zeros(BUCKETS, np.int64), 0, 0
        for b in batches:
            rows, tails = [], []
            for doc, text_ids in zip(b["doc_id"].to_pylist(), enc.batch(b["text"].to_pylist()), strict=True):
                ids = np.append(text_ids, np.uint16(END))
                size = len(ids)
                full = size // WINDOW * WINDOW
                for a in range(0, full, WINDOW):
                    rows.append((doc, a, WINDOW, crc(ids[a:a + WINDOW]), size, 2 * ((task << 33) + n), 0, None, None,
                                 None))
                    n += 1
                if full < size:
                    tails.append((doc, full, size, ids[full:]))
            for k in range(0, len(tails), _BLOCK):
                some = tails[k:k + _BLOCK]
                words, at = words_of_all([t[-1] for t in some], starts)
                keys = np.minimum.reduceat(words, at).view(np.int64).tolist()
                rows += [(doc, full, size - full, None, size, None, None, key, ids.tobytes(), None)
                         for key, (doc, full, size, ids) in zip(keys, some, strict=True)]
                tail = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(words))))
                once = np.sort(tail * BUCKETS + (words % _U(BUCKETS)).astype(np.int64))  # far faster than np.unique
                once = once[np.append(True, once[1:] != once[:-1])]
                np.add.at(df, once % BUCKETS, 1)
                docs, total = docs + len(at), total + len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema) \
                if rows else pa.RecordBatch.from_pylist([], schema=schema)
        i = np.flatnonzero(df)
        counts = np.stack([np.append(i, [-1, -2]), np.append(df[i], [docs, total])])
        yield pa.RecordBatch.from_pylist([{"counts": counts.tobytes()}], schema=schema)

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for raw in b["counts"].to_pylist():
            bucket, n = np.frombuffer(raw, np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(n)], ["bucket", "n"])


class Tail:
    """What is left of a document, and the words it is found by."""

    __slots__ = ("doc", "start", "size", "ids", "terms", "tf", "words")

    def __init__(self, doc: int | None, start: int, size: int, ids: np.ndarray, starts: np.ndarray):
        w = (words_of(ids, starts) % _U(BUCKETS)).astype(np.int64)
        self.doc, self.start, self.size, self.ids, self.words = doc, start, size, ids, len(w)
        self.terms, self.tf = np.unique(w, return_counts=True)


class Index:
    """BM25 inverted index of a shard's tails."""

    def __init__(self, tails: list[Tail], idf: np.ndarray, mean: float):
        term = np.concatenate([t.terms for t in tails])
        doc = np.repeat(np.arange(len(tails)), [len(t.terms) for t in tails])
        tf = np.concatenate([t.tf for t in tails]).astype(np.float64)
        long = np.array([t.words for t in tails])[doc] / max(mean, 1e-9)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * long))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.names, self.at = np.unique(term[order], return_index=True)
        self.end = np.append(self.at[1:], len(term))
        self.n = len(tails)
        # words of more than an eighth of the tails as rows of weights
        often = np.flatnonzero(8 * (self.end - self.at) > self.n)
        self.row = np.full(len(self.names), -1)
        self.row[often] = np.arange(len(often))
        self.rows = np.zeros((len(often), self.n))
        for k, i in enumerate(often.tolist()):
            part = slice(self.at[i], self.end[i])
            self.rows[k, self.doc[part]] = self.weight[part]

    def scores(self, tail: Tail, unused: np.ndarray) -> np.ndarray:
        """Scores of all unused tails by all words of ``tail``; 0 where no word is shared."""
        word = np.searchsorted(self.names, tail.terms)
        row = self.row[word]
        asked = np.zeros(len(self.rows))
        asked[row[row >= 0]] = 1
        lists = list(map(slice, self.at[word[row < 0]].tolist(), self.end[word[row < 0]].tolist()))
        score = asked @ self.rows
        if lists:
            score += np.bincount(np.concatenate([self.doc[i] for i in lists]),
                                 np.concatenate([self.weight[i] for i in lists]), self.n)
        return np.round(score * unused, 9)  # equal scores stay equal in whatever order they are added up

    def neighbours(self, tail: Tail, unused: np.ndarray) -> np.ndarray:
        """All unused tails that share a word with ``tail``, best first."""
        score = self.scores(tail, unused)
        best = np.flatnonzero(score > 0)
        return best[np.argsort(-score[best], kind="stable")]


Piece = tuple[int | None, int, np.ndarray, int]


def pack_shard(tails: list[Tail], idf: np.ndarray, mean: float) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows of (doc, start, ids, doc tokens) pieces, and the pieces of one that is not full."""
    unused, taken = np.ones(len(tails), bool), [0] * len(tails)
    left = np.array([len(t.ids) for t in tails])
    windows: list[list[Piece]] = []
    seed = 0
    here, index = np.empty(0, np.int64), None

    def piece(i: int, room: int) -> Piece:
        t, a = tails[i], taken[i]
        n = min(room, int(left[i]))
        taken[i] += n
        left[i] -= n
        unused[i] = left[i] > 0
        return t.doc, t.start + a, t.ids[a:a + n], t.size

    while True:
        while seed < len(tails) and not unused[seed]:
            seed += 1
        if seed == len(tails):
            return windows, []
        if index is None or 2 * unused[here].sum() < len(here):  # half of its tails are used up
            here = np.flatnonzero(unused)
            index = Index([tails[i] for i in here.tolist()], idf, mean)
        made = [piece(seed, WINDOW)]
        room = WINDOW - len(made[0][2])
        score = index.scores(tails[seed], unused[here]) if room else np.zeros(len(here))
        sizes = left[here]
        while room:  # the best that fits whole: the room only shrinks, so none passed over fits later
            fits = np.where(sizes <= room, score, 0.0)
            best = int(fits.argmax())
            if not fits[best]:
                break
            made.append(piece(int(here[best]), room))
            room -= len(made[-1][2])
            score[best] = 0.0
        if room and score.any():  # the best one left has more than there is room
            made.append(piece(int(here[score.argmax()]), room))
            room -= len(made[-1][2])
        after = seed
        while room and after < len(tails):
            if unused[after]:
                made.append(piece(after, room))
                room -= len(made[-1][2])
            after += 1
        if room:
            return windows, made
        windows.append(made)


def _packed(path: str, shared):
    names = [c.split()[0] for c in _PIECE.split(", ")]

    def rows_of(windows: list[list[Piece]], first: int) -> pa.RecordBatch:
        rows = []
        for k, pieces in enumerate(windows):
            offset = 0
            for doc, start, ids, size in pieces:
                rows.append((doc, start, len(ids), crc(ids), size, 2 * (first + k) + 1, offset))
                offset += len(ids)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = encoder(path).word_starts()
        idf, mean = shared.value
        n = TaskContext.get().partitionId() << 33
        tails: list[Tail] = []

        def shard() -> Iterator[pa.RecordBatch]:
            nonlocal n, tails
            windows, rest = pack_shard(tails, idf, mean)
            tails = [Tail(doc, start, size, ids, starts) for doc, start, ids, size in rest]
            if windows:
                yield rows_of(windows, n)
                n += len(windows)

        for b in batches:
            for doc, start, size, raw in zip(*(b[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True):
                tails.append(Tail(doc, start, size, np.frombuffer(raw, "<u2"), starts))
                if len(tails) >= SHARD:
                    yield from shard()
        if tails:
            yield from shard()
        if tails:
            yield rows_of([[(t.doc, t.start, t.ids, t.size) for t in tails]], n)

    return run


def packed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str = VOCABULARY) -> DataFrame:
    """A row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The texts are encoded once. Only tails are shuffled, as ids of two bytes, by
    one range partitioning whose ranges follow the data's distribution.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    made = cut(d.mapInArrow(_encoded(vocabulary), _PIECE + ", key long, ids binary, counts binary"),
               "encoded")
    tails = made.where("ids is not null").select("doc_id", "start", "doc_tokens", "key", "ids")
    rows = made.where("counts is not null").select("counts").mapInArrow(_frequencies, "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS + 2 rows at most
    stats = dict(zip(rows["bucket"].to_pylist(), rows["n"].to_pylist(), strict=True))
    docs_n, words_n = stats.pop(-1, 0), stats.pop(-2, 0)
    df = np.zeros(BUCKETS)
    df[list(stats)] = list(stats.values())
    idf = np.log(1 + (docs_n - df + 0.5) / (df + 0.5))
    shared = spark.sparkContext.broadcast((idf, words_n / max(docs_n, 1)))
    ordered = tails.repartitionByRange(partitions(spark), "key", "doc_id", "start") \
        .sortWithinPartitions("key", "doc_id", "start")
    names = [c.split()[0] for c in _PIECE.split(", ")]
    return made.where("ids is null and counts is null").select(names).unionByName(ordered.mapInArrow(_packed(vocabulary, shared), _PIECE))
