"""Language-model scores from a log-frequency Bloom filter.

Training tokens are the lower-cased (A-Z) words of the training documents and an
end after each document. Every word's and word pair's count c is quantised to a
level 1 + floor(log c / log STEP), and (n-gram, 1), ..., (n-gram, level) are put into a
Bloom filter. A reader probes levels upwards until one is missing; the last one
found stands for the mean count of its level in the corpus. The filter is made
of segments by n-gram hash, each built by one task with ``BITS`` bits an entry,
so its size follows the corpus. It is broadcast in parts of at most
``part_bytes``; with more than one part the texts are probed once a part, and
the levels found travel with them.

Smoothing: with P1(w) = (c(w) + 1) / (N + V + 1), c(.) from the filter,
P(w | v) = MIX * (c(v, w) + PRIOR * P1(w)) / (c(v) + PRIOR) + (1 - MIX) * P1(w).
A document's first word follows an end.

``base_score`` is exact: words of at least N / FREQUENT occurrences (at most
FREQUENT of them) are broadcast, all others are joined with the counts.

Defined cases: a null text is empty and scores its end alone; rows that repeat
an id are scored each; a null id counts as empty text for the split; without
training documents N = V = 0 and every probability is 1; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import crc_mod, cut, hashed_words, mix64, partitions, stream64

BITS, PROBES = 8, 4
STEP = 1.5
MIX, PRIOR = 0.4, 15.0
FREQUENT = 1 << 20
PART_BYTES = 256 << 20
LEVELS = 64  # counts up to STEP ** 63
_SLICE = 1000
_U = np.uint64
_END = _U(0x9D39247E33776D41)
_PAIR, _ONE = stream64(2, 21) | _U(1)
_KEY = _U((1 << 40) - 1)
_COUNT = {1: "<u8", 2: "<u4"}


def tokens(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes, an end after each text, and n + 1 offsets."""
    h, first, _, _ = hashed_words(array)
    return np.insert(h, first[1:], _END), first + np.arange(len(first))


def pairs(tok: np.ndarray) -> np.ndarray:
    """Hash of every token with the one before it; a text's first token follows an end."""
    before = np.concatenate([[_END], tok[:-1]]).astype(np.uint64)
    return mix64(before * _PAIR + tok)


def singles(tok: np.ndarray) -> np.ndarray:
    return mix64(tok ^ _ONE)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h, n = np.unique(tokens(b["text"])[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "c"])


def _packed(x: np.ndarray, n: np.ndarray, segments: int, kind: int) -> pa.RecordBatch:
    """Sorted n-gram hashes with counts as a row for each segment: 40 bits and a count each.
    Words' counts are of the corpus and have 64 bits, pairs' of some texts and have 32."""
    seg = ((x >> _U(40)) % _U(segments)).astype(np.int64)
    order = np.argsort(seg, kind="stable")
    x, n, seg = x[order], n[order], seg[order]
    low = (x & _KEY).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    num = n.astype(_COUNT[kind])
    ids, at = np.unique(seg, return_index=True)
    ends = np.append(at[1:], len(seg))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int32()), pa.array(np.full(len(ids), kind), pa.int32()),
         pa.array([low[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary()),
         pa.array([num[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary())],
        ["seg", "kind", "ids", "counts"])


def _pair_rows(segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 2 * _SLICE):
                tok, _ = tokens(b["text"].slice(k, 2 * _SLICE))
                yield _packed(*np.unique(pairs(tok), return_counts=True), segments, 2)

    return run


def _single_rows(segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = singles(b["h"].to_numpy().view(np.uint64))
                yield _packed(x, b["c"].to_numpy(), segments, 1)

    return run


def level(c: np.ndarray) -> np.ndarray:
    """Quantised count, 1 for a count of 1."""
    return 1 + np.floor(np.log(c) / np.log(STEP) + 1e-9).astype(np.int64)


def _places(key: np.ndarray, rung: int, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """The bit numbers of (n-gram, level ``rung``), one array a probe."""
    x = mix64(key + _U(rung * 0x9E3779B97F4A7C15 % (1 << 64)))
    y = mix64(x) | _U(1)
    for i in range(PROBES):
        yield (x + _U(i) * y) % bits


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One filter segment from all rows of the segment, with the counts' sums by level."""
    parts: dict[tuple[int, int], list[tuple[bytes, bytes]]] = {}
    for b in batches:
        for seg, kind, ids, counts in zip(*(b[c].to_pylist() for c in ("seg", "kind", "ids", "counts")), strict=True):
            parts.setdefault((seg, kind), []).append((ids, counts))
    for seg in sorted({s for s, _ in parts}):
        keys, levels, n, total = [], [], np.zeros((2, LEVELS)), np.zeros((2, LEVELS))
        for kind in (1, 2):
            rows = parts.pop((seg, kind), [])
            if not rows:
                continue
            raw = np.frombuffer(b"".join(r[0] for r in rows), np.uint8).reshape(-1, 5)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :5] = raw
            x, back = np.unique(wide.view("<u8").ravel(), return_inverse=True)
            c = np.bincount(back, np.frombuffer(b"".join(r[1] for r in rows), _COUNT[kind]))
            lv = level(c)
            n[kind - 1] += np.bincount(lv, minlength=LEVELS)
            total[kind - 1] += np.bincount(lv, c, minlength=LEVELS)
            keys.append(x)
            levels.append(lv)
        x, lv = np.concatenate(keys), np.concatenate(levels)
        bits = -(-max(int(lv.sum()) * BITS, 64) // 8) * 8
        on = np.zeros(bits, bool)
        for j in range(1, int(lv.max()) + 1):
            for p in _places(x[lv >= j], j, _U(bits)):
                on[p] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array([seg], pa.int32()), pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary()),
             pa.array([n.ravel().tolist()]), pa.array([total.ravel().tolist()])], ["seg", "bits", "n", "total"])


class Filter:
    """Some segments of the filter, as numpy arrays."""

    def __init__(self, segments: int, rows: list[tuple[int, bytes]]):
        self.segments = segments
        self.size = np.zeros(segments, np.uint64)
        self.start = np.zeros(segments, np.int64)
        at = 0
        for seg, bits in rows:
            self.size[seg], self.start[seg] = len(bits) * 8, at
            at += len(bits)
        self.bytes = np.frombuffer(b"".join(bits for _, bits in rows), np.uint8)

    def levels(self, x: np.ndarray) -> np.ndarray:
        """Level of each n-gram hash; 0 where it, or its segment here, is missing."""
        x, back = np.unique(x, return_inverse=True)
        seg = ((x >> _U(40)) % _U(self.segments)).astype(np.int64)
        key, out = x & _KEY, np.zeros(len(x), np.uint8)
        live = np.flatnonzero(self.size[seg] > 0)
        for j in range(1, LEVELS):
            k, size, start = key[live], self.size[seg[live]], self.start[seg[live]]
            hit = np.ones(len(live), bool)
            for p in _places(k, j, size):
                hit &= (self.bytes[start + (p >> _U(3)).astype(np.int64)] >> (p & _U(7)).astype(np.uint8)) & 1 == 1
            live = live[hit]
            if not len(live):
                break
            out[live] = j
        return out[back]


def log_probabilities(one: np.ndarray, two: np.ndarray, before: np.ndarray, n: float, v: float) -> np.ndarray:
    """log10 P(w | v) from the counts of the word, of the pair and of the word before."""
    p1 = (one + 1) / (n + v + 1)
    return np.log10(MIX * (two + PRIOR * p1) / (before + PRIOR) + (1 - MIX) * p1)


def _scored(filters, frequent, mean: np.ndarray, n: int, v: int, last: bool):
    """Probe the part's levels and, with the last part, score; else hand the levels on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, (known, count) = filters.value, frequent.value
        task, row = TaskContext.get().partitionId(), 0
        for whole in batches:
            for k in range(0, whole.num_rows, _SLICE):
                b = whole.slice(k, _SLICE)
                tok, at = tokens(b["text"])
                one, two = part.levels(singles(tok)), part.levels(pairs(tok))
                if b["levels"].null_count < b.num_rows:
                    old = np.frombuffer(b"".join(b["levels"].to_pylist()), np.uint8).reshape(-1, 2)
                    one, two = np.maximum(one, old[:, 0]), np.maximum(two, old[:, 1])
                if not last:
                    lv = np.stack([one, two], 1)
                    yield pa.RecordBatch.from_arrays(
                        [b["doc_id"], b["held_out"], b["text"],
                         pa.array([lv[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())],
                        ["doc_id", "held_out", "text", "levels"])
                    continue
                c1 = mean[0][one]
                ends = mean[0][part_end(one, tok)]
                before = np.concatenate([[ends], c1[:-1]])
                logs = log_probabilities(c1, mean[1][two], before, n, v)
                score = np.add.reduceat(logs, at[:-1])
                i = np.minimum(np.searchsorted(known, tok), max(len(known) - 1, 0))
                hit = known[i] == tok if len(known) else np.zeros(len(tok), bool)
                base = np.add.reduceat(np.where(hit, np.log10(np.where(hit, count[i] if len(known) else 0, 0) + 1.0), 0.0), at[:-1])
                rare, where = tok[~hit].view(np.int64), np.concatenate([[0], np.cumsum(~hit)])[at]
                size = np.diff(at)
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"], b["held_out"], pa.array((task << 33) + row + np.arange(b.num_rows)),
                     pa.array(size), pa.array(np.add.reduceat(hit.astype(np.int64), at[:-1])), pa.array(base),
                     pa.array(score), pa.ListArray.from_arrays(pa.array(where, pa.int32()), pa.array(rare))],
                    ["doc_id", "held_out", "rid", "n_tokens", "n_frequent", "base", "score", "rare"])
                row += b.num_rows

    return run


def part_end(levels: np.ndarray, tok: np.ndarray) -> int:
    """The end token's level: every text has one."""
    return int(levels[np.flatnonzero(tok == _END)[0]])


_DOC = "doc_id long, held_out boolean, "


def lm_scores(docs: DataFrame, *, folds: int = 7, held_fold: int = 2, id_col: str = "doc_id",
              text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Training documents are those whose crc32 of the id modulo ``folds`` is not ``held_fold``.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                    (crc_mod(F.col(id_col), folds) == held_fold).alias("held_out"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    train = d.where(~F.col("held_out")).select("text")
    words = cut(train.mapInArrow(_counted, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "words")
    s = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = s["n"] or 0, s["v"]
    top = words.where(F.col("c") * FREQUENT >= n).toArrow()  # at most FREQUENT rows, whatever the corpus
    known, count = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy()
    order = np.argsort(known)

    segments = 4 * partitions(spark)
    layout = "seg int, kind int, ids binary, counts binary"
    rows = train.mapInArrow(_pair_rows(segments), layout).unionByName(words.mapInArrow(_single_rows(segments), layout))
    built = cut(rows.repartition(partitions(spark), "seg").mapInArrow(
        _build, "seg int, bits binary, n array<double>, total array<double>"), "filter")
    sums = built.select(*[F.posexplode(F.arrays_zip("n", "total"))]).select("pos", "col.*") \
        .groupBy("pos").agg(F.sum("n").alias("n"), F.sum("total").alias("t")).collect()  # 2 * LEVELS rows
    mean = np.zeros((2, LEVELS))
    for r in sums:
        mean[r["pos"] // LEVELS, r["pos"] % LEVELS] = r["t"] / r["n"] if r["n"] else 0.0

    frequent = spark.sparkContext.broadcast((known[order], count[order]))
    d = d.withColumn("levels", F.lit(None).cast("binary"))
    plan = _parts([(r["seg"], r["size"]) for r in built.select("seg", F.length("bits").alias("size")).collect()],
                  part_bytes)
    for i, segs in enumerate(plan):
        got = built.where(F.col("seg").isin(segs)).select("seg", "bits").toArrow() if segs else None
        rows = sorted(zip(got["seg"].to_pylist(), got["bits"].to_pylist(), strict=True)) if segs else []
        part = spark.sparkContext.broadcast(Filter(segments, rows))
        last = i == len(plan) - 1
        run = _scored(part, frequent, mean, n, v, last)
        if last:
            d = d.mapInArrow(run, _DOC + "rid long, n_tokens long, n_frequent long, base double, score double, "
                                         "rare array<long>")
        else:
            d = d.mapInArrow(run, _DOC + "text string, levels binary")
        d = cut(d, f"scored{i}")
    rare = d.select("rid", F.explode("rare").alias("h")).join(words, "h").groupBy("rid").agg(
        F.sum(F.log10(F.col("c") + 1)).alias("log"), F.count(F.lit(1)).alias("k"))
    norm = float(np.log10(n + v + 1))
    logs = F.col("base") + F.coalesce("log", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)
    return d.join(rare, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_frequent") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), logs.alias("base_score"), "score")


def _parts(sizes: list[tuple[int, int]], limit: int) -> list[list[int]]:
    """Segments (their numbers and bytes, a bounded list) in runs of at most ``limit`` bytes."""
    out, room = [[]], limit
    for seg, size in sorted(sizes):
        if out[-1] and size > room:
            out.append([])
            room = limit
        out[-1].append(seg)
        room -= size
    return out
