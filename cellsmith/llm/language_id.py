"""Hierarchical language identification: family first, then the language within it.

A text's features are the shares of its hashed byte trigrams (lower-cased A-Z,
a space before and after). From a bounded sample of labelled documents (at most
``PER_LANGUAGE`` a language, the smallest hashes of their ids) the driver learns
the families by joining the languages whose mean profiles are most alike, one
linear support vector machine for each pair of families, and one for each pair
of languages of a family. A text goes to the family that wins the most of its
duels, then to the language of that family that does; ties go to the larger sum
of margins.

Defined cases: texts that are null or without a letter are ``und`` with score 0,
and so is all without labelled documents; with one learned language every other
text gets it; rows that repeat an id are predicted alike; an empty table gives an
empty result; columns besides id, text and label are not looked at, and the
label only in training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellsmith.llm.common import LOWER, crc_mod, cut, texts_of

DIM = 4096
PER_LANGUAGE = 400
_SLICE = 1 << 20


def trigrams(buf: np.ndarray) -> np.ndarray:
    """Feature number of each byte trigram."""
    x = LOWER[buf].astype(np.uint32)
    h = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    return ((h * np.uint32(0x27D4EB2F)) >> np.uint32(20)).astype(np.int64)


def means(array: pa.Array, table: np.ndarray) -> np.ndarray:
    """Mean of the table's rows over the trigrams of each text (of three bytes at least)."""
    buf, off = texts_of(array)
    out = np.zeros((len(off) - 1, table.shape[1]))
    for i, (a, b) in enumerate(zip(off[:-1], off[1:], strict=True)):
        for s in range(a, b - 2, _SLICE):
            out[i] += table[trigrams(buf[s:min(s + _SLICE + 2, b)])].sum(0, dtype=np.float64)
    return out / np.maximum(np.diff(off) - 2, 1)[:, None]


def profile(array: pa.Array) -> np.ndarray:
    buf, off = texts_of(array)
    out = np.zeros((len(off) - 1, DIM), np.float32)
    for i, (a, b) in enumerate(zip(off[:-1], off[1:], strict=True)):
        for s in range(a, b - 2, _SLICE):
            out[i] += np.bincount(trigrams(buf[s:min(s + _SLICE + 2, b)]), minlength=DIM)
    return out / np.maximum(np.diff(off) - 2, 1)[:, None].astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights of a linear support vector machine by dual coordinate descent; the last one is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    q, alpha, w = (x * x).sum(1), np.zeros(len(x)), np.zeros(x.shape[1])
    rng = np.random.default_rng(5)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * (x[i] @ w) - 1) / q[i], 0.0), c)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


@dataclass
class Model:
    languages: list[str]
    families: list[list[int]]
    duels: list[tuple[str, int, int]]  # ("family" or "language", winner if positive, else)
    table: np.ndarray  # DIM x duels
    bias: np.ndarray


def families_of(mean: np.ndarray) -> list[list[int]]:
    """Average linkage of the languages' mean profiles (root shares) down to about sqrt(n) families."""
    groups = [[i] for i in range(len(mean))]
    root = np.sqrt(mean)
    like = root @ root.T
    while len(groups) > max(2, round(len(mean) ** 0.5)):
        _, a, b = max((like[np.ix_(g, h)].mean(), -i, -j) for (i, g), (j, h) in combinations(enumerate(groups), 2))
        groups[-a] = sorted(groups[-a] + groups.pop(-b))
    return groups


def learn(labels: list[str], x: np.ndarray) -> Model:
    languages = sorted(set(labels))
    y = np.array([languages.index(v) for v in labels])
    families = families_of(np.stack([x[y == i].mean(0) for i in range(len(languages))]))
    scale = 1 / max(float(np.sqrt((x * x).sum(1)).mean()), 1e-9)
    duels = [("family", a, b) for a, b in combinations(range(len(families)), 2)]
    duels += [("language", a, b) for f in families for a, b in combinations(f, 2)]
    table, bias = np.zeros((DIM, len(duels)), np.float32), np.zeros(len(duels))
    for k, (kind, a, b) in enumerate(duels):
        one, two = (families[a], families[b]) if kind == "family" else ([a], [b])
        rows = np.isin(y, one + two)
        w = svm(x[rows].astype(np.float64) * scale, np.where(np.isin(y[rows], one), 1.0, -1.0))
        table[:, k], bias[k] = w[:-1] * scale, w[-1]
    return Model(languages, families, duels, table, bias)


def _winner(margin: np.ndarray, duels: list[tuple[int, int, int]], sides: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Row by row: the side with the most won duels, and the least of its duels' logistic margins."""
    votes, sums, least = (np.zeros((len(margin), len(sides))) for _ in range(3))
    least += 1.0
    for k, a, b in duels:
        m = margin[:, k]
        for side, v in ((sides.index(a), m), (sides.index(b), -m)):
            votes[:, side] += v > 0
            sums[:, side] += v
            least[:, side] = np.minimum(least[:, side], 1 / (1 + np.exp(-np.clip(4 * v, -50, 50))))
    best = np.argmax(votes + 0.5 * np.tanh(sums) / (1 + len(sides)), 1)
    return np.array(sides)[best], least[np.arange(len(margin)), best]


def predict(model: Model, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language number and score of each text."""
    margin = means(array, model.table) + model.bias
    by = lambda kind, of: [(k, a, b) for k, (n, a, b) in enumerate(model.duels) if n == kind and a in of and b in of]
    family, sure = _winner(margin, by("family", range(len(model.families))), list(range(len(model.families))))
    out, score = np.zeros(len(margin), np.int64), sure.copy()
    for f, members in enumerate(model.families):
        rows = family == f
        if rows.any():
            out[rows], own = _winner(margin[rows], by("language", members), members)
            score[rows] *= own
    return out, score


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = profile(b["text"])
        yield pa.RecordBatch.from_arrays([b["label"], pa.array([v.tobytes() for v in x], pa.binary())], ["label", "x"])


def trained(docs: DataFrame, *, folds: int, id_col: str, text_col: str, label_col: str) -> Model | None:
    """Fitted on the sample; None without labelled documents of the training folds."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("label"))
    d = d.where((crc_mod(F.col("id"), folds) != 0) & F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # ids and labels alone are counted; only about twice the sample's rows are ranked
    counts = cut(d.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "languages")
    u = F.shiftrightunsigned(F.xxhash64(F.lit(3), "id"), 1) / F.lit(float(1 << 63))
    few = d.withColumn("u", u).join(counts, "label") \
        .where(F.col("u") * F.col("n") < 2 * PER_LANGUAGE + 20)
    rank = F.row_number().over(Window.partitionBy("label").orderBy("u", "text"))
    sample = few.withColumn("k", rank).where(F.col("k") <= PER_LANGUAGE)
    rows = sample.select("label", F.concat(F.lit(" "), "text", F.lit(" ")).alias("text")) \
        .mapInArrow(_profiles, "label string, x binary").toArrow()
    if not rows.num_rows:
        return None
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(-1, DIM)
    labels = rows["label"].to_pylist()
    order = sorted(range(len(labels)), key=lambda i: (labels[i], x[i].tobytes()))
    return learn([labels[i] for i in order], x[order])


def languages(docs: DataFrame, *, folds: int = 5, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out (crc32 of the id modulo ``folds`` is 0), lang_pred, score."""
    model = trained(docs, folds=folds, id_col=id_col, text_col=text_col, label_col=label_col)
    d = docs.select(F.col(id_col).alias("doc_id"), (crc_mod(F.col(id_col), folds) == 0).alias("held_out"),
                    F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
                    F.concat(F.lit(" "), F.coalesce(F.col(text_col), F.lit("")), F.lit(" ")).alias("text"))
    if model is None:
        return d.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, "und"], object)
        for b in batches:
            k, score = predict(m, b["text"])
            known = b["lettered"].to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["held_out"], pa.array(names[np.where(known, k, len(m.languages))], pa.string()),
                 pa.array(np.where(known, score, 0.0))], ["doc_id", "held_out", "lang_pred", "score"])

    schema = d.select("doc_id", "held_out", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return d.mapInArrow(run, schema)
