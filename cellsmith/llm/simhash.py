"""SimHash document fingerprints and the search for fingerprints within a Hamming radius.

Terms of a text are its words (A-Z lower-cased) and its pairs of adjacent words.
A term weighs 1 + ln(occurrences), a word half of that (common words say little
about a document). Every term's hash votes with its weight on each of the
``BITS`` signed bits; the sign of the sum is the fingerprint's bit. The
fingerprint depends on the text alone, so equal texts have equal fingerprints in
any run. Likeness of two fingerprints is the share of equal bits.

Search: the bits are cut into ``BLOCKS`` blocks. Of two fingerprints that differ
in at most ``RADIUS`` bits, at least ``BLOCKS - RADIUS`` blocks are equal, so a
table for each choice of that many blocks, keyed by those blocks, holds the pair
in some table. A pair is reported in the first such table only.

Defined cases: null and empty texts have no term and the fingerprint of all zero
bits; null ids come first in the order of the documents; rows that repeat an id
follow each other in the order of their texts; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellsmith.llm.common import cut, hashed_words, partitions, windows64

BITS = 64
RADIUS = 3
BLOCKS = 6
_STEP = 1 << 14
_U = np.uint64


def _terms(h: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, n = np.unique(h, return_counts=True)
    pairs, m = np.unique(p, return_counts=True)
    return np.concatenate([words, pairs]), np.concatenate([0.5 + 0.5 * np.log(n), 1 + np.log(m)])


def fingerprints(array: pa.Array) -> np.ndarray:
    """64-bit fingerprints of a batch of texts; memory does not grow with a text's votes."""
    h, first, _, _ = hashed_words(array)
    p, at = windows64(h, first, 2)
    out = np.zeros(len(array), np.uint64)
    shift = np.arange(BITS, dtype=np.uint64)
    for i in range(len(out)):
        if first[i] == first[i + 1]:
            continue
        t, w = _terms(h[first[i]:first[i + 1]], p[at[i]:at[i + 1]])
        votes = np.zeros(BITS)
        for a in range(0, len(t), _STEP):
            bits = np.unpackbits(t[a:a + _STEP].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            part = w[a:a + _STEP].astype(np.float32)
            votes += 2.0 * (part @ bits.astype(np.float32)) - part.sum(dtype=np.float64)
        out[i] = ((votes > 0).astype(np.uint64) << shift).sum(dtype=np.uint64)
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return 1 - np.bitwise_count(x ^ y) / BITS


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of ``following``."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


def _hex(x: np.ndarray) -> list[str]:
    return [f"{v:016x}" for v in x.tolist()]


_OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64())]
_SLICE = 512


def _measured(ids: pa.Array, texts: pa.Array, next_texts: pa.Array) -> list[pa.Array]:
    own = texts.to_pylist()
    new = [edited(a, b) for a, b in zip(own, next_texts.to_pylist(), strict=True)]
    f, g, e = fingerprints(texts), fingerprints(next_texts), fingerprints(pa.array(new, pa.string()))
    return [ids, pa.array([len(t) for t in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
            pa.array(_hex(f)), pa.array(_hex(e)), pa.array(likeness(f, e)), pa.array(likeness(f, g))]


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition, each with the row after it. The partition's
    last row waits for the first row of the next partition: both come out as
    they are (side 1: waits, side 0: first), all others measured."""
    names = [n for n, _ in _OUT] + ["side", "pid", "text"]

    def bare(ids: pa.Array, text: pa.Array, pid: pa.Array, side: int) -> pa.RecordBatch:
        cols = [ids] + [pa.nulls(1, t) for _, t in _OUT[1:]] + [pa.array([side], pa.int32()), pid, text]
        return pa.RecordBatch.from_arrays(cols, names)

    held = None
    for b in batches:
        for k in range(0, b.num_rows, _SLICE):
            t = pa.Table.from_batches([b.slice(k, _SLICE)])
            if held is None:
                r = t.slice(0, 1).combine_chunks().to_batches()[0]
                yield bare(r["doc_id"], r["text"], r["pid"], 0)
            else:
                t = pa.concat_tables([held, t])
            t = t.combine_chunks()
            n = t.num_rows
            held = t.slice(n - 1)
            if n > 1:
                r = t.to_batches()[0]
                cols = _measured(r["doc_id"].slice(0, n - 1), r["text"].slice(0, n - 1), r["text"].slice(1))
                none = [pa.nulls(n - 1, x) for x in (pa.int32(), pa.int32(), pa.string())]
                yield pa.RecordBatch.from_arrays(cols + none, names)
    if held is not None:
        r = held.combine_chunks().to_batches()[0]
        yield bare(r["doc_id"], r["text"], r["pid"], 1)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, _SLICE):
            r = b.slice(k, _SLICE)
            yield pa.RecordBatch.from_arrays(_measured(r["doc_id"], r["text"], r["next_text"]), [n for n, _ in _OUT])


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
          "near_edited double, near_next double"


def fingerprint_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how alike they
    and the next document's are (see ``_SCHEMA``).

    The documents are sorted by id over all machines, one shuffle of the texts;
    a document's successor is then the next row. Only the first and the last
    document of each partition are joined across partitions.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.repartitionByRange(partitions(spark), F.col("doc_id"))
    d = d.sortWithinPartitions("doc_id", "text").withColumn("pid", F.spark_partition_id())
    all_rows = cut(d.mapInArrow(_along, _SCHEMA + ", side int, pid int, text string"), "fingerprints")
    # a row a partition: which partition follows (empty ones are not there), the last one by the first
    ends = all_rows.where("side is not null")
    order = Window.orderBy("pid")
    heads = ends.where("side = 0").select("pid", F.col("text").alias("next_text"))
    ids = heads.select("pid")
    after = ids.select("pid", F.coalesce(F.lead("pid").over(order), F.first("pid").over(order)).alias("next_pid"))
    last = ends.where("side = 1").select("pid", "doc_id", "text").join(after, "pid")
    joined = last.join(heads.withColumnRenamed("pid", "next_pid"), "next_pid").select("doc_id", "text", "next_text")
    return all_rows.where("side is null").select([n for n, _ in _OUT]).unionByName(joined.mapInArrow(_pairs, _SCHEMA))


def _block(x: Column, k: int) -> Column:
    """Bits of block ``k`` of a fingerprint kept as a long."""
    a, b = BITS * k // BLOCKS, BITS * (k + 1) // BLOCKS
    return F.shiftrightunsigned(x, a).bitwiseAND(F.lit((1 << (b - a)) - 1))


def within_radius(queries: DataFrame, rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(q, f): pairs of a fingerprint of ``queries`` and one of ``rows`` (column ``f``,
    hexadecimal) that differ in at most ``radius`` < BLOCKS bits, by permuted block tables.

    Equal fingerprints are one row on either side; a key shared by a great many
    is split by Spark's skew join.
    """
    tables = list(combinations(range(BLOCKS), BLOCKS - radius))
    number = lambda c: F.conv(c, 16, -10).cast("long")
    keyed = lambda df, name: cut(df.select(
        F.col("f").alias(name), number(F.col("f")).alias(name + "n")).distinct(), name).select(
        name, name + "n", F.posexplode(F.array(*[
            F.xxhash64(*[_block(F.col(name + "n"), k) for k in t]) for t in tables])).alias("table", "key"))
    left, right = keyed(queries, "q"), keyed(rows, "r")
    differ = F.col("qn").bitwiseXOR(F.col("rn"))
    equal = [_block(differ, k) == 0 for k in range(BLOCKS)]
    first = F.coalesce(*[F.when(F.expr("true") if not t else _all([equal[k] for k in t]), F.lit(i))
                         for i, t in enumerate(tables)])
    return left.join(right, (left["table"] == right["table"]) & (left["key"] == right["key"])
                     & (F.bit_count(differ) <= radius) & (left["table"] == first)).select("q", F.col("r").alias("f"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def near_counts(prints: DataFrame, every: int = 50, radius: int = RADIUS) -> DataFrame:
    """(doc_id, n_within): for every document whose id ``every`` divides, how many
    documents (itself included) have a fingerprint within ``radius`` of its own."""
    f = prints.select("doc_id", F.col("fingerprint").alias("f"))
    asked = f.where(F.col("doc_id") % every == 0)
    counts = f.groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    sums = within_radius(asked, f, radius).join(counts, "f").groupBy("q").agg(F.sum("n").alias("n_within"))
    return asked.join(sums.withColumnRenamed("q", "f"), "f").select("doc_id", "n_within")
