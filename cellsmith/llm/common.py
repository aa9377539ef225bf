"""Helpers shared by the operators: the id split, vectorised word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from cellsmith.session import cut  # noqa: F401  (the operators import it from here)

#: A word of the contracts: a run without the six ASCII white-space characters (Java regex).
WORD = r"[^\x20\x09-\x0D]+"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(id_col: Column, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % m


# --- words of a batch of texts, as 64-bit hashes ------------------------------------------

_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BLOCK = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream64(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    i = np.arange(1, n + 1, dtype=np.uint64) + _U(seed * 1_000_003)
    return mix64(i * _U(0x9E3779B97F4A7C15))


_BYTE = stream64(256, 1)
_BASE = 0x5851F42D4C957F2D
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, _BLOCK + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        p, q = np.full(size, _U(_BASE)), np.full(size, _U(inverse))
        p[0] = q[0] = 1
        _POW, _INV = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _POW[:n], _INV[:n]


def texts_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array without nulls, and the n + 1 offsets into them."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset:array.offset + len(array) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off.astype(np.int64) - int(off[0])


def _blocks(buf: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about a block each that end at a text's end or at white space."""
    a, n = 0, len(buf)
    while a < n:
        b = min(a + _BLOCK, n)
        if b < n:
            i = int(np.searchsorted(off, b, "right")) - 1
            if off[i] > a:
                b = int(off[i])
            else:  # inside a text that is longer than a block
                while b < n and not SPACE[buf[b]] and b < off[i + 1]:
                    b += 1
        yield a, b
        a = b


def word_spans(buf: np.ndarray, off: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; no word crosses from one text into the next."""
    inside = ~space[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = off[(off > 0) & (off < len(buf))]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edge - 1] = inside[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashed_words(array: pa.Array, space: np.ndarray = SPACE,
                 fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of every text, A-Z lower-cased, as 64-bit hashes.

    Returns the hashes of all words in order, the first word of each text
    (n + 1 offsets), and the words' byte starts and ends in the batch's bytes.
    A word's hash is the polynomial of its bytes (prefix sums, so no loop over
    words), mixed with its length. Works block by block: memory beyond the
    result does not grow with the batch or with a text.
    """
    buf, off = texts_of(array)
    hashes, starts, ends = [], [], []
    for a, b in _blocks(buf, off):
        part = buf[a:b]
        inner = off[(off >= a) & (off <= b)] - a
        s, e = word_spans(part, inner, space)
        if not len(s):
            continue
        p, q = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[fold[part]] * p[:-1], out=sums[1:])
        hashes.append(mix64((sums[e] - sums[s]) * q[s] + (e - s).astype(np.uint64)))
        starts.append(s + a)
        ends.append(e + a)
    join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    s = join(starts, np.int64)
    return join(hashes, np.uint64), np.searchsorted(s, off), s, join(ends, np.int64)


def windows64(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``n`` consecutive words inside a text, and the
    first run of each text (offsets). Texts of fewer words have none."""
    c = stream64(n, 7) | _U(1)
    total = max(len(h) - n + 1, 0)
    x = np.zeros(total, np.uint64)
    for j in range(n):
        x += h[j:j + total] * c[j]
    per = np.maximum(np.diff(first) - n + 1, 0)
    out = np.concatenate([[0], np.cumsum(per)])
    at = np.arange(out[-1]) + np.repeat(first[:-1] - out[:-1], per)
    return mix64(x[at]), out
