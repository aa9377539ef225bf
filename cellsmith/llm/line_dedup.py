"""Line dedup over overlapping windows of three lines (DataFrame functions only).

The lines of a text that are not blank form overlapping windows of ``window``
consecutive lines. A window seen anywhere before (smaller document id, then
earlier in the text) is a later occurrence, and every line that a later
occurrence covers goes, with the blank lines between them. Lines are compared
exactly. The first occurrence of every distinct line always stays: what covers
it would have an earlier twin that holds the same line earlier.

Defined cases: null texts stay null; texts of fewer than ``window`` lines stay
as they are; rows that repeat an id and its text count as one document and come
out alike; null ids come first in the order; an empty table gives an empty
result; other columns are passed through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import cut


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _filled(lines: Column) -> Column:
    """Positions of the lines that are not blank."""
    at = F.transform(lines, lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), i))
    return F.filter(at, lambda i: i.isNotNull())


def line_windows(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(id, th, pos, a, b): each window's two 64-bit hashes, ``pos`` counting filled lines."""
    df = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("t"))
    df = df.select("id", "th", F.filter(_lines(F.col("t")), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("x"))
    df = df.select("id", "th", F.transform("x", lambda s: F.xxhash64(s)).alias("p"),
                   F.transform("x", lambda s: F.xxhash64(F.lit(1), s)).alias("q"))
    pair = lambda i: F.struct(*[
        F.xxhash64(*[F.get(c, i + j) for j in range(window)]).alias(n) for c, n in (("p", "a"), ("q", "b"))])
    runs = F.when(F.size("p") >= window, F.transform(F.sequence(F.lit(0), F.size("p") - window), pair))
    df = df.select("id", "th", F.posexplode(runs).alias("pos", "w"))
    return df.select("id", "th", "pos", "w.a", "w.b")


def later_windows(docs: DataFrame, *, window: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id, th, starts): per document the windows that occurred before.

    Occurrences are counted with a combine before the shuffle, so a window that
    a third of all documents share reaches it as a row a task. The repeated
    windows are written, so the join back has a plain exchange on either side
    and AQE splits a hot window's rows.
    """
    w = cut(line_windows(docs, id_col, text_col, window), "windows")
    first = w.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "pos")).alias("first"))
    repeated = cut(first.where("n > 1").select("a", "b", "first"), "repeated")
    later = w.join(repeated, ["a", "b"]).where(F.struct("id", "th", "pos") > F.col("first"))
    return later.groupBy("id", "th").agg(F.collect_set("pos").alias("starts"))


def deduped_lines(docs: DataFrame, *, window: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(row, n_lines, n_removed, text): the input row, its lines, how many went, what is left."""
    later = later_windows(docs, window=window, id_col=id_col, text_col=text_col)
    later = later.select(F.col("id").alias("lid"), F.col("th").alias("lth"), "starts")
    rows = docs.select(F.struct("*").alias("row"))
    t = F.col(f"row.`{text_col}`")
    on = F.col(f"row.`{id_col}`").eqNullSafe(F.col("lid")) & (F.xxhash64(t) == F.col("lth"))
    df = rows.join(later, on, "left")
    hit = F.col("starts").isNotNull()
    df = df.select("row", "starts", _lines(t).alias("lines"))
    df = df.select("row", "starts", "lines", F.when(hit, _filled(F.col("lines"))).alias("f"))
    # merged cover: from a later window's first line to its last, each position once
    gone = F.array_distinct(F.flatten(F.transform(
        "starts", lambda s: F.sequence(F.get("f", s), F.get("f", s + (window - 1))))))
    df = df.select("row", "starts", "lines", F.when(hit, gone).alias("gone"))
    every = F.transform("lines", lambda x, i: i)
    left = F.transform(F.array_except(every, F.col("gone")), lambda i: F.get("lines", i))
    return df.select(
        "row", F.when(t.isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(hit, F.size("gone")).otherwise(0).cast("long").alias("n_removed"),
        F.when(hit, F.array_join(left, "\n")).otherwise(t).alias("text"))


def dedup_lines(docs: DataFrame, *, window: int = 3, id_col: str = "doc_id", text_col: str = "text",
                chars_col: str | None = None) -> DataFrame:
    """``docs`` with the text shortened; ``chars_col`` gets the new text's length."""
    new = {text_col: F.col("text")} | ({chars_col: F.length("text").cast("long")} if chars_col else {})
    out = deduped_lines(docs, window=window, id_col=id_col, text_col=text_col)
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
