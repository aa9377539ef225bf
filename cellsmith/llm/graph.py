"""Connected components of a link table, by contraction in tasks of bounded size and alternating stars.

Links are read by as many tasks as they fill, ``CHUNK`` a task, and each task joins its links
into stars of its own. Where one chunk holds them all, that is the result. Otherwise large and
small stars follow, and the next contraction: a large star hangs a node's larger neighbours on its
smallest one, a small star the smaller ones. The number of rounds grows with the logarithm of
the longest chain. Links stay distributed; one row a round reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import cut


#: Links that a task joins at a time; about 100 MB with nodes of 16 bytes.
CHUNK = 200_000


def _stars(chunk: int):
    """The links of a chunk as links of each node with its component's smallest node in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}
        n, types = 0, None

        def root(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        def out() -> pa.RecordBatch:
            rows = [(x, r) for x in up if (r := root(x)) != x]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types) for i in (0, 1)], ["u", "v"])

        for b in batches:
            types = b.schema.field("u").type
            for k in range(0, b.num_rows, chunk):
                some = b.slice(k, chunk)
                if n + some.num_rows > chunk:
                    yield out()
                    up, n = {}, 0
                for x, y in zip(some["u"].to_pylist(), some["v"].to_pylist(), strict=True):
                    x, y = root(up.setdefault(x, x)), root(up.setdefault(y, y))
                    if x != y:
                        up[max(x, y)] = min(x, y)
                n += some.num_rows
        if up:
            yield out()

    return run


def _is_forest_of_stars(e: DataFrame) -> bool:
    """Whether every node either hangs on one other node or has nodes hanging on it."""
    ends = e.select(F.col("u").alias("n"), F.lit(1).alias("low")).unionByName(
        e.select(F.col("v").alias("n"), F.lit(0).alias("low")))
    ends = ends.groupBy("n").agg(F.sum("low").alias("k"), F.min("low").alias("least"))
    return not ends.where((F.col("k") > 1) | (F.col("k") > F.col("least"))).limit(1).count()


def _large_and_small_stars(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # the minima are written, so that the join back has a plain exchange on
    # either side and AQE splits the rows of a node with a great many links
    least = cut(both.groupBy("u").agg(F.min("v").alias("m")), "least")
    large = both.where(F.col("v") > F.col("u")).join(least, "u") \
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
    # now a node has few smaller neighbours
    low = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
    return low.select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")) \
        .unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the component's smallest node.

    Links in either direction, repeated links and links of a node with itself are
    allowed; without links the result is empty.
    """
    e = cut(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")),
            "links")
    while True:
        tasks = max(1, -(-e.count() // chunk))
        stars = e.coalesce(tasks).mapInArrow(_stars(chunk), e.schema)
        if tasks == 1:
            e = cut(stars, "stars")
            break
        e = cut(stars.distinct(), "stars")
        if _is_forest_of_stars(e):
            break
        e = cut(_large_and_small_stars(e), "links")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def joined(whole: DataFrame, links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The components (node, root) of the links that made ``whole`` and the further ``links`` (a, b).

    Only links between different components go through ``components``, as links of
    their roots; the nodes of ``whole`` then take their new roots by one join.
    """
    roots = lambda n: whole.select(F.col("node").alias(n), F.col("root").alias(f"{n}_root"))
    named = links.join(roots("a"), "a", "left").join(roots("b"), "b", "left") \
        .select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    moved = cut(components(named.where(F.col("a") != F.col("b")).distinct(), chunk), "moved")
    to = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
    new = moved.join(whole.select("node"), "node", "left_anti").select("node", "root")
    return cut(whole.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")).unionByName(new),
               "joined")
