"""Merkle manifest of a dataset, with an inclusion proof for every row.

A row is a leaf; the leaves of a language, ascending by id, form a tree in which
every 8 consecutive nodes become their hash until one is left (the subroot), and
the subroots, ordered by language, form a tree of the same kind above them.

Both directions go by superblocks, the ``8 ** height`` consecutive nodes below one
node ``height`` levels up, which are the largest groups there are. Upwards each
superblock becomes its top node, until every tree is a single node; a table of
superblocks has a 4096th of the rows (``HEIGHT``). Downwards the nodes of a superblock are
cogrouped with the one row of their top that carries the outer nodes, the siblings on
the way from there to the root; one ``applyInPandas`` finishes the local reduction,
joins the proofs and, at the leaves, folds them. So no tree, language or proof
meets in one task, and a hot language is as many groups as it has superblocks.

Positions come from a range partitioning by (language, id, leaf) and the partitions'
counts; the texts are hashed where they are read and never move.

Defined cases: a null language is the first tree, a null id the first leaf of its
tree (for the choice of tampered rows it counts as an empty text); rows of one id are
ordered by their leaf hash, equal rows are leaves of their own; null and empty values
hash differently; without rows the result is empty; other columns are not looked at.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellsmith.llm.common import crc_mod, cut, partitions

FAN = 8
#: Levels of a superblock: 8 ** 4 = 4096 nodes.
HEIGHT = 4
#: Columns of a leaf, in the order in which they are hashed; the last one is the text.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _value(c: Column) -> Column:
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def leaf_hash(columns: list[Column]) -> Column:
    """SHA-256 (hex) of the values, each with its length, so that no two rows read alike."""
    return F.sha2(F.concat(*map(_value, columns)), 256)


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, tamper: Column | None = None) -> DataFrame:
    """(id, tree, leaf, forged): ``forged`` is the leaf of the row with A-Z lower-cased where
    ``tamper`` holds, null elsewhere; ``tree`` orders a null language first."""
    cols = [F.col(c) for c in fields]
    forged = leaf_hash([*cols[:-1], F.translate(cols[-1], UPPER, LOWER)])
    tree = F.coalesce(F.concat(F.lit("="), F.col(fields[2])), F.lit(""))
    return docs.select(
        cols[0].cast("long").alias("id"), tree.alias("tree"), leaf_hash(cols).alias("leaf"),
        F.when(tamper, forged).alias("forged") if tamper is not None else F.lit(None).cast("string").alias("forged"))


def positions(rows: DataFrame, order: list[str], tree: str | None = "tree") -> DataFrame:
    """``rows`` with pos (from 0, by ``order`` within each ``tree``) and n, the tree's number of rows.

    ``tree`` must be the first of ``order``; without it all rows are one tree. The small
    table that is joined has a row for each partition and tree in it.
    """
    key = F.col(tree) if tree else F.lit("")
    spread = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    spread = cut(spread.select("*", key.alias("_t"), F.spark_partition_id().alias("_p"),
                               F.monotonically_increasing_id().alias("_at")), "ordered")
    counts = cut(spread.groupBy("_t", "_p").agg(F.count(F.lit(1)).alias("k"), F.min("_at").alias("lo")), "counts")
    whole = Window.partitionBy("_t")
    before = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_t", "_p", (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("lo")).alias("shift"),
                           F.sum("k").over(whole).alias("n"))
    return spread.join(starts, ["_t", "_p"]) \
        .select(*rows.columns, (F.col("_at") + F.col("shift")).alias("pos"), "n")


def _levels(nodes: pd.DataFrame, height: int) -> list[list[str]]:
    """The levels of a superblock's sorted nodes, these first; n: nodes of the whole tree at that level."""
    out, n = [nodes["digest"].tolist()], int(nodes["n"].iloc[0])
    while n > 1 and len(out) <= height:
        last = out[-1]
        out.append([_hash("".join(last[i:i + FAN])) for i in range(0, len(last), FAN)])
        n = -(-n // FAN)
    return out


def _siblings(levels: list[list[str]], i: int) -> tuple[list[str], list[str]]:
    """What stands before and after node ``i`` of the first level, and its ancestors, in their runs."""
    before, after = [], []
    for level in levels[:-1]:
        run = i // FAN * FAN
        before.append("".join(level[run:i]))
        after.append("".join(level[i + 1:run + FAN]))
        i //= FAN
    return before, after


def _tops(height: int):
    def run(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        first = nodes.iloc[0]
        return pd.DataFrame({"tree": [first["tree"]], "pos": [first["pos"] // FAN ** height],
                             "n": [-(-first["n"] // FAN ** height)], "digest": _levels(nodes, height)[-1]})

    return run


_NODE = "tree string, pos long, n long, digest string"
_OUTER = "tree string, pos long, subroot string, root string, before array<string>, after array<string>"


def _in_blocks(nodes: DataFrame, height: int):
    return nodes.withColumn("block", F.floor(F.col("pos") / FAN ** height)).groupBy("tree", "block")


def reduced(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The tables of superblock tops (tree, pos, n, digest) from ``nodes`` up; in the last
    one every tree is a single node."""
    out = [nodes]
    while True:
        blocks = _in_blocks(out[-1].select("tree", "pos", "n", "digest"), height)
        out.append(cut(blocks.applyInPandas(_tops(height), _NODE), "tops"))
        if (out[-1].agg(F.max("n")).first()[0] or 1) == 1:
            return out


def _outward(height: int):
    """The outer nodes of every node of a superblock: its siblings inside, then those of the top."""

    def run(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        levels = _levels(nodes, height)
        top = outer.iloc[0]
        found = [_siblings(levels, i) for i in range(len(nodes))]
        return pd.DataFrame({
            "tree": nodes["tree"].to_numpy(), "pos": nodes["pos"].to_numpy(), "subroot": top["subroot"],
            "root": top["root"], "before": [[*b, *top["before"]] for b, _ in found],
            "after": [[*a, *top["after"]] for _, a in found]})

    return run


def _proved(height: int):
    """The proof of every leaf of a superblock, and the root that it folds to."""

    def run(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        levels = _levels(nodes, height)
        top = outer.iloc[0]
        proofs, folds = [], []
        for i, (leaf, forged) in enumerate(zip(nodes["digest"], nodes["forged"], strict=True)):
            before, after = _siblings(levels, i)
            before.extend(top["before"])
            after.extend(top["after"])
            at = forged if isinstance(forged, str) else leaf
            for b, a in zip(before, after, strict=True):
                at = _hash(b + at + a)
            proofs.append(_hash("".join(x for both in zip(before, after, strict=True) for x in both)))
            folds.append(at)
        return pd.DataFrame({"id": nodes["id"].to_numpy(), "leaf": nodes["digest"].to_numpy(),
                             "subroot": top["subroot"], "root": top["root"], "proof_sha256": proofs,
                             "folded_root": folds})

    return run


_PROOF = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _descend(levels: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """Outer nodes of the first of ``levels`` but one, from those of the last."""
    for nodes in reversed(levels[1:-1]):
        blocks = _in_blocks(nodes, height).cogroup(outer.groupBy("tree", "pos"))
        outer = cut(blocks.applyInPandas(_outward(height), _OUTER), "outer")
    return outer


def manifest(docs: DataFrame, *, fields: tuple[str, ...] = FIELDS, tamper: Column | None = None,
             height: int = HEIGHT) -> DataFrame:
    """Per row: its id, leaf, the subroot of its language, root, proof_sha256 (hash of the siblings
    from the leaf to the root, each run left to right), folded_root (from the tampered leaf where
    ``tamper`` holds) and verified, whether that is the root."""
    rows = cut(leaves(docs, fields, tamper), "leaves").withColumn("tie", F.monotonically_increasing_id())
    placed = cut(positions(rows, ["tree", "id", "leaf", "tie"])
                 .select(F.col("id").cast("string").alias("id"), "tree", "pos", "n", F.col("leaf").alias("digest"),
                         "forged"), "placed")
    up = reduced(placed, height)

    # the tree of the subroots; its nodes are found again by their language
    subs = cut(positions(up[-1].select(F.col("tree").alias("lang"), "digest"), ["lang"], None)
               .select(F.lit("").alias("tree"), "pos", "n", "digest", "lang"), "subroots")
    over = reduced(subs, height)
    outer = over[-1].select("tree", "pos", F.lit("").alias("subroot"), F.col("digest").alias("root"),
                            F.array().cast("array<string>").alias("before"),
                            F.array().cast("array<string>").alias("after"))
    blocks = _in_blocks(subs, height).cogroup(_descend(over, outer, height).groupBy("tree", "pos"))
    outer = cut(blocks.applyInPandas(_outward(height), _OUTER), "over")
    outer = subs.drop("tree").join(outer.drop("tree", "subroot"), "pos") \
        .select(F.col("lang").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"),
                "root", "before", "after")

    outer = _descend(up, cut(outer, "outer"), height)
    out = _in_blocks(placed, height).cogroup(outer.groupBy("tree", "pos")).applyInPandas(_proved(height), _PROOF)
    return out.select(F.col("id").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256",
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def audit(docs: DataFrame, *, id_col: str = "doc_id", height: int = HEIGHT) -> DataFrame:
    """The manifest of ``docs`` held against rows of which those with an id whose crc32 is a multiple
    of three were lower-cased."""
    return manifest(docs, fields=(id_col, *FIELDS[1:]), tamper=crc_mod(F.col(id_col), 3) == 0, height=height)
