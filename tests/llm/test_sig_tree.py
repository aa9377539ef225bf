"""The signature-tree join against comparing all documents."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellsmith.llm import sig_tree

from tests.llm.helpers import ODD, docs_df, near_components, prose, shingles


def check(spark, rows, **options):
    df = docs_df(spark, rows).withColumn("block", F.lit("x")).withColumn("cid", F.lit(1)).withColumn("th", F.lit(2))
    got = sig_tree.jaccard_components(df.repartition(4), **options)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    root, size = near_components([(r[0], r[1]) for r in rows], 80)
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in got.collect()} == {i: (root[i], size[i]) for i in root}


def edited(text, r, n, mark):
    w = text.split()
    for k in range(n):
        w[r.randrange(len(w))] = f"{mark}x{k}"
    return " ".join(w)


def test_copies_edits_and_boundary(spark):
    r = random.Random(5)
    rows = []
    for g in range(30):
        base = prose(g, 120)
        rows += [(len(rows) + k, edited(base, r, k % 6, f"g{g}k{k}")) for k in range(8)]
    rows += [(1000 + i, prose(1000 + i, r.randrange(1, 40), 30)) for i in range(200)]
    # exactly at, and just below, 80 of 100
    words = [f"b{i}" for i in range(94)]
    rows += [(2000, " ".join(words)), (2001, " ".join(words[:76])), (2002, " ".join(words[:75]))]
    check(spark, rows)


def test_crowd_around_the_threshold(spark, monkeypatch):
    """Form letters alike at 0.72 to 0.9, all of frequent shingles, in chunks of a few."""
    monkeypatch.setattr(sig_tree, "CHUNK", 3000)
    monkeypatch.setattr(sig_tree, "CHUNK_ROWS", 40)
    r = random.Random(6)
    form = prose(77, 80)
    rows = [(i, edited(form, r, r.randrange(1, 5), f"d{i}")) for i in range(500)]
    rows += [(1000 + i, prose(i, 100) + " " + form) for i in range(100)]  # a passage that many share
    check(spark, rows)


def test_bridge_between_two_groups(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:180 - i])) for i in range(40)]
    check(spark, rows)


def test_odd_rows_and_empty_table(spark):
    df = docs_df(spark, ODD)
    out = sig_tree.jaccard_components(df).collect()
    assert len(out) == len(ODD)
    assert {r.component_id for r in out if r.doc_id == 906} == {906}
    assert all(r.n_shingles == 0 and r.component_id == r.doc_id for r in out if r.doc_id in (900, 901, 902))
    assert sig_tree.jaccard_components(df.where("false")).count() == 0


def test_more_frequent_shingles_than_the_filter_holds(spark, monkeypatch):
    """The order changes, the result does not."""
    monkeypatch.setattr(sig_tree, "FREQUENT", 3)
    monkeypatch.setattr(sig_tree, "MOST_FREQUENT", 10)
    r = random.Random(8)
    base = prose(3, 90)
    check(spark, [(i, edited(base, r, i % 4, f"m{i}")) for i in range(60)])


@pytest.mark.parametrize("two", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_block_links_connect_what_all_pairs_connect(seed, two):
    r = random.Random(seed)
    sets, comp, side = [], [], []
    for i in range(300):
        base = list(range((i % 12) * 1000, (i % 12) * 1000 + r.randrange(60, 75)))
        drop = set(r.sample(base, r.randrange(0, 14)))
        s = [x for x in base if x not in drop] + [10 ** 6 + i * 50 + k for k in range(r.randrange(0, 5))]
        sets.append(np.array(sorted(s), np.uint64))
        comp.append(i if r.random() < 0.8 else 10_000 + i % 12)
        side.append(r.randrange(2) if two else 0)

    def parts(links):
        up = {c: c for c in comp}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for i, j in links:
            a, b = sorted((root(comp[i]), root(comp[j])))
            up[b] = a
        return [root(c) for c in comp]

    every = []
    for i in range(300):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if (not two or side[i] != side[j]) and 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                every.append((i, j))
    links = sig_tree.block_links(sets, comp, side, 80)
    assert set(map(frozenset, links)) <= set(map(frozenset, every))
    assert parts(links) == parts(every)
    assert len(links) <= 300


def test_shingles_are_those_of_the_contract():
    assert shingles("A b c d E f") == {tuple(x.encode() for x in s) for s in (("a", "b", "c", "d", "e"), ("b", "c", "d", "e", "f"))}
