from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from cellsmith.llm import graph, near_dup
from tests.llm.helpers import ODD, docs_df, near_components, prose


def variants(seed, n, words=120, edits=4):
    r = random.Random(seed)
    base = prose(seed, words, 5000).split()
    for k in range(n):
        w = list(base)
        for _ in range(r.randrange(edits + 1) if k else 0):
            w[r.randrange(len(w))] = f"new{seed}x{k}y{r.randrange(99)}"
        yield " ".join(w)


def corpus():
    texts = []
    for s in range(12):
        texts += list(variants(s, 6, edits=6))
    texts += list(variants(99, 90, edits=3))           # one large group of near copies
    texts += [prose(77, 40)] * 30                       # exact copies
    shared = prose(55, 60, 5000)
    texts += [shared + " " + prose(500 + i, 60, 5000) for i in range(60)]  # a passage that many share
    chain = prose(3, 100, 9000).split()
    for k in range(20):                                 # a chain: neighbours alike, ends not
        texts.append(" ".join(chain[2 * k:] + prose(900, 2 * k, 9000).split()))
    texts += ["a b c", "A  b\nc", "a b d", "one", ""]
    r = random.Random(1)
    ids = r.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


def test_components_equal_brute_force(spark):
    rows = corpus()
    want, sizes = near_components(rows)
    out = near_dup.near_duplicates(docs_df(spark, rows)).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: r.component_id for r in out} == want
    assert {r.doc_id: r.n_shingles for r in out} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want, _ = near_components([(r.doc_id, r.text) for r in df.collect()])
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(df).collect()} == want


def letters(n=2400):
    """Form letters that share 89 words and fill in some of their own: crowds at 0.70 to 0.76, with
    links where two share the first word filled in."""
    r = random.Random(5)
    form = [f"form{k}" for k in range(89)]
    texts = []
    for i in range(n):
        fill = [f"own{i}x{k}" for k in range(r.choice((15, 15, 15, 16, 17)))]
        if i % 8 < 2:
            fill[0] = f"both{i // 8}"
        texts.append(" ".join(form + fill))
    r.shuffle(texts)
    return list(enumerate(texts))


def test_links_in_a_crowd_just_below_the_threshold(spark):
    rows = letters()
    sets = [frozenset(tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    both = np.zeros((len(rows), len(rows)), np.int64)
    for h in holders.values():
        if len(h) > 1:
            both[np.ix_(h, h)] += 1
    size = np.array([len(s) for s in sets])
    link = 100 * both >= 75 * (size[:, None] + size - both)
    i, j = np.nonzero(np.triu(link, 1))
    assert len(i) > 100 and len(set(i.tolist()) | set(j.tolist())) == 2 * len(i)  # pairs, each on its own
    want = dict(enumerate(range(len(rows)))) | dict(zip(j.tolist(), i.tolist()))
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs_df(spark, rows)).collect()}
    recall = np.mean([got[b] == got[a] for a, b in zip(i.tolist(), j.tolist())])
    assert recall == 1.0 and got == want


def test_odd_rows_and_keep_one(spark):
    df = docs_df(spark, ODD + [(907, "same row")])
    out = near_dup.near_duplicates(df).collect()
    assert len(out) == len(ODD) + 1
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in out}
    assert got[906, 1] == (906, True) and got[907, 1] == (906, False)
    assert got[900, 0] == (900, True) and got[None, 0] == (None, True)
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [900, 901, 902, 903, 904, 905, 906]
    assert near_dup.near_duplicates(docs_df(spark, [])).count() == 0


def test_shingle_sets_of_long_and_short_texts():
    long = prose(4, 400_000, 10 ** 9)
    sets, at = near_dup.shingle_sets(pa.array([long, "a b", "", "a b", prose(1, 5)]))
    assert np.diff(at).tolist() == [len(long.split()) - 4, 1, 0, 1, 1]
    assert sets[at[1]] == sets[at[3]]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(500, 500), (7, 6)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in graph.components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {k: 100 for k in range(100, 140)}
    assert graph.components(df.limit(0)).count() == 0


def test_components_in_many_chunks_and_joined(spark):
    r = random.Random(8)
    first = [(i, i + 1) for i in range(0, 90) if i % 10] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(70)]
    then = [(9, 11), (50, 51), (400, 401), (401, 15), (3, 250), (3, 3), (600, 601)]

    def want(links):
        up = {}

        def root(x):
            while up.setdefault(x, x) != x:
                x = up[x]
            return x

        for a, b in links:
            if a != b:
                a, b = root(a), root(b)
                up[max(a, b)] = min(a, b)
        return {x: root(x) for x in up}

    df = lambda links: spark.createDataFrame(links, "a long, b long")
    got = lambda out: {x.node: x.root for x in out.collect()}
    for chunk in (7, 10 ** 6):
        whole = graph.components(df(first), chunk)
        assert got(whole) == want(first) and whole.count() == len(want(first))
        more = graph.joined(whole, df(then), chunk)
        assert got(more) == want(first + then) and more.count() == len(want(first + then))
    assert got(graph.joined(whole, df(then).limit(0))) == want(first)
    assert got(graph.joined(whole.limit(0), df(then))) == want(then)
