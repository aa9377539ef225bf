from __future__ import annotations

from collections import Counter

import pytest

from cellsmith.llm import mixing
from tests.llm.helpers import ODD, docs_df, levels_plain, prose


def rows():
    out, i = [], 0
    for s, n in (("big", 400), ("b", 40), ("c", 30), ("é", 50), (None, 20), ("tiny", 2)):
        for _ in range(n):
            out.append((i, prose(i, 3 + i % 17), s))
            i += 1
    return out


def test_targets_and_taken_words(spark):
    data = rows()
    out = mixing.mix_report(docs_df(spark, data)).collect()
    sizes = Counter()
    for i, t, s in data:
        sizes[s] += len(t.split())
    want = levels_plain(dict(sizes))
    source = {i: s for i, _, s in data}
    taken, largest = Counter(), Counter()
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken % r.size == 0 and r.taken <= 2 * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_reruns_and_partitionings_agree(spark):
    df = docs_df(spark, rows())
    a, b = (sorted(map(tuple, mixing.mix_report(x).collect())) for x in (df, df.repartition(5)))
    assert a == b
    c = sorted(map(tuple, mixing.mix_report(df, seed=18).collect()))
    assert [x[:4] for x in a] == [x[:4] for x in c] and a != c


def test_mixed_rows_follow_the_report(spark):
    df = docs_df(spark, rows())
    times = {r.doc_id: r.taken // r.size for r in mixing.mix_report(df).collect()}
    got = Counter(r.doc_id for r in mixing.mix(df).collect())
    assert got == {i: n for i, n in times.items() if n} and mixing.mix(df).columns == df.columns


def test_odd_rows_clashing_columns_and_empty_table(spark):
    df = docs_df(spark, ODD).selectExpr("*", "1 as size", "2 as source_size", "3 as u", "4 as whole", "5 as id")
    out = mixing.mix_report(df).collect()
    assert len(out) == len(ODD)
    assert all(r.taken == 0 for r in out if r.size == 0)
    assert set(mixing.mix(df).columns) == set(df.columns) and mixing.mix(df).count() >= 0
    empty = docs_df(spark, [])
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0
