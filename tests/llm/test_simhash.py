from __future__ import annotations

import hashlib

import pyarrow as pa

from cellsmith.llm import simhash
from tests.llm.helpers import ODD, docs_df, prose


def distance(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


def test_report_against_plain_python(spark):
    rows = [(i * 3, prose(i, 40 + i)) for i in range(60)] + [(7, prose(2, 42)), (8, "\U0001f600" * 9)]
    got = {r.doc_id: r for r in simhash.fingerprint_report(docs_df(spark, rows)).collect()}
    assert len(got) == len(rows)
    order = sorted(rows)
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        q = len(t) // 4
        e = t[:len(t) - q] + following[:q]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        f, n, g = (f"{x:016x}" for x in simhash.fingerprints(pa.array([t, following, e])).tolist())
        assert (r.fingerprint, r.edited_fingerprint) == (f, g)
        assert r.near_edited == 1 - distance(f, g) / 64 and r.near_next == 1 - distance(f, n) / 64
    assert got[7].fingerprint == got[6].fingerprint


def test_odd_rows_and_empty_table(spark):
    out = simhash.fingerprint_report(docs_df(spark, ODD)).collect()
    assert len(out) == len(ODD)
    assert {r.fingerprint for r in out if r.doc_id in (900, 901, 902)} == {"0" * 16}
    assert simhash.fingerprint_report(docs_df(spark, [])).count() == 0


def test_edits_are_nearer_than_strangers(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = simhash.fingerprint_report(df).collect()
    edit, other = (sorted(getattr(r, c) for r in out) for c in ("near_edited", "near_next"))
    assert edit[len(out) // 10] > other[9 * len(out) // 10]


def test_block_tables_find_all_within_radius(spark):
    import random
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(30)]
    prints = [x ^ sum(1 << b for b in r.sample(range(64), r.randrange(6))) for x in base for _ in range(8)]
    names = [f"{x:016x}" for x in prints]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(names)], "doc_id long, fingerprint string")
    f = df.selectExpr("fingerprint as f")
    got = sorted((x.q, x.f) for x in simhash.within_radius(f, f).collect())
    assert got == sorted({(a, b) for a in names for b in names if distance(a, b) <= simhash.RADIUS})
    counts = {x.doc_id: x.n_within for x in simhash.near_counts(df, every=50).collect()}
    assert counts == {i: sum(distance(x, y) <= simhash.RADIUS for y in names)
                      for i, x in enumerate(names) if i % 50 == 0}
