from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest

from cellsmith.llm import line_dedup, quality
from cellsmith.llm.queries import ORACLE, QUERIES
from tests.llm.helpers import ODD, dedup_lines_plain, docs_df, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    t = text or ""
    w = WORD.findall(t)
    runs = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(runs)
    covered = {k for i, r in enumerate(runs) if n[r] > 1 for k in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_measures_and_base_rule(spark):
    rep = prose(1, 9)
    rows = [(i, prose(i, 30 + i)) for i in range(20)] + ODD + [
        (50, f"{rep} x {rep} y {rep}"), (51, " ".join(["a"] * 40)), (52, "b\n" * 30), (53, "#x$ | <a>&b %" * 9),
        (54, prose(2, 60) + " " + prose(2, 60)[:120])]
    out = quality.judged(docs_df(spark, rows)).collect()
    assert len(out) == len(rows)
    want = Counter((i, *measures(t)) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == want
    for r in out:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_bad_hosts_go_and_small_hosts_are_shrunk(spark):
    good, bad = (lambda i: prose(i, 40)), (lambda i: "short")
    rows = [(i, good(i), f"h{i % 20}") for i in range(1000)]
    rows += [(2000 + i, bad(i) if i % 10 else good(i), "spam") for i in range(200)]
    rows += [(3000, bad(0), "one"), (3001, good(1), "one"), (4000, good(2), None)]
    out = {r.doc_id: r for r in quality.judged(docs_df(spark, rows)).collect()}
    assert all(out[i].kept for i in range(1000)) and out[4000].kept
    assert not any(out[2000 + i].kept for i in range(200)) and out[2010].rule_failed is False
    assert 0.15 < out[3000].host_rate < 0.5 and out[3001].kept
    df = docs_df(spark, rows).selectExpr("*", "1 as row", "2 as host", "3 as words", "4 as t")
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.kept}


def test_quality_of_nothing(spark):
    assert quality.judged(docs_df(spark, [])).count() == 0
    assert quality.keep_good(docs_df(spark, [])).count() == 0
    assert quality.keep_good(docs_df(spark, ODD)).count() == 0


def line_rows():
    a = [f"line {k}" for k in range(12)]
    return [(1, "\n".join(a)), (2, "x\n" + "\n".join(a[3:7]) + "\ny"), (3, "\n".join(a[:2]) + "\nz"),
            (4, "p\n\n" + a[0] + "\n\n" + a[1] + "\n \n" + a[2] + "\nq\n"), (5, "s\n" * 9), (6, "\n".join(a)),
            (7, "\n\n\n"), (8, a[0] + "\n" + a[1] + "\n" + a[2])]


def test_lines_equal_plain_python(spark):
    rows = line_rows()
    want = dedup_lines_plain(rows)
    df = docs_df(spark, rows).selectExpr("*", "1 as id", "2 as th", "3 as pos", "4 as lines", "5 as row")
    out = {r.doc_id: r for r in line_dedup.dedup_lines(df, chars_col="n_chars").collect()}
    assert {i: r.text for i, r in out.items()} == want and want[6] == "" and want[8] == ""
    assert all(r.n_chars == len(r.text) and (r.id, r.row) == (1, 5) for r in out.values())
    kept = {x for t in want.values() for x in t.split("\n")}
    assert all(x in kept for _, t in rows for x in t.split("\n") if x.strip())


def test_lines_of_odd_rows(spark):
    df = docs_df(spark, ODD + [(910, "u\nv\nw\nx"), (910, "u\nv\nw\nx"), (None, "u\nv\nw")])
    out = line_dedup.dedup_lines(df).collect()
    texts = Counter((r.doc_id, r.text) for r in out)
    assert texts[910, "x"] == 2 and texts[None, "u\nv\nw"] == 1 and len(out) == len(ODD) + 3
    assert line_dedup.dedup_lines(docs_df(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    df = QUERIES[name](spark, sf)
    res = con.execute(ORACLE[name])
    cols = sorted(d[0] for d in res.description)
    at = [[d[0] for d in res.description].index(c) for c in cols]
    clean = lambda v: round(v, 9) if isinstance(v, float) else v
    assert sorted(df.columns) == cols
    assert sorted(tuple(clean(r[c]) for c in cols) for r in df.collect()) == \
        sorted(tuple(clean(r[k]) for k in at) for r in res.fetchall())
