"""Every stage against plain Python on its own input, then the whole run."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from cellsmith.llm.common import cut
from tests.llm.helpers import ODD, dedup_lines_plain, docs_df, levels_plain, near_components, prose
from tests.llm.test_quality_lines import measures

SF = "/root/testdata/sf0.001"


def good(t):
    n, chars, symbols, dup, rep = measures(t)
    lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    upper = sum(c.isupper() for c in t or "")
    return not (n < 20 or 100 * rep > 30 * n or 10 * symbols > 3 * n or 5 * upper > 2 * chars or 2 * dup > len(lines))


def test_stages_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    source = {r.doc_id: r.source for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    step = lambda name, df: cut(stages[name](spark, df, SF), name)

    docs = step("quality_rules", docs)
    want = {i: t for i, t in rows if good(t)}
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == want

    docs = step("line_dedup", docs)
    want = dedup_lines_plain(list(want.items()))
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == want

    docs = step("near_dedup", docs)
    comp, _ = near_components(list(want.items()))
    want = {i: t for i, t in want.items() if comp[i] == i}
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == want

    docs = step("mixing", docs)
    sizes, got, largest = Counter(), Counter(), Counter()
    for i, t in want.items():
        n = len(t.split())
        sizes[source[i]] += n
        largest[source[i]] = max(largest[source[i]], n)
    for r in docs.collect():
        assert r.text == want[r.doc_id]
        got[r.source] += len(r.text.split())
    assert max(Counter(r.doc_id for r in docs.collect()).values()) <= 2
    for s, t in levels_plain(dict(sizes)).items():
        assert abs(got[s] - t) <= largest[s]

    pieces = step("packing", docs).collect()
    times = Counter(r.doc_id for r in docs.collect())
    tokens = Counter()
    for p in pieces:
        tokens[p.doc_id, p.doc_tokens] += p.length
    assert all(n == times[i] * size for (i, size), n in tokens.items()) and {i for i, _ in tokens} == set(times)


def test_run_and_odd_rows(spark, tmp_path):
    rows = ODD + [(i, prose(i % 9, 40 + i % 7), f"s{i % 3}") for i in range(60)]
    random.Random(2).shuffle(rows)
    docs_df(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and all(p.doc_id < 60 for p in out)
    docs_df(spark, []).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
