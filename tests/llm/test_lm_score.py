from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from cellsmith.llm import lm_score
from tests.llm.helpers import ODD, docs_df, fold, prose, words


def rows_of(spark):
    return [(i, prose(i % 7, 60 + i)) for i in range(40)] + ODD


def counts(rows):
    train = [words(t) + [None] for i, t, *_ in rows if fold(i, 7) != 2]
    one = Counter(w for d in train for w in d)
    two = Counter(p for d in train for p in zip([None, *d], d))
    return one, two


def quantised(counts):
    """The mean count of all n-grams of the same level."""
    level = {g: int(lm_score.level(np.array([c]))[0]) for g, c in counts.items()}
    total, n = Counter(), Counter()
    for g, c in counts.items():
        total[level[g]] += c
        n[level[g]] += 1
    return {g: total[k] / n[k] for g, k in level.items()}


def test_base_is_exact_and_model_close_to_exact_counts(spark):
    rows = rows_of(spark)
    one, two = counts(rows)
    n, v = sum(one.values()), len(one)
    out = lm_score.lm_scores(docs_df(spark, rows)).collect()
    assert len(out) == len(rows)
    one_q, two_q = quantised(one), quantised(two)
    want = {}
    for i, t, *_ in rows:
        toks = words(t) + [None]
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in toks)
        score = 0.0
        for a, b in zip([None, *toks], toks):
            p1 = (one_q.get(b, 0) + 1) / (n + v + 1)
            score += math.log10(lm_score.MIX * (two_q.get((a, b), 0) + lm_score.PRIOR * p1) / (one_q.get(a, 0) + lm_score.PRIOR)
                                + (1 - lm_score.MIX) * p1)
        want[i, len(toks)] = (base, score, sum(one[w] > 0 for w in toks))
    for r in out:
        base, score, known = want[r.doc_id, r.n_tokens]
        assert r.held_out == (fold(r.doc_id, 7) == 2) and r.train_tokens == n
        assert r.base_score == pytest.approx(base, abs=1e-9) and r.n_known == known
        assert r.score == pytest.approx(score, rel=0.02)  # false positives are rare


def test_rare_words_are_joined(spark, monkeypatch):
    rows = rows_of(spark)
    df = docs_df(spark, rows)
    whole = {(r.doc_id, r.n_tokens): r for r in lm_score.lm_scores(df).collect()}
    monkeypatch.setattr(lm_score, "FREQUENT", 50)  # now nearly all words take the other way
    for r in lm_score.lm_scores(df).collect():
        w = whole[r.doc_id, r.n_tokens]
        assert r.base_score == pytest.approx(w.base_score, abs=1e-9) and r.n_known == w.n_known


def test_parts_of_the_filter_give_the_same_scores(spark):
    df = docs_df(spark, rows_of(spark)[:20])
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens)
    one = sorted(lm_score.lm_scores(df).collect(), key=key)
    many = sorted(lm_score.lm_scores(df, part_bytes=1000).collect(), key=key)
    assert [r.score for r in one] == pytest.approx([r.score for r in many])


def test_counts_beyond_32_bits():
    n = 2 ** 32 + 7
    x = np.sort(lm_score.singles(np.arange(3, dtype=np.uint64)))
    (row,) = lm_score._build(iter([lm_score._packed(x, np.array([n, 5, n]), 1, 1)]))
    total, level = np.array(row["total"][0].as_py()), int(lm_score.level(np.array([n]))[0])
    assert total.sum() == 2 * n + 5 and total[level] == 2 * n
    assert lm_score.Filter(1, [(0, row["bits"][0].as_py())]).levels(x)[0] == level


def test_empty_table(spark):
    assert lm_score.lm_scores(docs_df(spark, [])).count() == 0


def test_model_beats_base_on_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = [r for r in lm_score.lm_scores(df).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
