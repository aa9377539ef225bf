from __future__ import annotations

import numpy as np

from cellsmith.llm import language_id
from tests.llm.helpers import ODD, docs_df, fold

SYLLABLES = {"aa": "the ing tion er", "ab": "the ung tion er", "ba": "que os cion ar", "bb": "que as cion ez"}


def text(lang, seed):
    r = np.random.default_rng(seed)
    parts = SYLLABLES[lang].split()
    return " ".join("".join(r.choice(parts, r.integers(1, 4))) for _ in range(30))


def test_families_and_held_out_languages(spark):
    rows = [(i, text(lang, i), "s", lang) for i, lang in enumerate(list(SYLLABLES) * 40)]
    df = docs_df(spark, rows + ODD)
    model = language_id.trained(df, folds=5, id_col="doc_id", text_col="text", label_col="lang")
    names = {frozenset(model.languages[k] for k in f) for f in model.families}
    assert {frozenset(("ba", "bb"))} <= names or any("aa" in f and "ab" in f for f in names)
    out = {r.doc_id: r for r in language_id.languages(df).collect()}
    for i, t, _, lang in rows:
        assert out[i].held_out == (fold(i, 5) == 0)
        assert out[i].lang_pred == lang and 0 <= out[i].score <= 1
    assert out[901].lang_pred == out[902].lang_pred == out[900].lang_pred == "und"


def test_label_is_no_input(spark):
    rows = [(i, text(lang, i), "s", lang) for i, lang in enumerate(list(SYLLABLES) * 20)]
    held = {r[0] for r in rows if fold(r[0], 5) == 0}
    twisted = [(i, t, "x", None if i in held else lang) for i, t, _, lang in rows]
    a, b = (sorted(map(tuple, language_id.languages(docs_df(spark, x)).collect())) for x in (rows, twisted))
    assert a == b


def test_without_labels_and_empty(spark):
    out = language_id.languages(docs_df(spark, [(1, "abc def", "s", None)])).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)]
    assert language_id.languages(docs_df(spark, [])).count() == 0
    one = language_id.languages(docs_df(spark, [(i, "abc", "s", "aa") for i in range(9)])).collect()
    assert {r.lang_pred for r in one} == {"aa"}


def test_accuracy_on_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in df.select("doc_id", "lang").collect()}
    held = [r for r in language_id.languages(df).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
