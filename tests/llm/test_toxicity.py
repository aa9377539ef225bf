from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from cellsmith.llm import toxicity
from tests.llm.helpers import ODD, docs_df, prose

BAD = ["grumble", "wretch", "dimwit"]


def corpus(n=200):
    rows, labels = [], []
    for i in range(n):
        t, toxic = prose(i, 50), i % 4 == 0
        if toxic:
            w = t.split()
            w[i % 40] = BAD[i // 4 % 3]
            w[(i + 9) % 40] = BAD[(i // 4 + 1) % 3]
            t = " ".join(w)
        rows.append((i, t))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def labels_df(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def decoder():
    t = " ".join(BAD * 30 + [prose(1, 300)])
    return toxicity.Decoder(toxicity.log_model(toxicity.trigram_counts(pa.array([t]))))


@pytest.mark.parametrize("word,plain", [
    ("grumb1e", "grumble"), ("wr3tch", "wretch"), ("d1mw!t", "dimwit"),
    ("wreeeetch", "wretch"), ("d.i.m.w.i.t", "dimwit"), ("gr*mble", "grumble"), ("wwwr3tchhh", "wretch")])
def test_decoder(decoder, word, plain):
    assert decoder.restore(word) == plain


@pytest.fixture(scope="module")
def english():
    t = " ".join(["you are a wretch", "i am a dimwit", "a total grumble", "the dimwit and the wretch"] * 30)
    return toxicity.Decoder(toxicity.log_model(toxicity.trigram_counts(pa.array([t]))))


@pytest.mark.parametrize("text,words", [
    ("you are a w r e t c h", ["wretch"]), ("I d i m w i t", ["dimwit"]), ("w r e t c h d i m w i t", ["wretch", "dimwit"]),
    ("w r e t c h   d i m w i t", ["wretch", "dimwit"]), ("you-d1mw1t", ["dimwit"]), ("total/d1mw1t", ["dimwit"]),
    ("wr3tch/d1mw!t", ["wretch", "dimwit"]), ("d.i.m.w.i.t", ["dimwit"]), ("gr*mble,wr3tch", ["grumble", "wretch"])])
def test_disguised_words_beside_others(english, text, words):
    _, found = toxicity.word_sets(pa.array([text]), english)
    want = toxicity.hashed_words(pa.array([" ".join(words)]), toxicity._NOT_WORD)[0]
    assert set(want.tolist()) <= set(found.tolist())


@pytest.mark.parametrize("text,word", [
    ("wre" + "e" * 60 + "tch", "wretch"), ("it/is/such/a/long/one/that/it/never/ends/d1mw1t/so", "dimwit"),
    ("you-are-a-total-wretch-and-the-total-grumble-d1mw!t", "dimwit"),
    ("a " * 37 + "w r e t c h", "wretch"), ("w" + " w" * 50 + " r e t c h", "wretch"), ("é" * 30 + "/wr3tch", "wretch")])
def test_long_tokens_and_runs_are_restored_whole(english, text, word):
    _, found = toxicity.word_sets(pa.array([text]), english)
    assert int(toxicity.hashed_words(pa.array([word]), toxicity._NOT_WORD)[0][0]) in found.tolist()


def test_disguised_words_are_found():
    t = ["plain words only, so. 42 1999 ***", "a gr0mble and d.i.m.w.i.t here", "w r e t c h !", "sooo", "", "x" * 99]
    where, found = toxicity.disguised(pa.array(t))
    assert list(zip(where.tolist(), found)) == [
        (1, "gr0mble"), (1, "d.i.m.w.i.t"), (3, "sooo"), (2, "wretch!")] or set(found) >= {"gr0mble", "sooo"}
    assert not any(k in (0, 4, 5) for k in where.tolist())
    assert any(f.startswith("wretch") for f in found)


def test_disguised_toxic_documents_are_caught(spark):
    rows, labels = corpus()
    extra = [(1000, prose(7, 40) + " gr*mb1e " + prose(8, 40)), (1001, prose(7, 40) + " w r e t c h " + prose(8, 9)),
             (1002, prose(7, 80)), (1003, prose(5, 30) + " d1mmmwit.")]
    out = {r.doc_id: r for r in toxicity.toxicity(docs_df(spark, rows + extra + ODD), labels_df(spark, labels)).collect()}
    assert all(out[i].predicted == y for i, _, y in labels)
    assert [out[i].predicted for i in (1000, 1001, 1002, 1003)] == [1, 1, 0, 1]
    assert all(0 <= r.score <= 1 for r in out.values()) and out[901].predicted == 0


def test_no_labels_and_empty(spark):
    none = labels_df(spark, [])
    assert {r.score for r in toxicity.toxicity(docs_df(spark, ODD), none).collect()} == {0.0}
    assert toxicity.toxicity(docs_df(spark, []), none).count() == 0


def test_held_out_accuracy_on_given_documents(spark):
    d = "/root/testdata/sf0.01"
    df, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    out = [r for r in toxicity.toxicity(df, labels).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) >= 0.97
