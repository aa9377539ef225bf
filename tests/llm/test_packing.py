from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from cellsmith.llm import packing
from tests.llm.helpers import ODD, docs_df, prose


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.VOCABULARY)


def check(rows, pieces, tokenizer):
    """Every id lies in one piece, sequences have no gap; returns the padding."""
    ids = defaultdict(list)
    for i, t, *_ in rows:
        ids[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for i, parts in by_doc.items():
        assert sum(p.length for p in parts) == sum(map(len, ids[i]))
        if len(ids[i]) == 1:
            at = 0
            for p in sorted(parts, key=lambda p: p.start):
                piece = ids[i][0][at:at + p.length]
                assert p.start == at and p.doc_tokens == len(ids[i][0])
                assert p.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
                at += p.length
    padding = 0
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= packing.WINDOW
        padding += packing.WINDOW - at
    return padding


def test_given_documents(spark, tokenizer):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert check(rows, packing.packed(df).collect(), tokenizer) < 8 * packing.WINDOW


def test_odd_rows(spark, tokenizer):
    rows = [(i, prose(i, 20 + 50 * i)) for i in range(40)] + ODD + [
        (950, "tabs\tand  blanks \n\n lines\r\n"), (951, " starts"), (952, "ends\n"), (953, "it's <|endoftext|> don't"),
        (954, "a\x1cb c d")]
    assert check([r for r in rows if r[0] not in (None, 906)], [
        p for p in packing.packed(docs_df(spark, [r for r in rows if r[0] not in (None, 906)])).collect()], tokenizer) >= 0
    check(rows, packing.packed(docs_df(spark, rows)).collect(), tokenizer)
    assert packing.packed(docs_df(spark, [])).count() == 0


def test_neighbours_are_bm25(tokenizer):
    enc = packing.encoder(packing.VOCABULARY)
    starts = enc.word_starts()
    texts = [" ".join(f"topic{i % 3}{w}" for w in prose(i, 30, 12).split()) for i in range(30)]
    tails = [packing.Tail(i, 0, 9, np.frombuffer(enc.ids(" " + t), "<u2"), starts) for i, t in enumerate(texts)]
    df = np.zeros(packing.BUCKETS)
    for t in tails:
        df[t.terms] += 1
    idf = np.log(1 + (len(tails) - df + 0.5) / (df + 0.5))
    mean = np.mean([t.words for t in tails])
    index = packing.Index(tails, idf, mean)
    unused = np.ones(len(tails), bool)
    unused[[0, 5]] = False
    got = index.neighbours(tails[0], unused).tolist()
    query = [w for w in tails[0].terms[np.argsort(-idf[tails[0].terms], kind="stable")] if df[w] > 1][:packing.QUERY_TERMS]
    score = []
    for i, t in enumerate(tails):
        tf = dict(zip(t.terms.tolist(), t.tf.tolist()))
        s = sum(idf[w] * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * t.words / mean)) for w in query if w in tf)
        if s > 0 and unused[i]:
            score.append((-round(s, 9), i))
    assert got == [i for _, i in sorted(score)]
    assert {i % 3 for i in got[:5]} == {0}


def test_all_words_and_all_neighbours_count(tokenizer):
    enc = packing.encoder(packing.VOCABULARY)
    starts = enc.word_starts()
    # short tails, far more than a window's, and seeds of many words
    texts = [prose(i, 60 if i % 10 == 0 else 9, 150) for i in range(400)]
    tails = [packing.Tail(i, 0, 9, np.frombuffer(enc.ids(" " + t), "<u2"), starts) for i, t in enumerate(texts)]
    df = np.zeros(packing.BUCKETS)
    for t in tails:
        df[t.terms] += 1
    idf = np.log(1 + (len(tails) - df + 0.5) / (df + 0.5))
    mean = np.mean([t.words for t in tails])
    index = packing.Index(tails, idf, mean)
    for q in (0, 10, 33):
        score = np.zeros(len(tails))
        for i, t in enumerate(tails):
            tf = dict(zip(t.terms.tolist(), t.tf.tolist()))
            score[i] = sum(idf[w] * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * t.words / mean))
                           for w in tails[q].terms.tolist() if w in tf)
        score[q] = 0
        unused = np.arange(len(tails)) != q
        want = [i for _, i in sorted((-round(x, 9), i) for i, x in enumerate(score.tolist()) if x > 0)]
        assert index.neighbours(tails[q], unused).tolist() == want
        assert q == 33 or len(want) > 64


def test_shards_carry_on(monkeypatch, spark, tokenizer):
    monkeypatch.setattr(packing, "SHARD", 7)
    enc = packing.encoder(packing.VOCABULARY)
    starts = enc.word_starts()
    tails = [packing.Tail(i, 0, 9, np.arange(300 + i) % 50000, starts) for i in range(20)]
    windows, rest = packing.pack_shard(tails, np.ones(packing.BUCKETS), 100.0)
    assert all(sum(len(p[2]) for p in w) == packing.WINDOW for w in windows)
    assert sum(len(p[2]) for w in [*windows, rest] for p in w) == sum(len(t.ids) for t in tails)
