"""Manifest and proofs against a plain tree per language."""

from __future__ import annotations

from hashlib import sha256

import pytest

from cellsmith.llm import merkle

from tests.llm.helpers import ODD, docs_df, fold


def _h(text):
    return sha256(text.encode()).hexdigest()


def _leaf(values):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def _way(levels, i):
    way = []
    for level in levels[:-1]:
        a = i - i % 8
        way.append(("".join(level[a:i]), "".join(level[i + 1:a + 8])))
        i //= 8
    return way


def plain(rows):
    """rows: (doc_id, source, lang, n_chars, text); the manifest of them as sorted tuples."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by_lang = {}
    for r in rows:
        forged = _leaf((*r[:4], r[4] and r[4].translate(lower))) if fold(r[0], 3) == 0 else None
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, _leaf(r), forged))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3])
        trees[lang] = _levels([x[2] for x in by_lang[lang]])
    over = _levels([trees[lang][-1][0] for lang in langs]) if langs else []
    out = []
    for k, lang in enumerate(langs):
        for i, (known, doc_id, leaf, forged) in enumerate(by_lang[lang]):
            way = _way(trees[lang], i) + _way(over, k)
            at = forged or leaf
            for b, a in way:
                at = _h(b + at + a)
            root = over[-1][0]
            out.append((doc_id if known else None, leaf, trees[lang][-1][0], root,
                        _h("".join(b + a for b, a in way)), at, at == root))
    return sorted(out, key=str)


def check(spark, rows, **options):
    df = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "x", 7) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, tree string, pos int")
    got = merkle.audit(df.repartition(5), **options)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65])
def test_one_language(spark, n):
    check(spark, [(i * 3, "s", "en", i, f"Text {i}") for i in range(n)])


def test_many_languages_nulls_and_repeated_rows(spark):
    rows = [(i, "s", ["de", "en", "éa", "z", None, ""][i % 6], i, "A" * (i % 4) + "b") for i in range(40)]
    rows += [(i, None, f"l{i:02}", None, None) for i in range(100, 112)]
    rows += [(None, None, None, None, None), (None, "s", "en", 1, "Same"), (None, "s", "en", 1, "Same"),
             (7, "s", "en", 1, "Other text of the id"), (7, "s", "en", 1, "Other text of the id"), (2 ** 62, "", "en", 0, "")]
    check(spark, rows)


def test_superblocks_below_superblocks(spark):
    """Superblocks of one and two levels: several rounds up and down, for languages as well."""
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(600)] + [(i, "s", f"l{i}", i, "T") for i in range(600, 620)]
    check(spark, rows, height=1)
    check(spark, rows, height=2)


def test_odd_rows_and_empty_table(spark):
    docs = docs_df(spark, ODD)
    assert merkle.audit(docs).count() == len(ODD)
    assert merkle.audit(docs.where("false")).count() == 0


def test_changed_text_is_found_and_clean_rows_verify(spark):
    rows = [(i, "s", "en", i, "Upper" if i % 2 else "lower") for i in range(64)]
    df = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for r in merkle.audit(df).collect():
        assert r.verified == (fold(r.doc_id, 3) != 0 or r.doc_id % 2 == 0)
