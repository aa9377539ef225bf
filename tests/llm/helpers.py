"""Fixtures shared by the operators' tests."""

from __future__ import annotations

import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_df(spark, rows):
    """rows: (doc_id, text[, source[, lang]])."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s",
             len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(text):
    return (text or "").encode().lower().split()


def fold(doc_id, m):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m


def prose(seed, n, vocabulary=400):
    """``n`` invented words that depend on ``seed`` alone."""
    import random
    r = random.Random(seed)
    return " ".join("w" + "abcdefghij"[k % 10] + str(k) for k in (r.randrange(vocabulary) for _ in range(n)))


#: Rows that every operator must live with.
ODD = [(None, None, None, None), (None, "", None, None), (900, None, None, None), (901, "", "s", "en"),
       (902, " \n\t ", "s", "en"), (903, "short", "s", None), (904, "x" * 300_000, "s", "en"),
       (905, "naïve été \U0001f600 1 2 3", "t", "fr"), (906, "same row", "s", "en"), (906, "same row", "s", "en")]


def shingles(text, n=5):
    w = words(text)
    if len(w) >= n:
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    return {tuple(w)} if w else set()


def near_components(rows, percent=75):
    """Smallest id of each row's component, by comparing all that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in sets.items():
        common = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def dedup_lines_plain(rows, window=3):
    """rows: (id, text) in order; the texts without windows that occurred before."""
    seen, out = {}, {}
    for i, t in sorted(rows):
        lines = t.split("\n") if t is not None else []
        filled = [k for k, x in enumerate(lines) if x.strip(" \t\n\r\x0b\x0c")]
        gone = set()
        for p in range(len(filled) - window + 1):
            key = tuple(lines[k] for k in filled[p:p + window])
            if key in seen and seen[key] != (i, p):
                gone.update(range(filled[p], filled[p + window - 1] + 1))
            seen.setdefault(key, (i, p))
        out[i] = t if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def levels_plain(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets of sources by repeated sharing out; sizes: {source or None: words}."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_ = share * sum(sizes.values()), set(order)
    target = dict.fromkeys(order, 0.0)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level >= most * sizes[s]}
        if not over:
            return target | {s: w[s] * level for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target
