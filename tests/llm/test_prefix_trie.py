"""The prefix trie against a plain dictionary of prefixes."""

from __future__ import annotations

import random
import zlib
from hashlib import md5, sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellsmith.llm import prefix_trie
from cellsmith.llm.prefix_trie import Parentheses

CONV = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            by.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    return {c: [x[3:] for x in sorted(v, key=lambda x: x[:3])] for c, v in by.items()}


def rebuilt(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = seqs.get(family, [])[:h] + own[h:]
    return out


def plain(seqs):
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        mine = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in mine) or 1
        saved[p] = sum(saved[k] for k in mine) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(seqs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p],
                    saved[p], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, CONV).withColumn("path", F.lit("x")).withColumn("depth", F.lit(1))
    got = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(df)), **options)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == plain(rebuilt(sequences(rows)))


def chats(seed, n, words=3, most=7):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "bot"]), "abcdefgh"[r.randrange(words)] * r.randrange(1, 5))
            for c in range(n) for t in range(r.randrange(1, most))]


def test_random_conversations(spark):
    check(spark, chats(1, 700))


def test_small_shards_share_spines(spark):
    """Many shards: prefixes that most conversations share are nodes of many spines."""
    rows = [(c, t, "user", "hello" if t < 3 or c % 3 else f"{c % 50}") for c in range(300) for t in range(6)]
    check(spark, rows, shard=8, least=4)
    check(spark, chats(2, 400, 2), shard=5, least=6)


def test_long_hot_and_turnless_conversations(spark):
    rows = [(1000 + i, t, "user", "same") for i in range(300) for t in range(2)]  # a third are copies
    rows += [(5, t, "user", f"turn {t}") for t in range(3000)]
    rows += [(c, 0, "user", "only") for c in range(2001, 2080)]  # no first conversation: some end at the root
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, None, "user", ""), (1, 0, "user", "naïve \U0001f600"),
            (1, 0, "user", "naïve \U0001f600"), (1, 0, "a", "tie"), (-101, 0, "user", "x"), (-100, 0, "user", "y"),
            (100, 0, "user", "x" * 100_000), (101, 1, "u", "1:"), (102, 1, "u1", ":")]
    check(spark, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], CONV)
    got = prefix_trie.prefix_trie(df)
    assert got.columns == COLUMNS and got.count() == 0


@pytest.mark.parametrize("n,seed", [(1, 0), (5, 1), (200, 2), (3000, 3), (20000, 4)])
def test_findclose_is_the_matching_parenthesis(n, seed):
    r = random.Random(seed)
    bits, depth, left = [True], 1, n - 1
    while depth:
        if left and (depth == 1 or r.random() < 0.55):
            bits.append(True)
            depth, left = depth + 1, left - 1
        else:
            bits.append(False)
            depth -= 1
    stack, match = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            match[stack.pop()] = i
    p = Parentheses(np.array(bits))
    opens = np.flatnonzero(p.bits)
    assert p.findclose(opens).tolist() == [match[i] for i in opens]
    pairs = [i for i in range(len(bits) - 1) if bits[i] and not bits[i + 1]]
    assert p.pairs[len(bits)] == len(pairs) and p.pairs[pairs[-1]] == len(pairs) - 1
