"""Prefix trie of conversations in balanced parentheses.

A conversation is the sequence of its turns; equal sequences are one path with a
count. The paths are sorted over all machines (a turn is 16 bytes of its hash, so the
order of the bytes is the order of the turns), and every stretch of about ``SHARD``
nodes of a partition is a shard: a trie of its own, written as balanced parentheses in
depth-first order. The excess of the parentheses is kept in blocks with a tree of
their minima (range min-max), which finds the closing parenthesis of every node; it
delimits the subtree. Counts of ``()`` pairs up to a place give the leaves of a
subtree, cumulative arrays over the nodes its members and savings.

Only nodes on a shard's first and last path, its spine, can occur in other shards.
All others are final and leave the shard. A spine's nodes leave with what hangs on
them inside the shard; sorted again, the spines are paths of a smaller trie, which is
solved in the same way, until one shard holds them all. So a prefix that a third of
all conversations share is a node of many spines and of no large group.

Bounds: a shard holds ``SHARD`` nodes or, with longer paths, ``LEAST`` paths. A single
conversation is one row (20 bytes a turn). The ids that end at one node are hashed in order by one
task as a stream, as SHA-256 of one text is a chain; it holds a batch of them.

Defined cases: turns are ordered by turn (null first), then by the hash of role and
text; null role or text is empty; rows without a conversation id belong to no
conversation and are left out; repeated rows are turns of their own; without rows
the result is empty; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import cut, partitions

#: Nodes of a shard, and the least number of paths of one (4 or more, as a shard leaves two spines).
SHARD = 1 << 19
LEAST = 64
#: Bytes of a turn in a path.
WIDTH = 16
#: Conversations that share opening turns are numbered in blocks of so many; most turns that are shared.
FAMILY, HEADS = 100, 6
_NONE = np.iinfo(np.int64).max
_EMPTY = sha256(b"").hexdigest()


class Parentheses:
    """Balanced parentheses (True opens) with a range min tree over blocks of the excess."""

    BLOCK = 64

    def __init__(self, bits: np.ndarray):
        self.bits, n = bits, len(bits)
        self.excess = np.cumsum(np.where(bits, 1, -1))
        blocks = -(-n // self.BLOCK)
        self.first = 1 << max(blocks - 1, 0).bit_length()
        far = np.iinfo(np.int64).max
        padded = np.full(blocks * self.BLOCK, far)
        padded[:n] = self.excess
        self.least = np.full(2 * self.first, far)
        self.least[self.first:self.first + blocks] = padded.reshape(blocks, self.BLOCK).min(1)
        lo = self.first
        while lo > 1:
            self.least[lo // 2:lo] = self.least[lo:2 * lo].reshape(-1, 2).min(1)
            lo //= 2
        self.pairs = np.zeros(n + 1, np.int64)  # () pairs that open before a place
        self.pairs[1:-1] = np.cumsum(bits[:-1] & ~bits[1:])
        self.pairs[-1] = self.pairs[-2] if n else 0

    def _scan(self, at: np.ndarray, goal: np.ndarray, end: np.ndarray) -> np.ndarray:
        """First place from ``at`` and before ``end`` with the excess ``goal``, else ``end``."""
        at = at.copy()
        open_ = np.flatnonzero(at < end)
        while len(open_):
            open_ = open_[self.excess[at[open_]] != goal[open_]]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        return at

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Place of the closing parenthesis of each opening one."""
        goal = self.excess[opens] - 1
        end = np.minimum((opens // self.BLOCK + 1) * self.BLOCK, len(self.bits))
        out = self._scan(opens + 1, goal, end)
        far = np.flatnonzero(out == end)
        if not len(far):
            return out
        x, g = self.first + end[far] // self.BLOCK, goal[far]
        up = np.flatnonzero(self.least[x] > g)
        while len(up):  # to the next block, or the next group of blocks, on the right
            x[up] = np.where(x[up] & 1, (x[up] + 1) >> 1, x[up] + 1)
            up = up[self.least[x[up]] > g[up]]
        down = np.flatnonzero(x < self.first)
        while len(down):
            left = 2 * x[down]
            x[down] = np.where(self.least[left] <= g[down], left, left + 1)
            down = down[x[down] < self.first]
        at = (x - self.first) * self.BLOCK
        out[far] = self._scan(at, g, np.minimum(at + self.BLOCK, len(self.bits)))
        return out


#: What hangs on each node of a path by itself: members, the smallest one, children, leaves, savings,
#: and how many conversations end there.
_OWN = ["members", "low", "kids", "leaves", "saved", "stops"]
_SPINE = "path binary, chars array<int>, " + ", ".join(f"{c} array<long>" for c in _OWN)
_NODE = ("conv_id long, depth long, key binary, parent_key binary, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ended long, spine boolean")
_ROW = _NODE + ", " + _SPINE
_LONGS = pa.list_(pa.int64())
_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ended", pa.int64()), ("spine", pa.bool_()), ("path", pa.binary()),
    ("chars", pa.list_(pa.int32())), *[(c, _LONGS) for c in _OWN]])


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their start."""
    n = min(len(a), len(b)) // WIDTH
    if a[:n * WIDTH] == b[:n * WIDTH]:
        return n
    lo, step = 0, 1
    while a[:(lo + step) * WIDTH] == b[:(lo + step) * WIDTH]:
        lo, step = lo + step, 2 * step
    while step > 1:  # equal up to lo, not up to lo + step
        step //= 2
        if a[:(lo + step) * WIDTH] == b[:(lo + step) * WIDTH]:
            lo += step
    return lo


class Shard:
    """The trie of sorted distinct paths, each with the values that hang on its nodes."""

    def __init__(self, paths: list[bytes], chars: list[np.ndarray], own: dict[str, list[np.ndarray]], dense: bool):
        """``own[c][i]`` has a value for every depth of path ``i`` if ``dense``, else for its end alone."""
        self.paths = paths
        depth = np.array([len(p) // WIDTH for p in paths])
        lcp = np.array([-1] + [_shared(a, b) for a, b in zip(paths, paths[1:], strict=False)])
        new = depth - lcp
        start = np.concatenate([[0], np.cumsum(new)])
        n = int(start[-1])
        self.record = np.repeat(np.arange(len(paths)), new)
        self.depth = np.arange(n) - np.repeat(start[:-1] - lcp - 1, new)
        runs = np.empty(2 * len(paths) + 1, np.int64)
        runs[0], runs[1::2], runs[2:-1:2], runs[-1] = 0, new, depth[:-1] - lcp[1:], depth[-1] + 1
        self.trie = Parentheses(np.repeat(np.arange(len(runs)) % 2 == 1, runs))

        at = np.concatenate([[0], np.cumsum(depth)])
        lengths = np.concatenate([*chars, [0]]).astype(np.int64)
        self.chars = np.where(self.depth > 0, lengths[at[self.record] + self.depth - 1], 0)
        self.parent = np.arange(n) - 1
        values = {c: np.full(n, _NONE if c == "low" else 0) for c in _OWN}
        stack: list[int] = []
        ends = start[1:] - 1
        for i, (k, a, b) in enumerate(zip(lcp.tolist(), start.tolist(), start[1:].tolist(), strict=False)):
            del stack[k + 1:]
            if k >= 0:
                self.parent[a] = stack[k]
            stack.extend(range(a, b))
            if i == 0:
                first = list(stack)
            if dense:
                nodes = np.array(stack)
                for c in _OWN:
                    put = np.minimum if c == "low" else np.add
                    values[c][nodes] = put(values[c][nodes], own[c][i])
        if not dense:
            for c in _OWN:
                values[c][ends] = np.array([x[0] for x in own[c]])
        self.own, self.first, self.last = values, first, stack

    def solve(self, final: bool):
        """Per node: members, low, children, leaves, savings of its subtree, and whether it is on the
        spine; for nodes of the spine the first five are only what hangs on them in this shard."""
        own, n = self.own, len(self.parent)
        opens = np.flatnonzero(self.trie.bits)
        closes = self.trie.findclose(opens)
        end = np.arange(n) + (closes - opens + 1) // 2
        spine = np.zeros(n, bool)
        if not final:
            spine[self.first] = spine[self.last] = True

        def below(x: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(x)])
            return total[end] - total[:-1]

        members = below(own["members"])
        pairs = self.trie.pairs[closes] - self.trie.pairs[opens]
        # () pairs of nodes with children outside the shard are no leaves
        false = self.trie.bits[opens] & ~self.trie.bits[np.minimum(opens + 1, len(self.trie.bits) - 1)] & (own["kids"] > 0)
        leaves = pairs - below(false) + below(own["leaves"])
        saved = below(np.where(spine, 0, (members - 1) * self.chars) + own["saved"])
        low = own["low"].copy()
        by_depth = np.argsort(-self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[by_depth])) + 1
        for level in np.split(by_depth, cuts):
            level = level[self.parent[level] >= 0]
            np.minimum.at(low, self.parent[level], low[level])
        inner = np.flatnonzero(self.parent >= 0)
        kids = own["kids"] + np.bincount(self.parent[inner], minlength=n)
        out = {"members": members, "low": low, "kids": kids, "leaves": leaves, "saved": saved}
        if not final:  # the spine keeps its own values and those of the children that are not of it
            hang = inner[~spine[inner] & spine[self.parent[inner]]]
            up = self.parent[hang]
            kept = {c: own[c].copy() for c in _OWN}
            for c in ("members", "leaves", "saved"):
                np.add.at(kept[c], up, out[c][hang])
            np.add.at(kept["kids"], up, 1)
            np.minimum.at(kept["low"], up, low[hang])
            for c in out:
                out[c] = np.where(spine, kept[c], out[c])
        return out, spine

    def rows(self, final: bool, of_spines: bool) -> Iterator[pa.RecordBatch]:
        """Final nodes, and the spine's paths with what hangs on them."""
        out, spine = self.solve(final)
        done = np.flatnonzero(~spine)
        parent = self.parent[done]
        outer = (parent >= 0) & spine[np.maximum(parent, 0)]
        keyed = (self.own["stops"][done] > 0) | of_spines
        prefix = lambda v, less: md5(self.paths[self.record[v]][:WIDTH * (self.depth[v] - less)]).digest()
        columns = {
            "conv_id": pa.array(out["low"][done]), "depth": pa.array(self.depth[done].astype(np.int64)),
            "key": pa.array([prefix(v, 0) if k else None for v, k in zip(done, keyed, strict=True)], pa.binary()),
            "parent_key": pa.array([prefix(v, 1) if o else None for v, o in zip(done, outer, strict=True)], pa.binary()),
            "parent_conv_id": pa.array(out["low"][np.maximum(parent, 0)], mask=(parent < 0) | outer),
            "n_convs": pa.array(out["members"][done]), "n_children": pa.array(out["kids"][done]),
            "n_leaves": pa.array(out["leaves"][done]), "saved_tokens": pa.array(out["saved"][done]),
            "ended": pa.array(self.own["stops"][done]), "spine": pa.array(np.full(len(done), of_spines))}
        yield from _filled(columns, len(done))
        if final:
            return
        # nodes that both paths share go with the first one
        both = len(set(self.first) & set(self.last))
        ends = [(0, self.first, 0)] + ([(len(self.paths) - 1, self.last, both)] if len(self.paths) > 1 else [])
        lists = {c: [] for c in _OWN}
        for _, nodes, skip in ends:
            for c in _OWN:
                x = (out[c] if c in out else self.own[c])[nodes].copy()
                x[:skip] = _NONE if c == "low" else 0
                lists[c].append(x.tolist())
        yield from _filled({
            "path": pa.array([self.paths[i] for i, _, _ in ends], pa.binary()),
            "chars": pa.array([self.chars[nodes[1:]].tolist() for _, nodes, _ in ends], pa.list_(pa.int32())),
            **{c: pa.array(lists[c], _LONGS) for c in _OWN}}, len(ends))


def _filled(columns: dict, n: int) -> Iterator[pa.RecordBatch]:
    if n:
        yield pa.RecordBatch.from_arrays(
            [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _lists(array: pa.Array) -> list[np.ndarray]:
    at = array.offsets.to_numpy()
    flat = array.values.to_numpy()
    return [flat[a:b] for a, b in zip(at, at[1:], strict=False)]


def _solve(final: bool, of_spines: bool, shard: int, least: int):
    """The shards of a partition's sorted paths, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, chars, own, nodes = [], [], {c: [] for c in _OWN}, 0
        for b in batches:
            found, lengths = b["path"].to_pylist(), _lists(b["chars"])
            if of_spines:
                values = {c: _lists(b[c]) for c in _OWN}
            else:
                n = b["n"].to_numpy().reshape(-1, 1)
                none = np.zeros_like(n)
                values = {"members": n, "low": b["low"].to_numpy().reshape(-1, 1), "kids": none, "leaves": none,
                          "saved": none, "stops": n}
            for i, p in enumerate(found):
                paths.append(p)
                chars.append(lengths[i])
                for c in _OWN:
                    own[c].append(values[c][i])
                nodes += len(p) // WIDTH + 1
                if not final and nodes >= shard and len(paths) >= least:
                    yield from Shard(paths, chars, own, of_spines).rows(final, of_spines)
                    paths, chars, own, nodes = [], [], {c: [] for c in _OWN}, 0
        if paths:
            yield from Shard(paths, chars, own, of_spines).rows(final, of_spines)

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's ids, comma-joined, of rows sorted by key and id."""
    open_, digest = None, None
    for b in batches:
        keys = np.array(b["key"].to_pylist(), object)
        ids = [str(x) for x in b["conv_id"].to_pylist()]
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]) if len(keys) else [0]
        done = []
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if keys[a] == open_:
                digest.update(b",")
            else:
                if open_ is not None:
                    done.append((open_, digest.hexdigest()))
                open_, digest = keys[a], sha256()
            digest.update(",".join(ids[a:z]).encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()),
                                              pa.array([d[1] for d in done])], ["key", "ends_sha256"])
    if open_ is not None:
        yield pa.RecordBatch.from_arrays([pa.array([open_], pa.binary()), pa.array([digest.hexdigest()])],
                                         ["key", "ends_sha256"])


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, t): the turns of every conversation in order, each as its hash and its length."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        digest.alias("digest"), F.length(text).alias("chars"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "chars"))).alias("t"))


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Every conversation with its first turns replaced by those of its family's first one:
    as many as the checksum of its id says."""
    heads = seqs.where(F.col("conv_id") % FAMILY == 0) \
        .select(F.col("conv_id").alias("family"), F.slice("t", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    own = seqs.select("conv_id", "t", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"))
    head = F.coalesce("head", F.slice("t", 1, 0))
    return own.join(heads, "family", "left").select(
        "conv_id", F.concat(F.slice(head, F.lit(1), F.col("h")),
                            F.slice("t", F.col("h") + 1, F.greatest(F.size("t"), F.lit(1)))).alias("t"))


def trie(seqs: DataFrame, *, shard: int = SHARD, least: int = LEAST) -> DataFrame:
    """The nodes of the prefix trie of ``seqs`` (conv_id, t): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = seqs.sparkSession
    path = F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["digest"])), ""))
    rows = cut(seqs.select("conv_id", path.alias("path"), F.col("t.chars").alias("chars")), "sequences")

    paths = rows.groupBy("path", "chars").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"))
    ordered = paths.repartitionByRange(partitions(spark), "path").sortWithinPartitions("path")
    solved = [cut(ordered.mapInArrow(_solve(False, False, shard, least), _ROW), "shards")]
    while True:
        spines = solved[-1].where("path is not null").select("path", "chars", *_OWN)
        n, nodes = spines.agg(F.count(F.lit(1)), F.sum(F.size("chars") + 1)).first()
        final = n <= 2 * least or nodes <= shard
        parts = 1 if final else min(partitions(spark), -(-n // (2 * least)))
        ordered = spines.repartitionByRange(parts, "path").sortWithinPartitions("path") if parts > 1 \
            else spines.repartition(1).sortWithinPartitions("path")
        solved.append(cut(ordered.mapInArrow(_solve(final, True, shard, least), _ROW), "spines"))
        if final:
            break

    names = _NODE.replace(",", "").split()[::2]
    nodes = solved[0]
    for x in solved[1:]:
        nodes = nodes.unionByName(x)
    nodes = nodes.where("path is null").select(names)
    known = nodes.where("spine").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("p"))
    hanging = nodes.where("parent_key is not null").drop("parent_conv_id").join(known, "parent_key") \
        .withColumnRenamed("p", "parent_conv_id")
    nodes = cut(nodes.where("parent_key is null").unionByName(hanging).drop("parent_key", "spine"), "nodes")

    ends = rows.select(F.unhex(F.md5("path")).alias("key"), "conv_id") \
        .repartition(partitions(spark), "key").sortWithinPartitions("key", "conv_id") \
        .mapInArrow(_ends, "key binary, ends_sha256 string")
    out = nodes.where("ended > 0").join(ends, "key").unionByName(
        nodes.where("ended = 0").withColumn("ends_sha256", F.lit(_EMPTY)))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      "ends_sha256")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(cut(sequences(conversations), "turns")))
