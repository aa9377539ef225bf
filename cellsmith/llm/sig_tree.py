"""Exact Jaccard join of documents by word n-grams, with signature trees.

A document is the set of its distinct 5-word shingles; documents with equal sets are a
class, and everything after works on classes. Blocks of classes that share shingles
are joined by signature trees: the leaves hold a bitmap of the class's shingles that
occur twice in the block and its size, a node the OR of its children's bitmaps and the
range of their sizes. Two trees (or one with itself) are traversed together; a pair of
nodes goes when the sizes cannot meet, or when the shingles in both bitmaps, the
largest overlap any pair below can have, are too few. At the leaves that count is the
overlap itself, so what is left is exact.

Blocks come from a prefix order. Shingles are ordered by (frequent, hash); two sets of
the threshold share one of their first ``n - ceil(percent * n / 100) + 1``, whatever the
order is. Frequent are those of more than ``FREQUENT`` documents, exact counts over all
documents, kept as one bit each in a filter of fixed size (``BITS``; a wrong bit changes
the order for all alike and no result), so common passages do not bring documents
together unless these consist of them. Only shingles in the lower half of the hashes
are counted; the upper half stands with the frequent ones.

1. Each class goes to the class that leads most of its shingles' groups (the one whose
   other shingles are least rare); the followers of a leader, dealt over chunks, are
   blocks, in which a class occurs once. Most copies are linked here, a comparison each.
2. In every group of an infrequent shingle that is not in one component yet (groups of
   the same classes count once), hashed bitmaps of two bits a shingle bound the overlap
   of each two classes apart; pairs that may be of the threshold are blocks. The groups
   of frequent shingles are united to families; a family's classes are dealt over
   chunks, and every two chunks that are not of one component are a block of two trees.

Together these hold every pair that the threshold allows and that is not connected
already. So a large group of copies costs a comparison a member; what can grow
with the square of a family is the traversal between classes that stay apart.

Defined cases: null and empty texts have an empty set and link with nothing; rows
that repeat a document id are one document; a null id never names a component
unless all its ids are null; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cellsmith.llm.common import cut, mix64, partitions, stream64
from cellsmith.llm.graph import components
from cellsmith.llm.near_dup import shingle_sets

PERCENT = 80
#: Documents from which a shingle is frequent.
FREQUENT = 64
#: Bits of the filter of frequent shingles, and the most of them that it holds; where there are
#: more, the number from which a shingle is frequent doubles.
BITS, MOST_FREQUENT = 1 << 27, 1 << 23
#: Shingles and classes of a chunk.
CHUNK, CHUNK_ROWS = 1 << 18, 2048
#: Children of a node of the signature tree.
FAN = 8
_SLICE = 500
_U = np.uint64
_HALF = _U(1 << 63)
#: Hashes that are sent on at a time by the count.
_FLUSH = 1 << 21


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, _SLICE):
            yield b.slice(k, _SLICE)


# --- classes of equal sets -----------------------------------------------------------------

def _sets(array: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Shingles, offsets, and each set's 128-bit name (null for an empty set)."""
    sets, at = shingle_sets(array)
    size = np.diff(at)
    names = np.full(len(size), None, object)
    full = np.flatnonzero(size)
    if len(full):
        sums = [np.add.reduceat(mix64(sets ^ c), at[:-1][full]) for c in stream64(2, 23)]
        names[full] = [x.tobytes() for x in np.stack(sums, 1)]
    return sets, at, pa.array(names, pa.binary())


def _hashed_bits(x: np.ndarray) -> bytes:
    """Bitmap of a set of shingles: a power of two of bits, two a shingle or more."""
    width = max(64, 1 << (2 * len(x) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(x % _U(width)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _slices(batches):
        sets, at, names = _sets(b["text"])
        bits = [_hashed_bits(sets[i:j]) if i < j else None for i, j in zip(at, at[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([b["doc_id"], b["th"], pa.array(np.diff(at)), names, pa.array(bits, pa.binary())],
                                         ["doc_id", "th", "n", "fp", "bits"])


# --- frequent shingles ----------------------------------------------------------------------

def _dealt(buckets: int):
    """The counted half of the shingles, 48 bits each, as a text of bytes for each bucket."""

    def send(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        x = np.sort(np.concatenate(parts) >> _U(16))
        cuts = np.searchsorted(x, (np.arange(buckets + 1) * ((1 << 47) / buckets)).astype(np.uint64))
        raw = x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
        some = np.flatnonzero(np.diff(cuts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array([raw[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary())],
            ["bucket", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for b in _slices(batches):
            sets, _ = shingle_sets(b["text"])
            parts.append(sets[sets < _HALF])
            n += len(parts[-1])
            if n >= _FLUSH:
                yield from send(parts)
                parts, n = [], 0
        if n:
            yield from send(parts)

    return run


def _tokens(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(">u8").astype(np.uint64)


def _frequent(least: int):
    """Tokens of more than ``least`` documents, of rows sorted by bucket."""

    def of(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        x, n = np.unique(np.concatenate([_tokens(p) for p in parts]), return_counts=True)
        keep = n > least
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[keep].astype(np.int64)), pa.array(n[keep])], ["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []
        for b in batches:
            for k, raw in zip(b["bucket"].to_pylist(), b["tokens"].to_pylist(), strict=True):
                if k != bucket and parts:
                    yield from of(parts)
                    parts = []
                bucket = k
                parts.append(raw)
        if parts:
            yield from of(parts)

    return run


def frequent_bits(texts: DataFrame) -> np.ndarray:
    """The filter: bit ``token % BITS`` of every frequent shingle. What reaches the driver is
    ``MOST_FREQUENT`` numbers at most, whatever the number of documents."""
    n = partitions(texts.sparkSession)
    counts = cut(texts.mapInArrow(_dealt(16 * n), "bucket long, tokens binary")
                 .repartition(n, "bucket").sortWithinPartitions("bucket")
                 .mapInArrow(_frequent(FREQUENT), "token long, n long"), "frequent")
    least = FREQUENT
    by_size = counts.groupBy(F.floor(F.log2("n")).alias("k")).agg(F.count(F.lit(1)).alias("c")).collect()
    while sum(r["c"] for r in by_size if 2 ** (r["k"] + 1) > least) > MOST_FREQUENT:
        least *= 2
    bits = np.zeros(BITS // 8, np.uint8)
    at = counts.where(F.col("n") > least).select(F.pmod("token", F.lit(BITS)).cast("int").alias("at")).distinct().toArrow()
    at = at["at"].to_numpy()
    np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
    return bits


# --- prefixes -------------------------------------------------------------------------------

def _prefixes(shared, percent: int):
    """Per set the first shingles of its order, and how many of them are not frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for b in _slices(batches):
            sets, at, names = _sets(b["text"])
            place = ((sets >> _U(16)) % _U(BITS)).astype(np.int64)
            late = (sets >= _HALF) | (bits[place >> 3] >> (place & 7) & 1).astype(bool)
            size = np.diff(at)
            kept, cold = [], np.zeros(len(size), np.int32)
            for i in range(len(size)):
                x, y = sets[at[i]:at[i + 1]], late[at[i]:at[i + 1]]
                k = len(x) - -(-percent * len(x) // 100) + 1 if len(x) else 0
                early = x[~y][:k]
                cold[i] = len(early)
                kept.append(np.concatenate([early, x[y][:k - len(early)]]))
            flat = np.concatenate(kept).view(np.int64) if kept else np.zeros(0, np.int64)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in kept])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [names, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(cold)],
                ["fp", "tokens", "cold"]).filter(pa.array(size > 0))

    return run


def postings(texts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(token, late, cid, n, lead): the prefixes' shingles that more than one class may have; lead is
    the class of the group whose other shingles are least rare."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(frequent_bits(texts))
    heads = texts.mapInArrow(_prefixes(shared, percent), "fp binary, tokens array<long>, cold int") \
        .groupBy("fp").agg(F.first(F.struct("tokens", "cold")).alias("x"))
    rows = heads.join(classes.select("fp", "cid", "n"), "fp") \
        .select("cid", "n", F.col("x.cold").alias("cold"), F.posexplode("x.tokens").alias("pos", "token"))
    # the groups of frequent shingles are dealt over salts, and led by the least of the salts' leaders
    salt = F.when(F.col("pos") >= F.col("cold"), F.pmod(F.xxhash64("cid"), F.lit(partitions(spark))) + 1).otherwise(0)
    place = F.shiftleft(F.col("pos").cast("long"), 40) + F.col("n")  # by place, then by size
    rows = rows.select("token", "cid", place.alias("place"), salt.alias("salt"))
    group = Window.partitionBy("token", "salt")
    found = rows.select("token", (F.col("salt") > 0).alias("late"), "cid", (F.col("place") % (1 << 40)).alias("n"),
                        F.count(F.lit(1)).over(group).alias("k"), F.min(F.struct("place", "cid")).over(group).alias("lead"))
    found = cut(found.where("late or k > 1").select("token", "late", "cid", "n", "lead"), "postings")
    early = found.where("not late").select("token", "late", "cid", "n", F.col("lead.cid").alias("lead"))
    late = found.where("late")
    leads = late.groupBy("token").agg(F.min("lead").alias("first"), F.min("cid").alias("lo"), F.max("cid").alias("hi")) \
        .where("lo < hi").select("token", F.col("first.cid").alias("first"))
    late = late.join(leads, "token").select("token", "late", "cid", "n", F.col("first").alias("lead"))
    return cut(early.unionByName(late), "shared")


# --- signature trees ------------------------------------------------------------------------

class SignatureTree:
    """Levels of nodes over rows sorted by size: OR of the bitmaps, least and greatest size."""

    def __init__(self, bits: np.ndarray, size: np.ndarray):
        self.bits, self.least, self.most = [bits], [size], [size]
        while len(self.bits[-1]) > FAN:
            cuts = np.arange(0, len(self.bits[-1]), FAN)
            self.bits.append(np.bitwise_or.reduceat(self.bits[-1], cuts, axis=0))
            self.least.append(np.minimum.reduceat(self.least[-1], cuts))
            self.most.append(np.maximum.reduceat(self.most[-1], cuts))

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index into ``nodes`` and child, one level down, for all children."""
        start = nodes * FAN
        n = np.minimum(start + FAN, len(self.least[level - 1])) - start
        at = np.repeat(np.arange(len(nodes)), n)
        return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)


def _overlap(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in both bitmaps of each pair."""
    out = np.empty(len(i), np.int64)
    step = max(1, (1 << 21) // max(x.shape[1], 1))
    for k in range(0, len(i), step):
        out[k:k + step] = np.bitwise_count(x[i[k:k + step]] & y[j[k:k + step]]).sum(1, dtype=np.int64)
    return out


class _Union:
    """Components of the rows of a block."""

    def __init__(self, comp: list):
        self.label = np.unique(np.array(comp), return_inverse=True)[1].ravel()

    def join(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Joins the rows ``i`` and ``j`` pairwise; which of the pairs joined two components."""
        used = np.zeros(len(i), bool)
        while True:
            open_ = np.flatnonzero(self.label[i] != self.label[j])
            if not len(open_):
                return used
            # one pair for each two components, and each component hung on one smaller one
            a, b = self.label[i[open_]], self.label[j[open_]]
            hi, lo = np.maximum(a, b), np.minimum(a, b)
            _, first = np.unique(hi, return_index=True)
            used[open_[first]] = True
            to = np.arange(self.label.max() + 1)
            to[hi[first]] = lo[first]
            while (to[to] != to).any():
                to = to[to]
            self.label = to[self.label]


def block_links(sets: list[np.ndarray], comp: list, side: list[int], percent: int) -> list[tuple[int, int]]:
    """Pairs of rows of the threshold that connect what is not connected; with rows of two
    sides, pairs between the sides alone."""
    size = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), size)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    twice = count > 1
    common = twice[token]
    # a pair's overlap is at least the percentage of the larger set
    may = 100 * np.bincount(row[common], minlength=len(sets)) >= percent * size
    order = np.flatnonzero(may)
    if len(order) < 2:
        return []
    order = order[np.lexsort((np.array([sets[i][0] for i in order], np.uint64), size[order]))]
    at = np.full(len(sets), -1)
    at[order] = np.arange(len(order))
    take = common & may[row]
    column = (np.cumsum(twice) - 1)[token[take]]
    bits = np.zeros((len(order), int(twice.sum()) // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (at[row[take]], column >> 6), _U(1) << (column & 63).astype(np.uint64))
    size, side = size[order], np.array(side)[order]
    union, links = _Union([comp[i] for i in order]), []
    two = side.min() != side.max()

    def confirm(i: np.ndarray, j: np.ndarray) -> None:
        apart = union.label[i] != union.label[j]
        i, j = i[apart], j[apart]
        both = _overlap(bits, bits, i, j)
        hit = 100 * both >= percent * (size[i] + size[j] - both)
        i, j = i[hit], j[hit]
        new = union.join(i, j)
        links.extend(zip(order[i[new]].tolist(), order[j[new]].tolist(), strict=True))

    # the rows with the most shingles in common with others first, each against all
    rank = np.argsort(-np.bitwise_count(bits).sum(1, dtype=np.int64) / size, kind="stable")
    for h in rank[:FAN]:
        others = np.flatnonzero(side != side[h]) if two else np.arange(len(order))
        confirm(np.full(len(others), h), others)
    if union.label.min() == union.label.max():
        return links
    sides = [np.flatnonzero(side == s) for s in np.unique(side)] if two else [np.arange(len(order))]
    trees = [SignatureTree(bits[s], size[s]) for s in sides]
    x, y = trees[0], trees[-1]
    level = max(len(x.bits), len(y.bits)) - 1
    up = lambda t, k: min(k, len(t.bits) - 1)
    i, j = (a.ravel() for a in np.meshgrid(np.arange(len(x.least[-1])), np.arange(len(y.least[-1])), indexing="ij"))
    if not two:
        i, j = i[i <= j], j[i <= j]
    while True:
        a, b = up(x, level), up(y, level)
        meet = 100 * np.minimum(x.most[a][i], y.most[b][j]) >= percent * np.maximum(x.least[a][i], y.least[b][j])
        i, j = i[meet], j[meet]
        if level == 0:
            step = 1 << 16
            for k in range(0, len(i), step):
                confirm(sides[0][i[k:k + step]], sides[-1][j[k:k + step]])
            return links
        most = np.minimum(_overlap(x.bits[a], y.bits[b], i, j), np.minimum(x.most[a][i], y.most[b][j]))
        keep = (100 + percent) * most >= percent * (x.least[a][i] + y.least[b][j])
        i, j = i[keep], j[keep]
        if a == level:
            k, i = x.children(level, i)
            j = j[k]
        if b == level:
            k, j = y.children(level, j)
            i = i[k]
        if not two:
            i, j = i[i <= j], j[i <= j]
        level -= 1


def _joined(percent: int):
    """The links (a, b) of every block of rows (block, part, side, cid, comp, text) sorted by block."""

    def of(rows: list[tuple]) -> list[tuple[int, int]]:
        first = {}
        for r in rows:
            first.setdefault(r[0], r)  # a class once
        rows = list(first.values())
        if len({r[1] for r in rows}) < 2:
            return []
        links = block_links([r[3] for r in rows], [r[1] for r in rows], [r[2] for r in rows], percent)
        return [(rows[i][0], rows[j][0]) for i, j in links]

    def out(found: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        if found:
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, found = None, [], []
        for b in _slices(batches):
            sets, at = shingle_sets(b["text"])
            columns = [b[c].to_pylist() for c in ("block", "part", "cid", "comp", "side")]
            for i, (k, p, cid, comp, side) in enumerate(zip(*columns, strict=True)):
                if (k, p) != block:
                    if len(rows) > 1:
                        found.extend(of(rows))
                    block, rows = (k, p), []
                rows.append((cid, comp, side, sets[at[i]:at[i + 1]].copy()))
            yield from out(found)
            found = []
        if len(rows) > 1:
            found.extend(of(rows))
        yield from out(found)

    return run


def _of_marked(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for b in batches:
            at = b["th"].to_numpy() % BITS
            yield b.filter(pa.array((bits[at >> 3] >> (at & 7) & 1).astype(bool)))

    return run


def marked(texts: DataFrame, hashes: DataFrame) -> DataFrame:
    """``texts`` without most of those whose hash is not in ``hashes`` (th): a filter of ``BITS`` bits, built
    where the hashes are, keeps texts that no block needs from being sent. A full filter keeps all."""
    at = hashes.select(F.pmod("th", F.lit(BITS)).alias("at"))
    words = at.groupBy(F.shiftright("at", 15).alias("k")).agg(
        F.bitmap_construct_agg(F.col("at") % (1 << 15)).alias("bits")).toArrow()  # BITS / 2 ** 15 rows at most
    bits = np.zeros((BITS >> 15, 1 << 12), np.uint8)
    for k, raw in zip(words["k"].to_pylist(), words["bits"].to_pylist(), strict=True):
        bits[k] = np.frombuffer(raw, np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(bits.ravel())
    return texts.mapInArrow(_of_marked(shared), texts.schema)


def joined(blocks: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links of the blocks (block, part, side, cid, comp): one text of each class is read where
    it stands and sent to the blocks."""
    m = cut(blocks.join(classes.select("cid", "rep.*"), "cid"), "members")
    texts = marked(texts, m)
    found = texts.join(m, texts["doc_id"].eqNullSafe(m["doc_id"]) & (texts["th"] == m["th"])) \
        .select("block", "part", "side", "cid", "comp", "text")
    found = found.repartition(partitions(texts.sparkSession), "block", "part").sortWithinPartitions("block", "part")
    return cut(found.mapInArrow(_joined(percent), "a long, b long"), "links")


# --- blocks ---------------------------------------------------------------------------------

def _in_chunks(members: DataFrame, by: list[str]) -> DataFrame:
    """``members`` (…, cid, n) with chunk and chunks, the number of chunks for each ``by``."""
    k = F.greatest(F.ceil(F.sum("n") / CHUNK), F.ceil(F.count(F.lit(1)) / CHUNK_ROWS)).alias("chunks")
    return members.join(members.groupBy(*by).agg(k), by).withColumn("chunk", F.pmod(F.xxhash64("cid"), "chunks"))


def hub_blocks(pairs: DataFrame) -> DataFrame:
    """Each ``block``'s classes (block, cid, n), dealt over chunks, with the class ``block`` in every chunk."""
    dealt = _in_chunks(pairs, ["block"])
    hubs = dealt.select("block", F.col("block").alias("cid"), F.col("chunk").alias("part")).distinct()
    rows = dealt.select("block", "cid", F.col("chunk").alias("part")).unionByName(hubs)
    return rows.select("block", "part", F.lit(0).alias("side"), "cid")


def leader_blocks(posts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Each class with the class that leads most of its groups, where their bitmaps allow the threshold."""
    votes = posts.where("cid != lead").groupBy("cid", "n", "lead").agg(F.count(F.lit(1)).alias("k"))
    home = votes.groupBy("cid").agg(F.max_by("lead", F.struct("k", -F.col("lead"))).alias("block"))
    hub = classes.select(F.col("cid").alias("block"), F.col("n").alias("m"), F.col("bits").alias("other"))
    both = cut(home, "homes").join(classes.select("cid", "n", "bits"), "cid").join(hub, "block")
    near = both.mapInArrow(_may_follow(percent), "block long, cid long, n long")
    return hub_blocks(cut(near, "followers")).withColumn("comp", F.col("cid"))


def _folded(raw: bytes, width: int) -> np.ndarray:
    x = np.frombuffer(raw, np.uint64)
    return np.bitwise_or.reduce(x.reshape(-1, width), axis=0) if len(x) > width else x


def _may(n: int, raw: bytes, m: int, other: bytes, percent: int) -> bool:
    """Whether the bitmaps of sets of sizes ``n`` and ``m`` allow the threshold: a bit that only one
    has is of a shingle that only one has."""
    width = min(len(raw), len(other)) // 8
    x, y = _folded(raw, width), _folded(other, width)
    most = min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))
    return (100 + percent) * most >= percent * (n + m)


def _may_follow(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [_may(*row, percent) for row in zip(*(b[c].to_pylist() for c in ("n", "bits", "m", "other")), strict=True)]
            yield pa.RecordBatch.from_arrays([b[c] for c in ("block", "cid", "n")], ["block", "cid", "n"]) \
                .filter(pa.array(keep, pa.bool_()))

    return run


def _may_link(percent: int):
    """Pairs (block, cid, n) of classes of different components in the sorted groups whose bitmaps
    allow the threshold."""

    def of(rows: list[tuple]) -> list[tuple]:
        rows.sort(key=lambda r: (r[1], r[0]))
        out = []
        for i, (cid, n, comp, raw) in enumerate(rows):
            for j in range(i - 1, -1, -1):
                other, m, there, bits = rows[j]
                if 100 * m < percent * n:
                    break  # smaller and smaller ones
                if comp != there and _may(n, raw, m, bits, percent):
                    out.append((min(cid, other), *((cid, n) if cid > other else (other, m))))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, rows, found = None, [], set()

        def out() -> pa.RecordBatch:
            a, b, n = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["block", "cid", "n"])

        for b in batches:
            columns = [b[c].to_pylist() for c in ("token", "cid", "n", "comp", "bits")]
            for t, *row in zip(*columns, strict=True):
                if t != token:
                    found.update(of(rows))
                    token, rows = t, []
                rows.append(tuple(row))
            if len(found) > 50_000:
                yield out()
                found = set()
        found.update(of(rows))
        if found:
            yield out()

    return run


def group_blocks(posts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that may link in the groups of infrequent shingles of more than one component;
    equal groups count once."""
    early = posts.where("not late")
    groups = early.groupBy("token").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("k"),
        F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("h")).where("lo != hi")
    once = cut(groups.groupBy("k", "h").agg(F.min("token").alias("token")).select("token"), "groups")
    rows = early.join(once, "token").join(classes.select("cid", "bits"), "cid").select("token", "cid", "n", "comp", "bits")
    rows = rows.repartition(partitions(posts.sparkSession), "token").sortWithinPartitions("token")
    pairs = cut(rows.mapInArrow(_may_link(percent), "block long, cid long, n long").distinct(), "pairs")
    comps = posts.select("cid", "comp").distinct()
    return hub_blocks(pairs).join(comps, "cid").select("block", "part", "side", "cid", "comp")


def family_blocks(posts: DataFrame) -> DataFrame | None:
    """The chunks, two by two, of families of classes that share frequent shingles; None without any."""
    late = posts.where("late")
    mixed = cut(late.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                .where("lo != hi").select("token"), "mixed")
    rows = cut(late.join(mixed, "token").select("cid", "n", "comp", "lead").distinct(), "late")
    if not rows.limit(1).count():
        return None
    family = components(rows.select(F.col("cid").alias("a"), F.col("lead").alias("b")))
    members = cut(rows.select("cid", "n", "comp").distinct().join(family.withColumnRenamed("node", "cid"), "cid")
                  .withColumnRenamed("root", "block"), "families")
    # a component of more than a chunk has chunks of its own; the rest of a family shares some
    own = members.groupBy("block", "comp").agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("c")) \
        .select("block", "comp", F.when((F.col("s") > CHUNK) | (F.col("c") > CHUNK_ROWS), F.col("comp")).alias("own"))
    dealt = _in_chunks(members.join(own, ["block", "comp"]).withColumn("group", F.coalesce("own", F.lit(-1))),
                       ["block", "group"])
    dealt = cut(dealt.select("block", "group", "own", "chunk", "cid", "comp"), "chunks")
    chunks = dealt.select("block", "group", "own", "chunk").distinct()
    x = chunks.select("block", *[F.col(c).alias("x_" + c) for c in ("group", "own", "chunk")])
    y = chunks.select("block", *[F.col(c).alias("y_" + c) for c in ("group", "own", "chunk")])
    before = F.struct("x_group", "x_chunk") <= F.struct("y_group", "y_chunk")
    pairs = cut(x.join(y, "block").where(before & ~F.coalesce(F.col("x_own") == F.col("y_own"), F.lit(False)))
                .withColumn("part", -1 - F.monotonically_increasing_id()), "chunk-pairs")  # others from 0
    same = (F.col("x_group") == F.col("y_group")) & (F.col("x_chunk") == F.col("y_chunk"))
    sides = pairs.select("block", "part", F.lit(0).alias("side"), F.col("x_group").alias("group"),
                         F.col("x_chunk").alias("chunk")).unionByName(
        pairs.where(~same).select("block", "part", F.lit(1).alias("side"), F.col("y_group").alias("group"),
                                  F.col("y_chunk").alias("chunk")))
    return dealt.join(sides, ["block", "group", "chunk"]).select("block", "part", "side", "cid", "comp")


def jaccard_components(docs: DataFrame, *, percent: int = PERCENT, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the smallest id that links reach."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = cut(texts.mapInArrow(_named, "doc_id long, th long, n long, fp binary, bits binary"), "sets")
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "th")))
    classes = cut(rows.where("n > 0").groupBy("fp").agg(
        F.coalesce(least, F.min(F.struct("doc_id", "th"))).alias("rep"), F.min("n").alias("n"), F.min("bits").alias("bits"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")

    posts = postings(texts, classes, percent)
    links = joined(leader_blocks(posts, classes, percent), classes, texts, percent)
    whole = cut(components(links), "components")

    posts = cut(posts.join(whole.withColumnRenamed("node", "cid"), "cid", "left")
                .withColumn("comp", F.coalesce("root", "cid")).drop("root"), "labelled")
    rest = group_blocks(posts, classes, percent)
    if (families := family_blocks(posts)) is not None:
        rest = rest.unionByName(families)
    more = joined(rest, classes, texts, percent)
    whole = components(whole.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    named = classes.join(whole.withColumnRenamed("node", "cid"), "cid", "left") \
        .select("fp", "rep.doc_id", F.coalesce("root", "cid").alias("root"))
    names = cut(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "names")
    by_class = cut(named.select("fp", "root").join(names, "root").select("fp", "component_id"), "by_class")
    c = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.drop("bits").join(by_class, "fp", "left").select("doc_id", F.col("n").alias("n_shingles"), c.alias("component_id"))
