"""Near-duplicate documents with a MinHash LSH forest.

A document is the set of its distinct 5-word shingles (A-Z lower-cased; fewer
words: the whole sequence is the one shingle). Documents with equal sets form a
class; everything after works on classes. Each class gets ``TREES * FIRST`` min
hashes. A tree of the forest is a sort order: the classes sorted by a row of
``DEPTH`` of them, each tree starting at hashes of its own. Candidates are
neighbours in a tree's order that share at least the first ``FIRST`` hashes: a
thin region gives all its pairs at that depth, and in a dense one the neighbours
are those with the longest common prefix, so the depth adapts to the region.

The forest is used twice. First every class and its successor in a few of the
orders are compared by their min hashes, which suggests groups; each member of a
group is paired with one leader. Then the ``REACH`` successors in every order are
candidates where their groups differ, unless the min hashes clearly rule them
out. All these pairs are confirmed on the full sets. Groups in which a member
fails against its leader go through the forest once more, now as single classes.
So a large group of copies costs a comparison a member, and nothing grows with
the square of a group. Only confirmed links connect.

A run of rows equal on the first ``FIRST`` hashes that is longer than ``REACH`` has
pairs that are no such neighbours. The classes of these runs, where more than one
group is in the run, are joined exactly once more: by the shared shingles among the
rarest of each (prefix filter; two sets of the threshold share one), as far as sizes
and places in the order of rarity allow the threshold. So a pair is missed only
where no tree brings it into a run, or where its min hashes rule it out by chance.

At the threshold of 0.75 a pair shares a tree's first three hashes with
probability 0.42, and none of 24 trees' with 2e-6.

Defined cases: null and empty texts have an empty set and link with nothing;
rows that repeat a document id are one document; a null id never names a
component unless all its ids are null; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import cut, hashed_words, mix64, partitions, stream64, windows64
from cellsmith.llm.graph import components, joined

WORDS = 5
TREES, FIRST, DEPTH, REACH = 24, 3, 6, 8
#: Orders from which groups are suggested, a candidate a class in each.
GROUP_TREES = 4
PERCENT = 75
#: Pairs whose min hashes suggest a lower similarity are not compared: at a
#: similarity of 0.75 and 72 hashes, 0.53 is over four standard deviations away.
LEAST_ESTIMATE = 0.53
#: Suggested similarity from which two classes are put into one group to be tried first.
GROUP_ESTIMATE = 0.8
#: Counters of the shingles' frequency in crowds; it only orders them.
CROWD_BUCKETS = 1 << 20
#: Classes that are compared at a time of those that share a shingle.
CROWD_CHUNK = 500
#: Pairs that a task holds before it hands them on.
_PAIRS = 100_000
#: Rows of an open run that are held back until the run ends.
_HELD = 100_000
_N = TREES * FIRST
_SLICE = 500  # texts worked on at a time
_U = np.uint64


def shingle_sets(array: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within the text, and n + 1 offsets."""
    h, first, _, _ = hashed_words(array)
    s, at = windows64(h, first, words)
    n_words = np.diff(first)
    parts, sizes = [], np.zeros(len(n_words), np.int64)
    for i, n in enumerate(n_words):
        if n >= words:
            x = np.unique(s[at[i]:at[i + 1]])
        elif n:
            c = stream64(words, 7) | _U(1)
            x = mix64(np.array([(h[first[i]:first[i + 1]] * c[:n]).sum(dtype=np.uint64) + _U(n)], np.uint64))
        else:
            continue
        parts.append(x)
        sizes[i] = len(x)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


_A = stream64(_N, 11) | _U(1)
_B = stream64(_N, 12)


def min_hashes(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(n, TREES * FIRST) min hashes of 16 bits of non-empty sets."""
    out = np.empty((len(at) - 1, _N), ">u2")
    step = 1 << 15
    i = 0
    while i < len(at) - 1:  # sets of about a cache's size at a time
        j = max(int(np.searchsorted(at, at[i] + step, "right")) - 1, i + 1)
        x = sets[at[i]:at[j]]
        cuts = (at[i:j] - at[i]).astype(np.int64)
        for k in range(_N):
            low = np.minimum.reduceat((x ^ _B[k]) * _A[k], cuts)
            out[i:j, k] = (mix64(low) & _U(0xFFFF)).astype(np.uint16)
        i = j
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, _SLICE):
            yield b.slice(k, _SLICE)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _slices(batches):
        sets, at = shingle_sets(b["text"])
        size = np.diff(at)
        full = size > 0
        at_full = np.concatenate([[0], np.cumsum(size[full])])
        fp, sig = [None] * len(size), [None] * len(size)
        if full.any():
            sums = [np.add.reduceat(mix64(sets ^ c), at_full[:-1]) for c in stream64(2, 13)]
            ids = np.stack(sums, 1).astype(">u8")
            mins = min_hashes(sets, at_full)
            for k, i in enumerate(np.flatnonzero(full)):
                fp[i], sig[i] = ids[k].tobytes(), mins[k].tobytes()
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], b["th"], pa.array(size), pa.array(fp, pa.binary()), pa.array(sig, pa.binary())],
            ["doc_id", "th", "n", "fp", "sig"])


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, th, n, fp, sig): fp names the shingle set, sig holds its min hashes."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return d.mapInArrow(_sign, "doc_id long, th long, n long, fp binary, sig binary")


_TREE = ["key", "fp", "comp", "sketch"]
_TREE_ROW = "key binary, fp binary, comp binary, sketch binary"


def _tree_rows(trees: int):
    """A row for each class and tree: key is the tree's number and its DEPTH hashes,
    sketch holds four bits of every min hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(b["sig"].to_pylist()), np.uint8).reshape(n, _N, 2)
            low = sig[:, :, 1] & 15
            sketch = pa.array([x.tobytes() for x in low[:, ::2] << 4 | low[:, 1::2]], pa.binary())
            for t in range(trees):
                cols = [(t * FIRST + k) % _N for k in range(DEPTH)]
                key = np.empty((n, 1 + 2 * DEPTH), np.uint8)
                key[:, 0] = t
                key[:, 1:] = sig[:, cols].reshape(n, 2 * DEPTH)
                keys = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(1 + 2 * DEPTH), n, [None, pa.py_buffer(key.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([keys, b["fp"], b["comp"], sketch], _TREE)

    return run


def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity that two arrays of sketches suggest, row by row: the share of
    equal four-bit hashes, less the one in sixteen that chance makes equal."""
    z = x ^ y
    share = ((z & 15 == 0).sum(1) + (z >> 4 == 0).sum(1)) / _N
    return (16 * share - 1) / 15


def _prefixes(keys: pa.ChunkedArray) -> np.ndarray:
    """The tree's number and the first ``FIRST`` hashes of each key, as a number."""
    raw = np.frombuffer(b"".join(x[:1 + 2 * FIRST] for x in keys.to_pylist()), np.uint8).reshape(-1, 1 + 2 * FIRST)
    prefix = np.zeros(len(raw), np.uint64)
    for k in range(1 + 2 * FIRST):
        prefix = (prefix << _U(8)) | raw[:, k].astype(np.uint64)
    return prefix


class _Runs:
    """Rows of runs with equal prefixes that are longer than ``reach`` + 1 and of more than one
    ``comp``, and all rows of the runs at a partition's edges, which may go on in the next one."""

    def __init__(self, reach: int):
        self.reach, self.open = reach, True
        self.held = (np.zeros(0, np.uint64), np.zeros(0, object), np.zeros(0, object))

    def add(self, prefix: np.ndarray, fp: np.ndarray, comp: np.ndarray) -> np.ndarray | None:
        """The rows among those held and the new ones that are found; those of the last run are held."""
        p, f, c = (np.concatenate(x) for x in zip(self.held, (prefix, fp, comp), strict=True))
        cuts = np.concatenate([[0], np.flatnonzero(p[1:] != p[:-1]) + 1, [len(p)]])
        keep = np.zeros(len(p), bool)
        for a, b in zip(cuts[:-2].tolist(), cuts[1:-1].tolist(), strict=True):
            if (a == 0 and self.open) or (b - a > self.reach + 1 and (c[a:b] != c[a]).any()):
                keep[a:b] = True
        last = int(cuts[-2])
        if last:
            self.open = False
        if len(p) - last > _HELD:
            keep[last:] = True
            last, self.open = len(p), True
        self.held = (p[last:], f[last:], c[last:])
        return (p[keep], f[keep], c[keep])

    def end(self):
        return self.held


def _neighbours(reach: int, least: float, edges: bool, crowds: bool = False):
    """Candidates among the sorted rows of a partition, alike by their sketches; with
    ``edges`` also its first and last rows, whose neighbours may be in the next one;
    with ``crowds`` also the rows (run, fp, comp) of long runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.binary()) for c in ("a", "b", "run", *_TREE)])

        def crowd(p: np.ndarray, f: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(p):
                none = pa.nulls(len(p), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [none, none, pa.array([x.tobytes() for x in p], pa.binary()), none, pa.array(f, pa.binary()),
                     pa.array(c, pa.binary()), none], schema=schema)

        def edge(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            if edges and rows.num_rows:
                none = pa.nulls(rows.num_rows, pa.binary())
                yield from pa.Table.from_arrays(
                    [none, none, none, *[rows[c].cast(pa.binary()) for c in _TREE]], schema=schema) \
                    .combine_chunks().to_batches()

        tail, seen, head = None, 0, []
        runs = _Runs(reach)
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            if seen < reach:
                head.append(t.slice(0, reach - seen))
            seen += t.num_rows
            old = tail.num_rows if tail else 0
            t = (pa.concat_tables([tail, t]) if tail else t).combine_chunks()
            tail = t.slice(max(t.num_rows - reach, 0))
            n = t.num_rows
            prefix = _prefixes(t["key"])
            comp = np.array(t["comp"].to_pylist(), object)
            fp = np.array(t["fp"].to_pylist(), object)
            if crowds:
                yield from crowd(*runs.add(prefix[old:], fp[old:], comp[old:]))
            if n < 2:
                continue
            sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(n, _N // 2)
            found = set()
            for s in range(1, min(reach, n - 1) + 1):
                i = np.flatnonzero(prefix[s:] == prefix[:-s])
                i = i[i + s >= old]
                i = i[comp[i] != comp[i + s]]
                i = i[alike(sketch[i], sketch[i + s]) >= least]
                found.update((x, y) if x < y else (y, x) for x, y in zip(fp[i], fp[i + s], strict=True))
            if found:
                a, c = zip(*found, strict=True)
                none = pa.nulls(len(a), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(c, pa.binary()), none, none, none, none, none], schema=schema)
        if crowds:
            yield from crowd(*runs.end())
        if head:
            yield from edge(pa.concat_tables(head))
            if seen > reach:
                yield from edge(tail.slice(max(0, tail.num_rows - min(reach, seen - reach))))

    return run


_ROW = "a binary, b binary, run binary, " + _TREE_ROW


def candidates(classes: DataFrame, reach: int, least: float, trees: int = TREES,
               crowds: bool = False) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a, b) of neighbours in the forest whose ``comp`` differ and whose
    min hashes suggest a similarity of at least ``least``; and with ``crowds`` the classes
    (fp) of runs that are longer than ``reach`` + 1 and of more than one ``comp``.

    The rows are sorted over all machines; equal keys are split by the class's
    id, so a hot region spreads over partitions. Neighbours on both sides of a
    partition's edge come from the edges' own rows, 2 * reach a partition.
    """
    rows = classes.select("fp", "sig", "comp").mapInArrow(_tree_rows(trees), _TREE_ROW)
    ordered = rows.repartitionByRange(partitions(classes.sparkSession), "key", "fp").sortWithinPartitions("key", "fp")
    found = cut(ordered.mapInArrow(_neighbours(reach, least, True, crowds), _ROW), "neighbours")
    edges = found.where("key is not null").select(_TREE)
    edges = edges.repartition(1).sortWithinPartitions("key", "fp").mapInArrow(_neighbours(reach, least, False), _ROW)
    pairs = found.where("a is not null").select("a", "b").unionByName(edges.select("a", "b")).distinct()
    rows = found.where("run is not null").select("run", "fp", "comp")
    runs = rows.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")) \
        .where((F.col("n") > reach + 1) & (F.col("lo") != F.col("hi")))
    runs = cut(runs.select("run"), "runs")  # written, so that the rows are not dealt by run for the join
    return pairs, rows.join(runs, "run", "left_semi").select("fp").distinct()


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(CROWD_BUCKETS, np.int64)
    for b in _slices(batches):
        n += np.bincount((shingle_sets(b["text"])[0] % _U(CROWD_BUCKETS)).astype(np.int64), minlength=CROWD_BUCKETS)
    i = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(n[i])], ["bucket", "n"])


def _rarest(shared, percent: int):
    """The rarest shingles of each set, with the set's size and the shingle's place in the order: so
    many that two sets of the threshold share one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        for b in _slices(batches):
            sets, at = shingle_sets(b["text"])
            tokens, rows, places = [], [], []
            for i in range(b.num_rows):
                x = sets[at[i]:at[i + 1]]
                n = len(x) - -(-percent * len(x) // 100) + 1
                x = x[np.lexsort((x, count[(x % _U(CROWD_BUCKETS)).astype(np.int64)]))[:n]]
                tokens.append(x)
                rows.append(np.full(len(x), i))
                places.append(np.arange(len(x)))
            if rows:
                i = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), b["fp"].take(pa.array(i)), b["comp"].take(pa.array(i)),
                     pa.array(np.diff(at)[i]), pa.array(np.concatenate(places))], ["token", "fp", "comp", "size", "place"])

    return run


def _possible(size: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Which of the (size, place) may be of two sets of the threshold whose rarest common shingle this is."""
    least = -(-percent * (size[:, None] + size) // (100 + percent))
    return (size - place)[:, None].clip(max=size - place) >= least


def _ordered(fp: np.ndarray, left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    """The pairs of rows as (a, b) with a < b; repeated ones go in the distinct that follows."""
    x, y = fp[np.concatenate(left)], fp[np.concatenate(right)]
    low = x < y
    return pa.RecordBatch.from_arrays([pa.array(np.where(low, x, y), pa.binary()),
                                       pa.array(np.where(low, y, x), pa.binary())], ["a", "b"])


def _crowd_pairs(percent: int):
    """Pairs of classes in the sorted groups (token, x, y) that may be of the threshold."""

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        group = np.stack([t[c].to_numpy() for c in ("token", "x", "y")], 1)
        cuts = np.concatenate([[0], np.flatnonzero((group[1:] != group[:-1]).any(1)) + 1, [len(group)]])
        size, place, chunk = (t[c].to_numpy() for c in ("size", "place", "chunk"))
        fp, comp = (np.array(t[c].to_pylist(), object) for c in ("fp", "comp"))
        comp = np.unique(comp, return_inverse=True)[1]
        left, right, n = [], [], 0
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b - a < 2:
                continue
            kinds, kind = np.unique(np.stack([size[a:b], place[a:b]], 1), axis=0, return_inverse=True)
            may = _possible(kinds[:, 0], kinds[:, 1], percent)
            kind = kind.ravel()
            c, d = comp[a:b], chunk[a:b]
            apart = group[a, 1] != group[a, 2]
            for i in np.flatnonzero(may.any(1)[kind]).tolist():
                ok = may[kind[i], kind[i + 1:]] & (c[i + 1:] != c[i])
                if apart:
                    ok &= d[i + 1:] != d[i]
                j = np.flatnonzero(ok) + a + i + 1
                if len(j):
                    left.append(np.full(len(j), a + i))
                    right.append(j)
                    n += len(j)
                if n >= _PAIRS:
                    yield _ordered(fp, left, right)
                    left, right, n = [], [], 0
        if n:
            yield _ordered(fp, left, right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for last, b in _with_last(batches):
            t = pa.Table.from_batches([b]) if b is not None else None
            t = t if held is None else held if t is None else pa.concat_tables([held, t])
            if t is None or not t.num_rows:
                continue
            t, held = t.combine_chunks(), None
            if not last:
                group = np.stack([t[c].to_numpy() for c in ("token", "x", "y")], 1)
                end = np.flatnonzero((group[1:] != group[:-1]).any(1))
                done = int(end[-1]) + 1 if len(end) else 0
                t, held = t.slice(0, done), t.slice(done)
            if t.num_rows:
                yield from pairs(t)

    return run


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for b in batches:
        yield False, b
    yield True, None


def crowd_candidates(crowd: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of the classes (fp, comp, text) whose ``comp`` differ: all that the full
    sets may confirm, by the rarest shingle that they share.

    Shingles of one ``comp`` alone are left out by a combined count; the classes of a very common one
    are dealt over chunks, and every two chunks meet in a group of their own.
    """
    spark = crowd.sparkSession
    rows = crowd.select("text").mapInArrow(_bucket_counts, "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # CROWD_BUCKETS rows at most
    count = np.zeros(CROWD_BUCKETS, np.int64)
    count[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    posts = cut(crowd.select("fp", "comp", "text").mapInArrow(
        _rarest(spark.sparkContext.broadcast(count), percent),
        "token long, fp binary, comp binary, size long, place long"), "rarest")
    mixed = posts.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")) \
        .where(F.col("lo") != F.col("hi")).select("token", F.ceil(F.col("n") / CROWD_CHUNK).alias("k"))
    dealt = posts.join(mixed, "token").withColumn("chunk", F.pmod(F.xxhash64("fp"), "k")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1))) \
        .select("token", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"), "chunk", "fp",
                "comp", "size", "place")
    groups = dealt.repartition(partitions(spark), "token", "x", "y").sortWithinPartitions("token", "x", "y")
    return groups.mapInArrow(_crowd_pairs(percent), "a binary, b binary").distinct()


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            (x, i), (y, j) = shingle_sets(b["ta"]), shingle_sets(b["tb"])
            keep = []
            for k in range(b.num_rows):
                p, q = x[i[k]:i[k + 1]], y[j[k]:j[k + 1]]
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([b["a"], b["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def texts_of_classes(nodes: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(fp, text) of the classes in ``nodes``: the texts move once, always by the same
    join, so the cost follows the documents at every size."""
    reps = classes.join(nodes.distinct(), "fp").select("fp", "rep.*")
    d = docs.select(F.col(id_col).cast("long").alias("d"), F.xxhash64(text_col).alias("h"),
                    F.col(text_col).alias("text"))
    found = d.join(reps.hint("merge"), d["d"].eqNullSafe(reps["doc_id"]) & (d["h"] == reps["th"]))
    return cut(found.select("fp", "text").dropDuplicates(["fp"]), "texts")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the full sets of their texts confirm."""
    j = pairs.join(texts.select(F.col("fp").alias("a"), F.col("text").alias("ta")), "a") \
        .join(texts.select(F.col("fp").alias("b"), F.col("text").alias("tb")), "b")
    return cut(j.select("a", "b", "ta", "tb").mapInArrow(_confirm(percent), "a binary, b binary"), "links")


def near_duplicates(docs: DataFrame, *, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, th (xxhash64 of the text), n_shingles,
    component_id, kept (the row's document gives its component the name)."""
    rows = cut(signed(docs, id_col, text_col), "signatures")
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "th")))
    classes = cut(rows.where("n > 0").groupBy("fp").agg(
        F.coalesce(least, F.min(F.struct("doc_id", "th"))).alias("rep"), F.min("sig").alias("sig"))
        .withColumn("comp", F.col("fp")), "classes")

    # groups that the min hashes suggest: each member is held against the smallest one
    near, _ = candidates(classes, 1, GROUP_ESTIMATE, GROUP_TREES)
    star = cut(components(near).where(F.col("node") != F.col("root"))
               .select(F.col("node").alias("a"), F.col("root").alias("b")), "star")
    grouped = classes.drop("comp").join(star.select(F.col("a").alias("fp"), "b"), "fp", "left") \
        .withColumn("comp", F.coalesce("b", "fp")).drop("b")
    rest, crowds = candidates(cut(grouped, "grouped"), REACH, LEAST_ESTIMATE, crowds=True)
    rest, crowds = cut(rest, "rest"), cut(crowds, "crowds")
    pairs = star.unionByName(rest)
    texts = texts_of_classes(pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).union(crowds), classes,
                             docs, id_col, text_col)
    links = confirmed(pairs, texts, percent)

    # groups with a member that its leader does not confirm: their classes one by one
    failed = cut(star.join(links, ["a", "b"], "left_anti"), "failed")
    loose = failed.select("b").distinct()
    again = star.join(loose, "b").select(F.col("a").alias("fp")).union(loose.select(F.col("b").alias("fp")))
    whole = cut(components(links), "whole")
    alone = classes.drop("comp").join(again, "fp").join(whole.select(F.col("node").alias("fp"), "root"), "fp", "left") \
        .withColumn("comp", F.coalesce("root", "fp")).drop("root")
    more, crowds2 = candidates(cut(alone, "alone"), REACH, LEAST_ESTIMATE, crowds=True)
    whole = joined(whole, confirmed(cut(more, "more"), texts, percent))

    # long runs, in which not all are neighbours: what is not connected yet is joined exactly
    crowds = cut(crowds.union(crowds2).distinct(), "crowd")
    if crowds.limit(1).count():
        comp = crowds.join(whole.select(F.col("node").alias("fp"), "root"), "fp", "left") \
            .select("fp", F.coalesce("root", "fp").alias("comp"))
        crowd = cut(texts.join(comp, "fp"), "crowd-texts")
        whole = joined(whole, confirmed(cut(crowd_candidates(crowd, percent), "exact"), texts, percent))

    named = classes.join(whole.select(F.col("node").alias("fp"), "root"), "fp", "left") \
        .select("fp", "rep.doc_id", F.coalesce("root", "fp").alias("root"))
    names = cut(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "names")
    by_class = cut(named.select("fp", "root").join(names, "root").select("fp", "component_id"), "by_class")
    out = rows.join(by_class, "fp", "left")
    c = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), c.alias("component_id"),
                      F.col("doc_id").eqNullSafe(c).alias("kept"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group, all columns; of rows that repeat
    an id and its text one stays."""
    kept = near_duplicates(docs, id_col=id_col, text_col=text_col, **options).where("kept") \
        .select("doc_id", "th").distinct()
    kept = cut(kept, "kept")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("i"),
                       F.xxhash64(text_col).alias("h"))
    j = rows.join(kept, rows["i"].eqNullSafe(kept["doc_id"]) & (rows["h"] == kept["th"]))
    return j.dropDuplicates(["i", "h"]).select("row.*")
