"""SimHash near-duplicates: segment-popcount embedding, grid range-join under Manhattan distance, exact check.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments. A differing bit changes one count by at
most one, so the Manhattan distance of two count vectors is never above the Hamming distance of the fingerprints. The
grid is laid over blocks of four counts: the distance of 4 or less that links two fingerprints can touch at most 4 of
the 8 blocks, so linked fingerprints lie in the same cell of at least one of the C(8, 4) projections to 4 blocks. Each
projection is an equi-join on its cell; within a cell the Manhattan distance filters and the Hamming distance decides.

Equal fingerprints are joined before any pairing, and a cell yields one star of links per group it connects, never its
pairs. A cell of over ``hot`` fingerprints gets a finer grid: the counts that its fingerprints do not share yet are laid
in eight blocks again, of two counts and then of one, of which linked fingerprints share four. Where even 28 of the 32
counts are shared by more than ``hot``, another exact way remains: two fingerprints differ in at most 4 bits if and only
if some word is at most 2 bits away from both, so grouping by such words connects them without comparing pairs.

Defined results: null and empty texts have fingerprint zero and are linked like any other; a text of any length gives all
its shingles; an empty table gives no rows; repeated rows are given back each time; component ids ignore null doc ids
unless a component has no other; other columns are left alone. Of a group's rows that repeat the kept id one stays where
near copies are dropped; rows without an id stay.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.llm.common import cut, one_of_each, utf8
from lawloom.llm.components import components

SEED = 42
BITS = 4
#: Fingerprints of a cell that one task may compare.
HOT = 100_000

_ODD = np.uint64(0x5555555555555555)
_ONE = np.uint64(1)


def shingles(text: bytes | None, k: int):
    """The k-word shingles of the text, repeats included; the whole text if it has fewer words."""
    words = text.lower().split() if text else []
    if len(words) <= k:
        return [b" ".join(words)] if words else []
    return map(b" ".join, zip(*(words[i:] for i in range(k))))


def fingerprint(text: bytes | None, k: int = 4) -> int:
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles(text, k), repeat(SEED)), np.uint64)
    if not len(h):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 32768):
        counts += np.unpackbits(h[at : at + 32768].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, k: int = 4) -> DataFrame:
    """doc_id, fp: the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, k) for t in utf8(b["text"])], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def embed(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 segments, two bits each, packed as the fingerprint is."""
    return (fp & _ODD) + ((fp >> _ONE) & _ODD)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of packed counts. Counts are 0, 1 or 2; in unary, 00, 01 or 11, a difference is a number of bits."""
    unary = lambda x: x & _ODD | ((x >> _ONE) & _ODD) | (((x >> _ONE) & _ODD) << _ONE)
    return np.bitwise_count(unary(a) ^ unary(b))


#: Grids that are laid into each other, the projections of each, and the low bits of a cell that name them.
LEVELS = 3
_CHOICES = list(combinations(range(8), 8 - BITS))
_PATH = 19
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=8192)
def _masks(level: int, path: int) -> list[np.uint64]:
    """The counts that each projection of a grid adds to those that its cell shares."""
    shared = 0
    for n in range(level):
        shared |= int(_masks(n, path % len(_CHOICES) ** n)[path // len(_CHOICES) ** n % len(_CHOICES)])
    free = [i for i in range(32) if not shared >> 2 * i & 3]
    size = len(free) // 8
    blocks = [sum(3 << 2 * i for i in free[n * size : (n + 1) * size]) for n in range(8)]
    return [np.uint64(sum(blocks[n] for n in some)) for some in _CHOICES]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def _cells(rows: DataFrame, level: int) -> DataFrame:
    """cell, fp of the grid inside the cells of ``rows``. A cell is a hash of its counts, and the projections that led to it.

    Cells that share a hash by chance are compared as one: that costs time and changes no link.
    """

    def run(batches):
        for b in batches:
            cell, fps = (b[c].to_numpy(zero_copy_only=False).view(np.uint64) for c in ("cell", "fp"))
            paths = cell & np.uint64((1 << _PATH) - 1)
            for path in np.unique(paths).tolist():
                own = paths == path
                above, fp = cell[own], fps[own]
                counts, same = embed(fp), pa.array(fp.view(np.int64))
                for n, mask in enumerate(_masks(level, path)):
                    new = _mixed(above ^ _mixed(counts & mask)) >> np.uint64(_PATH) << np.uint64(_PATH) | np.uint64(path + n * len(_CHOICES) ** level)
                    yield pa.RecordBatch.from_arrays([pa.array(new.view(np.int64)), same], ["cell", "fp"])

    return rows.select("cell", "fp").mapInArrow(run, "cell long, fp long")


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    near = manhattan(embed(a), embed(b)) <= BITS
    near &= np.bitwise_count(a ^ b) <= BITS
    return near


def _connect(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each fingerprint that a walk over close ones reaches to where it began."""
    left, ups, downs = fp, [], []
    while len(left) > 1:
        start, left = left[0], left[1:]
        wave = np.array([start], np.uint64)
        while len(wave) and len(left):
            now, wave = wave[:64], wave[64:]
            near = np.zeros(len(left), bool)
            for x in now:
                near |= _close(left, x)
            if near.any():
                got = left[near]
                ups.append(got)
                downs.append(np.full(len(got), start, np.uint64))
                wave, left = np.concatenate([wave, got]), left[~near]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *ups]), np.concatenate([none, *downs])


def _links_in(cell: np.ndarray, fp: np.ndarray, hot: int):
    """Links of whole cells, rows sorted by cell, and the rows of cells that are too large."""
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[first, len(cell)])
    of = np.repeat(size, size)
    small = of <= 24
    c, f = cell[small & (of > 1)], fp[small & (of > 1)]
    a, b = [], []
    for lag in range(1, int(size[size <= 24].max(initial=1))):
        same = c[lag:] == c[:-lag]
        x, y = f[lag:][same], f[:-lag][same]
        near = _close(x, y)
        a.append(x[near])
        b.append(y[near])
    for at, n in zip(first[size > 24], size[size > 24]):
        if n <= hot:
            x, y = _connect(fp[at : at + n])
            a.append(x)
            b.append(y)
    none, large = np.zeros(0, np.uint64), of > hot
    return np.concatenate([none, *a]), np.concatenate([none, *b]), cell[large], fp[large]


def _range_join(cells: DataFrame, hot: int) -> DataFrame:
    """a, b, cell: links, where cell is null, and the fingerprints a of cells that are too large."""

    def run(batches):
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            c, f = (np.concatenate(x) for x in zip(*kept)) if kept else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
            kept.clear()
            return c, f

        def out(a, b, cell):
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), b, cell], ["a", "b", "cell"])

        def hand_on(c, f):
            return out(f, pa.nulls(len(f), pa.int64()), pa.array(c))

        def links(c, f):
            x, y, c, f = _links_in(c, f, hot)
            yield out(x, pa.array(y.view(np.int64)), pa.nulls(len(x), pa.int64()))
            if len(c):
                yield hand_on(c, f)

        full = None  # a cell with too many fingerprints; they are handed on as they come
        for batch in batches:
            c, f = batch["cell"].to_numpy(zero_copy_only=False), batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            if full is not None:
                own = int(np.searchsorted(c, full, side="right"))
                if own:
                    yield hand_on(c[:own], f[:own])
                c, f = c[own:], f[own:]
            if not len(c):
                continue
            full = None
            kept.append((c, f))
            if kept[0][0][0] == c[-1]:  # one cell so far
                if sum(len(x) for x, _ in kept) > hot:
                    full = c[-1]
                    yield hand_on(*flush())
                continue
            c, f = flush()
            last = int(np.searchsorted(c, c[-1]))
            yield from links(c[:last], f[:last])
            kept.append((c[last:], f[last:]))
        c, f = flush()
        if len(c):
            yield from links(c, f)

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long, cell long")


def _by_middle(hot: DataFrame) -> DataFrame:
    """Links between all of ``fp`` that differ in at most 4 bits, through the words at most 2 bits away from each."""
    one = [1 << i for i in range(64)]
    flips = np.array([0, *one, *(x | y for x, y in combinations(one, 2))], np.uint64)

    def run(batches):
        for b in batches:
            for fp in b["fp"].to_numpy(zero_copy_only=False).view(np.uint64):
                yield pa.RecordBatch.from_arrays([pa.array((flips ^ fp).view(np.int64)), pa.array(np.full(len(flips), fp, np.uint64).view(np.int64))], ["mid", "fp"])

    near = hot.repartition("fp").mapInArrow(run, "mid long, fp long")
    met = near.groupBy("mid").agg(F.min("fp").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n")
    return near.join(met, "mid").where("fp <> rep").select(F.col("fp").alias("a"), F.col("rep").alias("b")).distinct()


def link_fingerprints(fps: DataFrame, *, hot: int = HOT, levels: int = LEVELS) -> DataFrame:
    """fp, root: the fingerprints that have links, and one fingerprint that names their group."""
    rows = fps.select("fp", F.lit(0).cast("long").alias("cell"))
    pairs = None
    for level in range(levels):
        got = cut(_range_join(_cells(rows, level), hot).distinct())
        own = got.where("cell is null").select("a", "b")
        pairs = own if pairs is None else pairs.unionByName(own)
        rows = got.where("cell is not null").select(F.col("a").alias("fp"), "cell")
        if rows.isEmpty():
            break
    else:
        pairs = pairs.unionByName(_by_middle(cut(rows.select("fp").distinct())))
    return components(pairs).select(F.col("node").alias("fp"), "root")


def groups(docs: DataFrame, *, k: int = 4, hot: int = HOT) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that links reach, the document's own included), root (a fingerprint
    that names the group)."""
    fps = cut(fingerprints(docs, k=k))
    first = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    group = cut(link_fingerprints(first, hot=hot))
    least = first.join(group, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    named = first.join(group.join(least, "root").select("fp", "root", "component_id"), "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"), F.coalesce("root", "fp").alias("root"))
    return fps.join(cut(named), "fp", "left").select("doc_id", "fp", "component_id", "root")


def group_by_simhash(docs: DataFrame, *, k: int = 4, hot: int = HOT) -> DataFrame:
    """doc_id, fp and component_id."""
    return groups(docs, k=k, hot=hot).drop("root")


def drop_near_copies(docs: DataFrame, *, k: int = 4, hot: int = HOT) -> DataFrame:
    """One row of each group, of the least doc_id. An id with texts of several groups is settled in each of them."""

    def with_fingerprint(rows: DataFrame, name: str) -> DataFrame:
        def run(batches):
            for b in batches:
                fps = np.array([fingerprint(t, k) for t in utf8(b["text"])], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps, pa.int64())], [*b.schema.names, name])

        return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())]))

    return one_of_each(docs, groups(docs, k=k, hot=hot).withColumnRenamed("fp", "node"), with_fingerprint)


def hex16(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
