"""Near copies of a given shingle similarity: a prefix filter finds the candidates, their texts decide.

Two texts are near copies if the Jaccard similarity of their sets of five-word shingles is ``SIMILAR`` or more. Given
any one order of all shingles, such texts share one of the first n - ceil(SIMILAR * n) + 1 of their n shingles, whatever
the edits are; so those shingles are the cells. The order is: shingles that a sample of the texts holds more often come
later, then by hash. The sample makes cells small and decides nothing else.

Equal texts (as words) are one node. Cells of one node go; in the others nodes meet with a 512-bit SimHash of all
shingles, and a pair is a candidate if ``LOOSE`` bits or fewer differ (at a similarity of 0.8 about 78 do, with a
deviation of 8 or 9). Every candidate is decided by the similarity of the two texts' shingles themselves. Families can be
large, so pairs are not given all at once: first each node of a cell meets the nearest one that is not in its group yet,
twice, and what has been linked becomes a group; then all pairs are compared that still are in different groups. Cells of
any size go the same way and no link between groups is lost; large cells are divided into blocks for many tasks.

Defined results: null and empty texts are one group; texts of fewer than five words have their words as the one shingle;
texts of any length give all their shingles; an empty table gives no rows; of rows of one group that repeat the kept id
one stays, while rows of other groups with that id are settled there; rows without an id stay; all columns stay as they
were, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.llm.common import cut, one_of_each, slices, utf8
from lawloom.llm.components import components
from lawloom.llm.simhash import shingles

WORDS = 5
LONG = 8  # 64-bit parts of the long fingerprint
LOOSE = 128
SEED = 42
#: The least similarity of near copies, as a fraction.
SIMILAR = (4, 5)
#: Nodes of a block up to which numpy compares all pairs of many blocks at once; it changes the time alone.
FEW = 16
#: Nodes of a part of a cell, about.
BLOCK = 4_096
#: Turns in which nodes are linked to their nearest, before all that is left is compared.
TURNS = 2
#: Texts whose shingles give the order, and repeated shingles of theirs that are kept, about and at most.
SAMPLE, KNOWN = 5_000, 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def majority(h: np.ndarray) -> int:
    """The bits set in over half the hashes."""
    if not len(h):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 32768):
        counts += np.unpackbits(h[at : at + 32768].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0])


def _hashes(items, seed: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, items, repeat(seed)), np.uint64)


def _set(text: bytes | None, k: int) -> np.ndarray:
    """Hashes of the distinct shingles, rising."""
    return np.unique(_hashes(shingles(text, k), SEED))


def prefix(h: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first of the shingles in the common order: two sets that are similar enough share one of them."""
    if not len(h):
        return h
    at = np.minimum(np.searchsorted(known[0], h), max(len(known[0]) - 1, 0))
    often = np.where(known[0][at] == h, known[1][at], 0) if len(known[0]) else np.zeros(len(h), np.int64)
    up, down = SIMILAR
    return h[np.lexsort((h, often))[: len(h) + (-up * len(h)) // down + 1]]


def describe(text: bytes | None, k: int, known) -> tuple[int, bytes, bytes]:
    """Name of the text as words, its prefix, its long fingerprint."""
    h = _set(text, k)
    first = prefix(h, known).astype("<u8").tobytes()
    long = []
    for part in range(LONG):
        h = (h ^ (h >> np.uint64(29))) * _MIX + np.uint64(part)
        h ^= h >> np.uint64(32)
        long.append(majority(h))
    return xxhash.xxh64_intdigest(b" ".join(text.lower().split() if text else [])), first, np.array(long, "<u8").tobytes()


def repeated_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, rising, of shingles that several texts of a sample hold, and in how many; the most frequent ones."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    every = max(1, texts.count() // SAMPLE)

    def run(batches):
        for b in slices(batches):
            h = [_set(t, k) for t in utf8(b["text"])]
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate([np.zeros(0, np.uint64), *h]))], ["h"])

    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    top = some.mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "h").limit(KNOWN).toArrow()
    h, n = top["h"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def _signed(x) -> pa.Array:
    return pa.array(np.array(x, np.uint64).view(np.int64), pa.int64())


def nodes(docs: DataFrame, *, k: int = WORDS) -> DataFrame:
    """doc_id, node, prefix, long."""
    known = docs.sparkSession.sparkContext.broadcast(repeated_shingles(docs, k))

    def run(batches):
        for b in slices(batches):
            got = [describe(t, k, known.value) for t in utf8(b["text"])]
            yield pa.RecordBatch.from_arrays([b["doc_id"], _signed([g[0] for g in got]), pa.array([g[1] for g in got], pa.binary()), pa.array([g[2] for g in got], pa.binary())], ["doc_id", "node", "prefix", "long"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, node long, prefix binary, long binary")


def _cells(uniq: DataFrame) -> DataFrame:
    """cell, node: a row for each shingle of a prefix."""

    def run(batches):
        for b in batches:
            p = b["prefix"].to_pylist()
            n = np.array([len(x) // 8 for x in p], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(p), "<i8"), pa.int64()), pa.array(np.repeat(b["node"].to_numpy(zero_copy_only=False), n), pa.int64())], ["cell", "node"])

    return uniq.select("node", "prefix").mapInArrow(run, "cell long, node long")


def _met(cells: DataFrame) -> DataFrame:
    """The rows of cells with several nodes."""

    def run(batches):
        last = None  # the last row so far, and whether it has been given
        for b in batches:
            if not b.num_rows:
                continue
            c, n = (b[x].to_numpy(zero_copy_only=False) for x in ("cell", "node"))
            given = False
            if last is not None:
                c, n, given = np.r_[last[0], c], np.r_[last[1], n], last[2]
            same = c[1:] == c[:-1]
            some = np.r_[False, same] | np.r_[same, False]
            last = c[-1], n[-1], bool(some[-1]) or (given and len(c) == 1)
            if given:
                some[0] = False
            yield pa.RecordBatch.from_arrays([pa.array(c[some], pa.int64()), pa.array(n[some], pa.int64())], ["cell", "node"])

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "cell long, node long")


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of every row of x from every row of y."""
    d = np.zeros((len(x), len(y)), np.uint16)
    for part in range(x.shape[1]):
        d += np.bitwise_count(x[:, None, part] ^ y[None, :, part])
    return d


def meet(block: np.ndarray, own: np.ndarray, node: np.ndarray, root: np.ndarray, x: np.ndarray, every: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes of the same block, of different roots and within ``LOOSE`` bits.

    ``every``: all of them, those of the same ``own`` part only where the block is of one part. Otherwise each node's
    nearest, and in blocks of a few nodes all as well.
    """
    first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    size = np.diff(np.r_[first, len(block)])
    few = np.repeat(size, size) <= FEW
    parts = np.repeat(np.maximum.reduceat(own, first) != np.minimum.reduceat(own, first), size)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    g, n, r, y, o, p = (v[few] for v in (block, node, root, x, own, parts))
    for lag in range(1, int(size[size <= FEW].max(initial=1))):
        i = np.flatnonzero((g[lag:] == g[:-lag]) & (r[lag:] != r[:-lag]) & ((o[lag:] != o[:-lag]) | ~p[lag:]))
        i = i[np.bitwise_count(y[lag:][i] ^ y[:-lag][i]).sum(axis=-1, dtype=np.int32) <= LOOSE]
        a.append(n[lag:][i])
        b.append(n[:-lag][i])
    for at, m in zip(first[size > FEW], size[size > FEW]):
        n, r, y, o = node[at : at + m], root[at : at + m], x[at : at + m], own[at : at + m]
        for low in range(0, m, 64):
            rows = slice(low, min(low + 64, m))
            start = low if every else 0  # each pair once, or every node against all
            d = _distances(y[rows], y[start:])
            bad = (d > LOOSE) | (r[rows, None] == r[None, start:])
            if parts[at]:
                bad |= o[rows, None] == o[None, start:]
            if every:
                i, j = np.nonzero(~bad)
                i, j = i[j > i], j[j > i]
            else:
                d[bad] = LOOSE + 1
                j = d.argmin(axis=1)
                i = np.flatnonzero(d[np.arange(len(d)), j] <= LOOSE)
                j = j[i]
            a.append(n[low + i])
            b.append(n[start + j])
    return np.concatenate(a), np.concatenate(b)


def _pairs(batches: Iterable[pa.RecordBatch], every: bool) -> Iterator[pa.RecordBatch]:
    """The pairs of a partition sorted by blocks: a, b, the lesser second. It holds a batch and a block at a time."""
    held: list[tuple] = []

    def give(rows):
        block = np.cumsum(np.r_[True, (rows[0][1:] != rows[0][:-1]).any(axis=1)])
        a, b = meet(block, *rows[1:], every)
        both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
        for at in range(0, both.shape[1], 65536):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 65536], pa.int64()) for x in both], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        c, i, j, own, node, root = (batch[x].to_numpy(zero_copy_only=False).astype(np.int64) for x in ("cell", "i", "j", "own", "node", "root"))
        held.append((np.stack([c, i, j], axis=1), own, node, root, np.frombuffer(b"".join(batch["x"].to_pylist()), "<u8").reshape(-1, LONG)))
        key = held[-1][0]
        if (held[0][0][0] == key[-1]).all():
            continue  # one block so far
        rows = [np.concatenate(y) for y in zip(*held)]
        last = int(np.flatnonzero((rows[0] != rows[0][-1]).any(axis=1))[-1]) + 1
        yield from give([y[:last] for y in rows])
        held = [tuple(y[last:] for y in rows)]
    if held:
        yield from give([np.concatenate(y) for y in zip(*held)])


def _candidates(cells: DataFrame, roots: DataFrame | None, turn: int, every: bool) -> DataFrame:
    """a, b: pairs of nodes that share a cell and no root, the lesser second, each once.

    ``cells`` has cell, node, x; ``roots`` node, root. A cell of more than ``BLOCK`` nodes is divided by hash, and each
    pair of its parts is a block of its own (``every``), or each part, dealt anew in every turn.
    """
    rows = cells.withColumn("root", F.col("node"))
    if roots is not None:
        rows = cells.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    rows = rows.join(several.select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")), "cell")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(turn)), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)) if every else F.col("own")
    rows = rows.withColumn("other", other).select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "root", "x")
    blocks = rows.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "node")
    return blocks.mapInArrow(lambda batches: _pairs(batches, every), "a long, b long").distinct()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets is SIMILAR or more."""
    up, down = SIMILAR
    met = len(np.intersect1d(a, b, assume_unique=True))
    return met * down >= (len(a) + len(b) - met) * up


def _verified(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """The pairs a, b whose texts (node, text) are similar."""

    def run(batches):
        for b in slices(batches):
            sets: dict[int, np.ndarray] = {}
            of = lambda node, text: sets[node] if node in sets else sets.setdefault(node, _set(text, k))
            keep = [similar(of(x, s), of(y, t)) for x, s, y, t in zip(b["a"].to_pylist(), utf8(b["text_a"]), b["b"].to_pylist(), utf8(b["text_b"]))]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # first the lesser node, which many pairs may have: so the rows that meet in one task are short
    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _texts_of(docs: DataFrame, some: DataFrame) -> DataFrame:
    """node, text (as words) of the nodes in some."""

    def run(batches):
        for b in slices(batches):
            words = [b" ".join(t.lower().split()) if t else b"" for t in utf8(b["text"])]
            yield pa.RecordBatch.from_arrays([_signed([xxhash.xxh64_intdigest(w) for w in words]), pa.array(words, pa.binary()).cast(pa.string())], ["node", "text"])

    named = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "node long, text string")
    return named.join(some, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))


def _joined(cells: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """node, root of the nodes that are linked to others.

    The first turns link nodes to their nearest, which makes large families one group with few pairs; the last compares
    every pair of nodes of a cell that are in different groups still. So no link between groups is lost, whatever a
    cell's size.
    """
    links = tested = group = None
    for turn in range(TURNS + 1):
        pairs = _candidates(cells, group, turn, every=turn == TURNS)
        pairs = cut(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            continue
        tested = pairs if tested is None else tested.union(pairs)
        active = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        good = cut(_verified(pairs, cut(_texts_of(docs, active)), k))
        links = good if links is None else links.union(good)
        group = cut(components(links))
    return cells.sparkSession.createDataFrame([], "node long, root long") if group is None else group


def groups(docs: DataFrame, *, k: int = WORDS) -> DataFrame:
    """doc_id, node, component_id (the least doc_id of the group), root (a node that names the group)."""
    described = cut(nodes(docs, k=k))
    uniq = described.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("prefix").alias("prefix"), F.first("long").alias("long"))
    uniq = cut(uniq)
    met = _met(_cells(uniq))
    cells = cut(met.join(uniq.select("node", F.col("long").alias("x")), "node").select("cell", "node", "x"))
    group = _joined(cells, docs, k)
    least = uniq.select("node", "first").join(group, "node").groupBy("root").agg(F.min("first").alias("component_id"))
    named = uniq.select("node", "first").join(group.join(least, "root"), "node", "left").select("node", F.coalesce("component_id", "first").alias("component_id"), F.coalesce("root", "node").alias("root"))
    return described.select("doc_id", "node").join(cut(named), "node", "left").select("doc_id", "node", "component_id", "root")


def _with_node(docs: DataFrame, name: str) -> DataFrame:
    """The rows with their node under that name."""

    def run(batches):
        for b in slices(batches):
            own = [xxhash.xxh64_intdigest(b" ".join(t.lower().split() if t else [])) for t in utf8(b["text"])]
            yield pa.RecordBatch.from_arrays([*b.columns, _signed(own)], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def drop_near_copies(docs: DataFrame, *, k: int = WORDS) -> DataFrame:
    """One row of each group, of the least doc_id. An id with texts of several groups is settled in each of them."""
    return one_of_each(docs, groups(docs, k=k), _with_node)
