"""Exact top-k inner-product search with a pair of cover trees.

Queries and data are both indexed. A tree's node is a point with the radius that covers its descendants; children lie
more than half their parent's scale apart (the simplified cover tree's separation), and a node of few points is a
leaf. Siblings too small for a leaf of their own share leaves around their parent's point. For a group of queries and a group of rows, no inner product is above

    <q, c> + |q| * rc + |c| * rq + rq * rc

with q, c their points and rq, rc their radii. A pair of nodes is dropped when that bound is below the worst kth score
of the query group (or equal to it while every id of the rows is larger). Scores are exact integers.

Rows stay where they lie: each task indexes its rows in blocks of bounded size and searches block after block, so the
kth scores found in one block prune the next; a query's best rows of each task meet in one small shuffle. The queries
are gathered in rounds of bounded size, whatever their number, and start with kth scores from a small sample of rows,
which only makes pruning begin early.

Defined results: vectors that are null, or hold a null or a component that is not finite, take no part; vectors of
different length are never compared; rows of a query's own id are never its results; equal rows of one query count as
one query, rows of one id with different vectors as queries of their own; scores beyond a long are held at its end;
other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024.0
K = 10
EVERY = 100
LEAF = 256
#: Centres in a row that reach fewer rows than a leaf holds; then the rest go to leaves around the parent's point.
ALONE = 24
BLOCK = 8192
#: Components of all queries that one round holds.
ROUND = 4_000_000
SEED_ROWS = 2048
_MAX = 2**63 - 1


class Tree:
    """A simplified cover tree over the rows of x; nodes in arrays, children of a node side by side."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x = x.astype(np.float64)
        self.order = np.arange(len(x))
        self.point: list[int] = []
        self.radius: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[range] = []
        todo = [(self._node(0, self.order, self._far(0, self.order)), None)] if len(x) else []
        while todo:
            node, dist = todo.pop()
            a, b = self.span[node]
            if b - a <= leaf or self.radius[node] == 0.0:
                continue
            dist = self._far(self.point[node], self.order[a:b]) if dist is None else dist
            first = len(self.point)
            parts = self._split(self.point[node], self.order[a:b], dist, self.radius[node] / 2, leaf)
            at = a
            for p, rows, d in parts:
                self.order[at : at + len(rows)] = rows
                self._node(p, rows, d, at)
                at += len(rows)
            self.children[node] = range(first, len(self.point))
            todo += [(n, parts[n - first][2]) for n in self.children[node]]

    def _far(self, p: int, rows: np.ndarray) -> np.ndarray:
        d = self.x[rows] - self.x[p]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def _node(self, p: int, rows: np.ndarray, dist: np.ndarray, at: int = 0) -> int:
        self.point.append(int(p))
        self.radius.append(float(dist.max()))
        self.span.append((at, at + len(rows)))
        self.children.append(range(0))
        return len(self.point) - 1

    def _split(self, p: int, rows: np.ndarray, dist: np.ndarray, scale: float, leaf: int):
        """Centres more than ``scale`` apart, each with the rows that it is the first to reach; then leaves around p."""
        out, small, alone = [], [], 0
        p0, d0 = p, dict(zip(rows.tolist(), dist.tolist()))
        while len(rows) and alone < ALONE:
            near = dist <= scale
            if near.sum() < leaf:
                small.append(rows[near])
                alone += 1
            else:
                out.append((p, rows[near].copy(), dist[near]))
                alone = 0
            rows = rows[~near]
            if len(rows):
                p = int(rows[np.argmax(dist[~near])])
                dist = self._far(p, rows)
        rest = np.concatenate([*small, rows]) if small or len(rows) else rows
        d = np.array([d0[r] for r in rest.tolist()])
        for at in range(0, len(rest), leaf):
            near = np.argsort(d, kind="stable")[at : at + leaf]
            out.append((p0, rest[near], d[near]))
        return out

    def seal(self, ids: np.ndarray) -> Tree:
        """Bounds that the search needs: norms of the points, and the least id below each node."""
        self.at = self.x[self.point]
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.at, self.at))
        self.reach = np.array(self.radius)
        self.least = np.array([ids[self.order[a:b]].min() for a, b in self.span])
        return self


@dataclass
class Best:
    """The k best (score, id) of each query, best first; absent ones have the least score and the largest id."""

    score: np.ndarray
    ids: np.ndarray
    k: int

    @classmethod
    def none(cls, n: int, k: int) -> Best:
        return cls(np.full((n, k), -_MAX, np.int64), np.full((n, k), _MAX, np.int64), k)

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Rows with these ids (one column each) as candidates of the queries q, where allowed."""
        s = np.concatenate([self.score[q], np.where(allowed, score, -_MAX)], axis=1)
        i = np.concatenate([self.ids[q], np.where(allowed, ids[None, :], _MAX)], axis=1)
        if s.shape[1] > 4 * self.k:  # whatever is below the kth score is out
            cut = -np.partition(-s, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            keep = (s >= cut).any(axis=0)
            s, i = s[:, keep], i[:, keep]
        top = np.lexsort((i, -s), axis=1)[:, : self.k]
        self.score[q] = np.take_along_axis(s, top, axis=1)
        self.ids[q] = np.take_along_axis(i, top, axis=1)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors held as floats, within the range of a long."""
    if not q.size or not c.size or max(np.abs(q).max(), 1.0) * max(np.abs(c).max(), 1.0) * q.shape[1] < 2.0**53:
        return np.rint(q @ c.T).astype(np.int64)
    exact = np.array([[int(v) for v in r] for r in q], object) @ np.array([[int(v) for v in r] for r in c], object).T
    return np.clip(exact, -_MAX, _MAX).astype(np.int64)


def search(qt: Tree, q_ids: np.ndarray, ct: Tree, c_ids: np.ndarray, best: Best) -> None:
    """Improve ``best`` (by row of the query tree) with the rows of the candidate tree."""
    if not len(qt.x) or not len(ct.x):
        return
    slack = 1e-9

    def bound(a: int, nodes) -> np.ndarray:
        n = np.array(nodes)
        b = ct.at[n] @ qt.at[a] + qt.norm[a] * ct.reach[n] + ct.norm[n] * qt.reach[a] + qt.reach[a] * ct.reach[n]
        return b + slack * (np.abs(b) + 1.0)

    stack = [(0, 0, np.inf)]
    while stack:
        a, c, most = stack.pop()
        rows = qt.order[slice(*qt.span[a])]
        worst = best.score[rows, -1].min()
        if most < worst:
            continue
        if most < worst + 1 and ct.least[c] > best.ids[rows, -1].max():
            continue  # at best ties, all with larger ids
        if not qt.children[a] and not ct.children[c]:
            there = ct.order[slice(*ct.span[c])]
            for at in range(0, len(rows), 256):
                q = rows[at : at + 256]
                ids = c_ids[there]
                best.add(q, products(qt.x[q], ct.x[there]), ids, ids[None, :] != q_ids[q][:, None])
        elif not ct.children[c] or qt.children[a] and qt.reach[a] > ct.reach[c]:
            stack += [(n, c, bound(n, [c])[0]) for n in qt.children[a]]
        else:
            near = bound(a, ct.children[c])
            stack += [(a, ct.children[c][i], near[i]) for i in np.argsort(near, kind="stable")]


def _by_length(ids: np.ndarray, column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    out = {}
    for n in np.unique(lengths):
        of = np.flatnonzero(lengths == n)
        out[int(n)] = ids[of], flat[starts[of][:, None] + np.arange(n)[None, :]].reshape(len(of), n)
    return out


def usable(vectors: DataFrame, *, scale: float = SCALE) -> DataFrame:
    """vec_id, v: floor(scale * x) of every vector that takes part."""
    v = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~odd).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


@dataclass
class _Round:
    """The queries of one round by vector length: ids, vectors, tree, starting scores."""

    groups: dict

    @classmethod
    def of(cls, rows, sample, k: int) -> _Round:
        groups = {}
        for n in {len(r["v"]) for r in rows}:
            own = sorted({(r["vec_id"], tuple(r["v"])) for r in rows if len(r["v"]) == n})
            ids, x = np.array([i for i, _ in own], np.int64), np.array([v for _, v in own], np.float64).reshape(len(own), n)
            tree = Tree(x, 32).seal(ids)
            best = Best.none(len(ids), k)
            near = [r for r in sample if len(r["v"]) == n]
            if near:
                c_ids = np.array([r["vec_id"] for r in near], np.int64)
                search(tree, ids, Tree(np.array([r["v"] for r in near], np.float64).reshape(len(near), n)).seal(c_ids), c_ids, best)
            groups[n] = ids, tree, best.score[:, -1].copy()
        return cls(groups)


def top_k(vectors: DataFrame, *, k: int = K, every: int = EVERY, scale: float = SCALE, block: int = BLOCK, round_size: int = ROUND) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every query (rows whose id ``every`` divides)."""
    sc = vectors.sparkSession.sparkContext
    data = usable(vectors, scale=scale)
    asked = data.where(F.col("vec_id") % every == 0).distinct()
    size = asked.agg(F.sum(F.size("v") + 1).alias("n")).first()["n"] or 0
    rounds = max(1, -(-size // round_size))
    sample = data.limit(SEED_ROWS).collect()
    found = None
    for r in range(rounds):
        rows = (asked.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(rounds)) == r) if rounds > 1 else asked).collect()
        shared = sc.broadcast(_Round.of(rows, sample, k))

        def run(batches, shared=shared):
            groups = {n: (ids, tree, Best.none(len(ids), k), start) for n, (ids, tree, start) in shared.value.groups.items()}
            for _, _, best, start in groups.values():
                # a row that only equals the starting score may still be among the best
                best.score[:, -1] = np.where(start > -_MAX, start - 1, -_MAX)
            waiting: dict[int, list] = {n: [] for n in groups}

            def flush(n):
                ids, x = (np.concatenate(y) for y in zip(*waiting[n]))
                waiting[n].clear()
                q_ids, tree, best, _ = groups[n]
                for at in range(0, len(ids), block):
                    c = ids[at : at + block]
                    search(tree, q_ids, Tree(x[at : at + block]).seal(c), c, best)

            for b in batches:
                for n, (ids, x) in _by_length(b["vec_id"].to_numpy(zero_copy_only=False), b["v"]).items():
                    if n in groups:
                        waiting[n].append((ids, x))
                        if sum(len(i) for i, _ in waiting[n]) >= block:
                            flush(n)
            for n in groups:
                if waiting[n]:
                    flush(n)
            for q_ids, _, best, _ in groups.values():
                of, at = np.nonzero(best.ids < _MAX)
                if len(of):
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[of]), pa.array(of.astype(np.int64)), pa.array(best.ids[of, at]), pa.array(best.score[of, at])], ["query_id", "q", "vec_id", "score"])

        part = data.mapInArrow(run, "query_id long, q long, vec_id long, score long").withColumn("round", F.lit(r))
        found = part if found is None else found.unionByName(part)
    w = Window.partitionBy("round", "query_id", "q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
