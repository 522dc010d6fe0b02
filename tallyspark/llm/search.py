"""Exact top-k inner products by a dual cover-tree search.

Candidates and queries are dealt at random into blocks of bounded size, and
each (query block, candidate block) is one task's group: both get a cover
tree, and node pairs are visited from the roots.  For nodes with centres q, d
and covering radii r, s no pair of theirs scores more than
``<q, d> + |q| s + |d| r + r s``; a pair of nodes goes once that is below the
worst kth score of the query node's group.  Every query starts with the kth
best score over a bounded sample of candidates, which bounds its result from
below, so whole branches go in the first visits.

The result does not depend on the sample or the blocks.  Scores are inner
products of whole numbers: in double precision where the vectors' lengths keep
every sum below 2**52, in 64-bit integers up to 2**62, and beyond that an error.

How much the bounds prune is up to the vectors: clusters go as a whole, while
independent directions in many dimensions are all about as far from each other
as a node's radius, and then nearly every pair is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store

SCHEMA = "query_id bigint, vec_id bigint, score bigint"


@dataclass(frozen=True)
class Search:
    k: int = 5
    candidates_per_block: int = 4096
    queries_per_block: int = 2048
    leaf: int = 48
    shrink: float = 0.7
    #: candidates that give each query its first bound
    sample: int = 2048


class CoverTree:
    """Cover tree over the rows of ``x``.  A node's points lie within its
    radius of its centre, which is a point; the children's centres cover the
    node's points within the next smaller radius and lie apart from each other
    by more than that.  A node of few points, or of one place, is a leaf."""

    def __init__(self, x: np.ndarray, leaf: int, shrink: float):
        self.x = x
        center: list[int] = []
        radius: list[float] = []
        children: list[list[int]] = []
        self.points: list[np.ndarray] = []
        stack = [(np.arange(len(x)), 0, -1)] if len(x) else []
        while stack:
            points, middle, parent = stack.pop()
            apart = np.sqrt(((x[points] - x[middle]) ** 2).sum(axis=1))
            node = len(center)
            center.append(middle)
            radius.append(float(apart.max()))
            children.append([])
            self.points.append(points)
            if parent >= 0:
                children[parent].append(node)
            if len(points) > leaf and radius[node] > 0:
                owner = self._cover(points, apart, radius[node] * shrink)
                order = np.argsort(owner, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1):
                    lead = int(owner[part[0]])
                    stack.append((points[part], middle if lead < 0 else int(points[lead]), node))
        self.center = np.array(center, np.int64)
        self.radius = np.array(radius)
        self.children = [np.array(c, np.int64) for c in children]
        self.inner = np.array([len(c) > 0 for c in children], bool)
        self.norm = np.sqrt((x[self.center] ** 2).sum(axis=1)) if len(x) else np.empty(0)

    def _cover(self, points: np.ndarray, apart: np.ndarray, cover: float) -> np.ndarray:
        """For each point the place of the centre that covers it (-1: the
        node's own).  The next centres are the first uncovered points, tried
        some at a time, each only if no earlier one covers it."""
        owner = np.where(apart <= cover, -1, len(points))
        rest = np.flatnonzero(owner == len(points))
        while len(rest):
            tried = rest[:64]
            y = self.x[points[rest]]
            z = self.x[points[tried]]
            # whole numbers: squared distances are exact
            near = (y * y).sum(axis=1)[:, None] + (z * z).sum(axis=1)[None, :] - 2 * (y @ z.T) <= cover * cover
            for j in range(len(tried)):
                if owner[tried[j]] == len(points):
                    free = near[:, j] & (owner[rest] == len(points))
                    owner[rest[free]] = tried[j]
                    owner[tried[j]] = tried[j]
            rest = rest[owner[rest] == len(points)]
        return owner

    def open(self, nodes: np.ndarray) -> np.ndarray:
        return np.concatenate([self.children[d] for d in nodes]) if len(nodes) else nodes


#: no score: below every score
NONE = np.iinfo(np.int64).min


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of rows of whole numbers, as 64-bit integers."""
    if not len(a) or not len(b):
        return np.empty((len(a), len(b)), np.int64)
    # no partial sum is beyond the product of the lengths
    largest = np.sqrt((a * a).sum(axis=1).max()) * np.sqrt((b * b).sum(axis=1).max())
    if largest < 2.0 ** 52:
        return (a @ b.T).astype(np.int64)
    if largest < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    raise ValueError("inner products may be beyond 62 bits")


class BestK:
    """The k best (score, least id) of each query so far, and the number of
    pairs that were scored."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor, self.scored = k, floor, 0
        self.score, self.ids = np.full((n, k), NONE), np.full((n, k), np.iinfo(np.int64).max)

    def worst(self, rows: np.ndarray) -> int:
        return int(np.maximum(self.score[rows, -1], self.floor[rows]).min())

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        score = np.concatenate([self.score[rows], scores], axis=1)
        own = np.concatenate([self.ids[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        own[score == NONE] = np.iinfo(np.int64).max
        # the largest number is -1 - (the least one); no negation leaves 64 bits
        order = np.lexsort((own, -1 - score), axis=1)[:, : self.k]
        self.scored += scores.size
        self.score[rows] = np.take_along_axis(score, order, axis=1)
        self.ids[rows] = np.take_along_axis(own, order, axis=1)


def dual_search(queries: CoverTree, data: CoverTree, query_ids: np.ndarray, data_ids: np.ndarray, best: BestK) -> None:
    if not len(queries.x) or not len(data.x):
        return

    def bounds(q: int, d: np.ndarray) -> np.ndarray:
        inner = centers[d] @ queries.x[queries.center[q]]
        r, s = queries.radius[q], data.radius[d]
        # rounding may not make a bound too small
        slack = 1e-9 * (queries.norm[q] + r) * (data.norm[d] + s) + 1
        return inner + queries.norm[q] * s + data.norm[d] * r + r * s + slack

    centers = data.x[data.center]
    stack = [(0, np.zeros(1, np.int64))]  # a query node and the data nodes it still has to see
    while stack:
        q, nodes = stack.pop()
        rows = queries.points[q]
        limit = bounds(q, nodes)
        keep = limit >= best.worst(rows)
        nodes, limit = nodes[keep], limit[keep]
        if not len(nodes):
            continue
        if queries.inner[q]:
            # the wider of two nodes is opened first
            wide = data.inner[nodes] & (data.radius[nodes] >= queries.radius[q])
            opened = np.concatenate([nodes[~wide], data.open(nodes[wide])])
            stack += [(child, opened) for child in queries.children[q]]
            continue
        leaf = ~data.inner[nodes]
        if not leaf.all():
            stack.append((q, data.open(nodes[~leaf])))
        order = np.argsort(-limit[leaf])
        leaves, limit = nodes[leaf][order], limit[leaf][order]
        for at in range(0, len(leaves), 64):
            if limit[at] < best.worst(rows):
                break
            points = np.concatenate([data.points[d] for d in leaves[at: at + 64]])
            scores = exact_scores(queries.x[rows], data.x[points])
            scores[query_ids[rows][:, None] == data_ids[points][None, :]] = NONE
            best.offer(rows, scores, data_ids[points])


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, v array<double>``: floor(scale * x) of usable vectors."""
    x = F.col("embedding").cast("array<double>")
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return vectors.where(usable).select(
        F.col("vec_id").cast("bigint"), F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e).cast("double")).alias("v"))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.empty((0, 0))


def top_k(vectors: DataFrame, every: int = 50, search: Search = Search()) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of each row
    whose ``vec_id`` is divisible by ``every``, itself excepted.

    Ties go to the smaller ``vec_id``; a query with fewer candidates has fewer
    rows.  Vectors that are null, empty, or hold null or non-finite components
    and rows without an id take no part; of rows that repeat an id, equal ones
    count once and unequal ones each.  Vectors of another dimension than the
    query's are no candidates of it.  Other columns are not read.  Vectors so
    long that a score may leave 62 bits raise.
    """
    rows = store(whole_vectors(vectors).distinct().withColumn("dim", F.size("v")), "vectors")
    asking = rows.where(F.col("vec_id") % every == 0)
    n, m = rows.count(), asking.count()
    blocks_d, blocks_q = -(-n // search.candidates_per_block) or 1, -(-m // search.queries_per_block) or 1
    # a bounded sample: the rows with the smallest hashes
    first = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(search.sample).select("vec_id", "v", "dim").collect()
    sample: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r.dim for r in first}:
        own = [r for r in first if r.dim == dim]
        sample[dim] = (np.array([r.vec_id for r in own]), np.array([r.v for r in own], np.float64))
    shared = vectors.sparkSession.sparkContext.broadcast(sample)

    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = asking.select("dim", deal(blocks_q, 1).alias("qb"), copies(blocks_d).alias("db"), F.lit(0).alias("kind"), "vec_id", "v")
    d = rows.select("dim", copies(blocks_q).alias("qb"), deal(blocks_d, 2).alias("db"), F.lit(1).alias("kind"), "vec_id", "v")

    def run(key: tuple, group: pa.Table) -> pa.Table:
        kind, ids = group.column("kind").to_numpy(), group.column("vec_id").to_numpy()
        x = _matrix(group.column("v"))
        asked, offered = kind == 0, kind == 1
        qi, qx, di, dx = ids[asked], x[asked], ids[offered], x[offered]
        out = [np.empty(0, np.int64)] * 3
        if len(qi) and len(di):
            known_ids, known = shared.value.get(key[0].as_py(), (np.empty(0, np.int64), np.empty((0, x.shape[1]))))
            floor = np.full(len(qi), NONE)
            if len(known_ids) > search.k:
                scores = exact_scores(qx, known)
                scores[qi[:, None] == known_ids[None, :]] = NONE
                floor = np.partition(scores, -search.k, axis=1)[:, -search.k]
            best = BestK(len(qi), search.k, floor)
            dual_search(CoverTree(qx, search.leaf, search.shrink), CoverTree(dx, search.leaf, search.shrink), qi, di, best)
            found = best.score != NONE
            out = [np.repeat(qi, search.k).reshape(best.ids.shape)[found], best.ids[found], best.score[found]]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, out))))

    found = q.unionByName(d).groupBy("dim", "qb", "db").applyInArrow(run, SCHEMA)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= search.k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score")
