"""Exact top-k by inner product through M-trees.

Vectors become integers; adding one coordinate that lifts every vector to the largest norm turns the largest inner
product into the least Euclidean distance, a metric. The rows are dealt by nearest pivot into regions
and, within a region, into trees of bounded size. A tree is a set of paged nodes; each entry of a page stores
its distance to the page's own routing object and the radius that covers what lies below. Trees are built once and
kept as rows of a table; a block of queries walks a tree together, one matrix product per page. A query first
searches the one tree of its own region that it falls to, which bounds its k-th score, and then those trees whose
region may still hold something as good.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.sources.scratch import materialise

#: Regions at most, rows in a tree about, entries in a page, queries in a block at most.
PIVOTS, TREE_ROWS, PAGE, BLOCK = 64, 8192, 64, 1024


def integers(vector: Column) -> Column:
    """floor(1024 x) of each component as long; null if the vector or a component is null or not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * 1024))
    return F.when(vector.isNotNull() & ~F.exists(vector, bad), whole)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.sqrt((d * d).sum(axis=-1))


class MTree:
    """An M-tree over rows of ``points`` (lifted to one norm), built by splitting around routing objects.

    The tree is flat arrays, so that it can be a row of a table. Page i holds the entries ``first[i]`` to ``last[i]``:
    rows in leaf order with their distance to the page's object (``away``) if it is a leaf, else routing objects with
    covering radius, distance to the page's object (``apart``) and child page. The last page is the top: one entry.
    """

    KEPT = ("away", "objects", "radii", "apart", "child", "first", "last", "leaf")

    def __init__(self, points: np.ndarray, page: int = PAGE):
        self.size, self.width = page, points.shape[1]
        self.spared = self.computed = 0  # distances that stored bounds made unnecessary, and those computed
        self._rows, self._parts = [], {name: [] for name in self.KEPT}
        self._taken = self._entries = 0
        if len(points):
            centre = points.mean(axis=0)
            root = self._build(points, np.arange(len(points)), centre)
            radius = _distance(points, centre).max()
            self._inner(centre[None], np.array([radius]), np.zeros(1), [root])
        for name, parts in self._parts.items():
            whole = name in ("child", "first", "last", "leaf")
            empty = np.zeros(0, np.int32 if whole else np.float64)
            setattr(self, name, np.concatenate([empty, *(np.asarray(x, empty.dtype).ravel() for x in parts)]))
        self.objects = self.objects.reshape(-1, self.width)
        #: The row of ``points`` at each place of the leaves.
        self.order = np.concatenate([np.zeros(0, np.int64), *self._rows])
        del self._rows, self._parts

    @classmethod
    def stored(cls, width: int, **arrays: np.ndarray) -> MTree:
        """The tree with these arrays, whose rows are at their places already."""
        tree = cls.__new__(cls)
        tree.width, tree.spared, tree.computed = width, 0, 0
        for name in cls.KEPT:
            setattr(tree, name, arrays[name])
        tree.objects = tree.objects.reshape(-1, width)
        tree.order = np.arange(len(tree.away))
        return tree

    def _page(self, first: int, last: int, leaf: int) -> int:
        for name, x in (("first", first), ("last", last), ("leaf", leaf)):
            self._parts[name].append([x])
        return len(self._parts["first"]) - 1

    def _inner(self, objects: np.ndarray, radii: np.ndarray, apart: np.ndarray, child: list[int]) -> int:
        for name, x in (("objects", objects), ("radii", radii), ("apart", apart), ("child", child)):
            self._parts[name].append(x)
        self._entries += len(child)
        return self._page(self._entries - len(child), self._entries, 0)

    def _build(self, points: np.ndarray, rows: np.ndarray, parent: np.ndarray) -> int:
        """A page for these rows, whose routing object is ``parent``."""
        own = points[rows]
        if len(rows) <= self.size:
            self._rows.append(rows)
            self._parts["away"].append(_distance(own, parent))
            self._taken += len(rows)
            return self._page(self._taken - len(rows), self._taken, 1)
        # routing objects far from each other, each row to the nearest
        fan = max(2, min(self.size, -(-len(rows) // self.size)))
        near, label, picks = np.full(len(rows), np.inf), np.zeros(len(rows), np.int64), []
        at = int(_distance(own, parent).argmax())
        for k in range(fan):
            picks.append(at)
            d = _distance(own, own[at])
            closer = d < near
            near, label = np.where(closer, d, near), np.where(closer, k, label)
            at = int(near.argmax())
            if near[at] == 0:
                break
        if near.max() == 0 and len(picks) == 1:  # copies: any even cut will do
            label = np.arange(len(rows)) * fan // len(rows)
        groups = [g for g in (rows[label == k] for k in range(label.max() + 1)) if len(g)]
        centres = np.array([points[g].mean(axis=0) for g in groups])
        radii = np.array([_distance(points[g], c).max() for g, c in zip(groups, centres, strict=True)])
        child = [self._build(points, g, c) for g, c in zip(groups, centres, strict=True)]
        return self._inner(centres, radii, _distance(centres, parent), child)

    def search(self, query: np.ndarray, limit: float, take) -> None:
        """``walk`` for one query: ``take`` gets rows that may lie within the limit and returns the limit from then on."""
        limits = np.array([float(limit)])

        def one(_, places: np.ndarray) -> None:
            limits[0] = take(self.order[places])

        self.walk(query[None], limits, one)

    def walk(self, queries: np.ndarray, limits: np.ndarray, take) -> None:
        """Best first for a block of queries: pages by the least distance that they may hold for one of the queries.

        ``take`` gets numbers of queries and places of a leaf, among which are all pairs that may lie within the limits;
        it may lower ``limits``. A query goes on into a page only while the page's bound is within the query's limit.
        """
        if not len(self.first) or not len(queries):
            return
        norms, lengths = (queries * queries).sum(axis=1), (self.objects * self.objects).sum(axis=1)
        # distances by matrix product are off by no more than this
        scale = norms.max() + lengths.max()
        slack = float(np.sqrt(16.0 * (self.width + 4) * np.finfo(float).eps * scale))
        number = 0
        heap = [(0.0, number, len(self.first) - 1, np.arange(len(queries)), np.zeros(len(queries)), np.zeros(len(queries)))]
        while heap:
            _, _, page, who, least, to_parent = heapq.heappop(heap)
            entries = slice(self.first[page], self.last[page])
            n = entries.stop - entries.start
            still = least <= limits[who]
            self.spared += int((~still).sum()) * n
            if not still.any():
                continue
            who, to_parent = who[still], to_parent[still]
            leaf = self.leaf[page]
            stored, radii = (self.away[entries], 0.0) if leaf else (self.apart[entries], self.radii[entries])
            # |d(q, parent) - d(object, parent)| - radius is no more than the true distance
            bound = np.abs(to_parent[:, None] - stored) - radii - slack
            open_ = bound <= limits[who][:, None]
            asks, at = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            self.computed += len(asks) * len(at)
            self.spared += len(who) * n - len(asks) * len(at)
            if not len(asks):
                continue
            who, at = who[asks], at + entries.start
            if leaf:
                take(who, at)
                continue
            square = norms[who][:, None] + lengths[at] - 2.0 * (queries[who] @ self.objects[at].T)
            d = np.sqrt(np.maximum(0.0, square))
            low = np.maximum(0.0, d - self.radii[at] - slack)
            within = low <= limits[who][:, None]
            for j in np.flatnonzero(within.any(axis=0)):
                on, number = within[:, j], number + 1
                heapq.heappush(heap, (float(low[on, j].min()), number, int(self.child[at[j]]), who[on], low[on, j], d[on, j]))


def _lift(rows: np.ndarray, norm: float) -> np.ndarray:
    """Rows with the coordinate that makes every squared length ``norm``."""
    x = rows.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(0.0, norm - (x * x).sum(axis=1)))])


def _best(asks: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the k best ids of each query, each with its best score, by query and rank; and their ranks."""
    order = np.lexsort((-scores, ids, asks))
    a, i = asks[order], ids[order]
    order = order[np.concatenate([[True], (a[1:] != a[:-1]) | (i[1:] != i[:-1])])] if len(order) else order
    order = order[np.lexsort((ids[order], -scores[order], asks[order]))]
    a = asks[order]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    return order[rank < k], rank[rank < k]


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = PIVOTS, tree_rows: int = TREE_ROWS,
    page: int = PAGE, block: int = BLOCK,
) -> DataFrame:
    """The k rows of greatest inner product for each query: query_id, rank (from 1), vec_id, score.

    Both tables have vec_id (long) and v (array of long, null: takes no part); products must fit in a long.
    Ties go to the smaller vec_id. A query never finds its own vec_id; fewer candidates than k give fewer rows;
    only vectors of a query's own length are its candidates; rows that repeat a vec_id and vector count once,
    a vec_id with several vectors is one candidate with its best score;
    rows with a null vec_id and empty vectors take no part; other columns are left out. Empty tables give
    no rows. The result does not depend on the pivots.

    Bounds: the driver holds at most ``pivots`` vectors per length and the radius of each region; a tree has about
    ``tree_rows`` rows, and meets its queries in blocks of about ``block``. A region that holds a third of all
    rows is many trees.
    """
    spark = vectors.sparkSession
    clean = lambda df: df.select("vec_id", "v", F.size("v").alias("dim")).filter(
        "vec_id is not null and v is not null and dim > 0"
    ).distinct()
    vectors, queries = materialise(clean(vectors), "vectors"), materialise(clean(queries), "queries")
    result = "query_id long, rank int, vec_id long, score long"
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    shapes = vectors.groupBy("dim").agg(F.max(square).alias("norm"), F.count("*").alias("n"))
    shapes = {r.dim: (r.norm * (1 + 1e-12), r.n) for r in shapes.collect()}  # one row per length of vector
    if not shapes:
        return spark.createDataFrame([], result)
    chosen = {}
    for dim in shapes:
        own = vectors.filter(F.col("dim") == dim).select("v").distinct()
        rows = own.orderBy(F.xxhash64("v")).limit(pivots).collect()
        chosen[dim] = _lift(np.array([r.v for r in rows]), shapes[dim][0])
    shared = spark.sparkContext.broadcast((shapes, chosen))
    where = "vec_id long, v array<bigint>, dim int, region int, away double"

    def place(lifted: bool):
        """The region of each vector, that of its nearest pivot, and the distance to it."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            norms, centres = shared.value
            for batch in batches:
                dims = batch.column("dim").to_numpy(zero_copy_only=False)
                region, away = np.zeros(len(dims), np.int32), np.zeros(len(dims))
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    own = np.array(batch.column("v").take(pa.array(at)).flatten()).reshape(len(at), dim)
                    x = _lift(own, norms[dim][0]) if lifted else np.column_stack([own, np.zeros(len(at))])
                    d = np.stack([_distance(x, c) for c in centres[dim]], axis=1)
                    region[at], away[at] = d.argmin(axis=1), d.min(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in ("vec_id", "v", "dim")), pa.array(region), pa.array(away)],
                    ["vec_id", "v", "dim", "region", "away"],
                )

        return run

    placed = materialise(vectors.mapInArrow(place(True), where), "placed")
    asked = queries.filter(F.col("dim").isin(*shapes)).mapInArrow(place(False), where)
    held = placed.groupBy("dim", "region").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    held = held.withColumn("chunks", F.ceil(F.col("n") / tree_rows).cast("int"))
    regions = {(r.dim, r.region): (r.radius, r.chunks) for r in held.collect()}  # at most pivots per length
    pieces = F.broadcast(held.select("dim", "region", "chunks"))
    chunk = F.pmod(F.xxhash64("vec_id"), F.col("chunks").cast("long")).cast("int")
    trees = placed.join(pieces, ["dim", "region"]).withColumn("chunk", chunk)
    trees = trees.groupBy("dim", "region", "chunk").agg(
        F.collect_list(F.struct("vec_id", "v")).alias("rows")  # about tree_rows
    )
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norms, _ = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                dim, rows = batch.column("dim")[row].as_py(), batch.column("rows")[row].values
                ids = rows.field("vec_id").to_numpy()
                own = rows.field("v").flatten().to_numpy().reshape(len(ids), dim)
                tree = MTree(_lift(own, norms[dim][0]), page)
                lists = [ids[tree.order], own[tree.order].ravel(), *(getattr(tree, n).ravel() for n in MTree.KEPT)]
                keys = [batch.column(n).slice(row, 1) for n in ("dim", "region", "chunk")]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in lists]
                yield pa.RecordBatch.from_arrays([*keys, *lists], ["dim", "region", "chunk", "ids", "v", *MTree.KEPT])

    floats, whole = ("away", "objects", "radii", "apart"), ("child", "first", "last", "leaf")
    shape = "dim int, region int, chunk int, ids array<bigint>, v array<bigint>"
    shape += "".join(f", {n} array<double>" for n in floats) + "".join(f", {n} array<int>" for n in whole)
    trees = materialise(trees.mapInArrow(build, shape), "trees")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norms, _ = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                dim, asks = batch.column("dim")[row].as_py(), batch.column("asks")[row].values
                stored = {n: batch.column(n)[row].values.to_numpy() for n in ("ids", "v", *MTree.KEPT)}
                ids, own = stored.pop("ids"), stored.pop("v").reshape(-1, dim)
                tree = MTree.stored(dim + 1, **stored)
                q_ids = asks.field("vec_id").to_numpy()
                wanted = asks.field("v").flatten().to_numpy().reshape(len(q_ids), dim)
                bounds = [pc.fill_null(asks.field(n), x).to_numpy() for n, x in zip(("bound", "bound_id"), NONE, strict=True)]
                out = _search(tree, ids, own, q_ids, wanted, *bounds, norms[dim][0], k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["query_id", "vec_id", "score"])

    def run(asks: DataFrame) -> DataFrame:
        """Each tree with the queries meant for it, in blocks."""
        part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
        sizes = asks.groupBy("dim", "region", "chunk").agg(F.ceil(F.count("*") / block).alias("parts"))
        blocks = asks.join(sizes, ["dim", "region", "chunk"]).groupBy("dim", "region", "chunk", part.alias("part"))
        blocks = blocks.agg(F.collect_list(F.struct("vec_id", "v", "bound", "bound_id")).alias("asks"))
        met = trees.join(blocks, ["dim", "region", "chunk"]).select("dim", "ids", "v", *MTree.KEPT, "asks")
        return met.mapInArrow(search, "query_id long, vec_id long, score long")

    # first the one tree that a query falls to: its k-th score bounds the rest
    first = asked.join(pieces, ["dim", "region"], "left")
    nearest = F.coalesce(F.col("chunks"), F.lit(0)) > 0
    first = first.filter(nearest).withColumn("chunk", chunk)
    unbound = [F.lit(None).cast("long").alias(n) for n in ("bound", "bound_id")]
    near = materialise(run(first.select("vec_id", "v", "dim", "region", "chunk", *unbound)), "near")
    order = F.struct((-F.col("score")).alias("s"), "vec_id")
    # an id counts once, also if it or the query's id has several vectors
    own = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    bounds = own.groupBy("query_id").agg(
        F.get(F.sort_array(F.collect_list(order)), F.lit(k - 1)).alias("last")  # at most k for each of its vectors
    ).select(F.col("query_id").alias("vec_id"), (-F.col("last.s")).alias("bound"), F.col("last.vec_id").alias("bound_id"))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The trees that may still hold something as good, but for the one that was searched."""
        norms, centres = shared.value
        for batch in batches:
            ids, region = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "region"))
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            done = pc.fill_null(batch.column("done"), -1).to_numpy(zero_copy_only=False)
            bounds = pc.fill_null(batch.column("bound"), NONE[0]).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                own = np.array(batch.column("v").take(pa.array(at)).flatten()).reshape(len(at), dim)
                limits, q = _limits(bounds[at], own, norms[dim][0]), np.column_stack([own, np.zeros(len(at))])
                for number, centre in enumerate(centres[dim]):
                    if (dim, number) not in regions:
                        continue
                    radius, chunks = regions[dim, number]
                    for c in range(chunks):
                        some = (_distance(q, centre) - radius <= limits) & ~((region[at] == number) & (done[at] == c))
                        n = int(some.sum())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[at[some]]), *(pa.array(np.full(n, x, np.int32)) for x in (number, c))],
                            ["vec_id", "region", "chunk"],
                        )

    known = asked.join(pieces, ["dim", "region"], "left").withColumn("done", F.when(nearest, chunk))
    known = known.join(bounds, "vec_id", "left").drop("away", "chunks")
    known = materialise(known, "bounds")
    more = known.mapInArrow(reach, "vec_id long, region int, chunk int")
    rest = run(more.join(known.select("vec_id", "v", "dim", "bound", "bound_id"), "vec_id"))
    every = near.unionByName(rest).distinct().groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = F.slice(F.sort_array(F.collect_list(order)), 1, k)
    lists = every.groupBy("query_id").agg(best.alias("best"))
    return lists.select("query_id", F.posexplode("best").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score")
    )


#: Stands for no bound: every score and id is better.
NONE = (np.iinfo(np.int64).min, np.iinfo(np.int64).max)


def _limits(bounds: np.ndarray, queries: np.ndarray, norm: float) -> np.ndarray:
    """The distances at which the scores are ``bounds``, with room for rounding."""
    x = queries.astype(np.float64)
    square = (x * x).sum(axis=1) + norm - 2.0 * (bounds.astype(np.float64) - 0.5)
    limits = np.sqrt(np.maximum(0.0, square)) * (1 + 1e-9) + 1e-6
    return np.where(bounds == NONE[0], np.inf, limits)


def _search(
    tree: MTree, ids: np.ndarray, rows: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray,
    bound_ids: np.ndarray, norm: float, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vec_id, score) of the k best of one tree for each query, without those behind the query's bound."""
    kth, kth_id = bounds.copy(), bound_ids.copy()
    limits = _limits(kth, queries, norm)
    # whole numbers are exact as doubles up to 2^53, and doubles multiply faster
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * rows.shape[1]
    left, right = (queries.astype(np.float64), rows.astype(np.float64)) if most < 2.0**53 else (queries, rows)
    held = [np.zeros(0, np.int64)] * 3

    def take(who: np.ndarray, places: np.ndarray) -> None:
        scores = (left[who] @ right[places].T).astype(np.int64)
        near, own = ids[places], kth[who][:, None]
        good = (scores > own) | ((scores == own) & (near <= kth_id[who][:, None]))
        good &= near != q_ids[who][:, None]
        w, p = np.nonzero(good)
        if not len(w):
            return
        touched = np.zeros(len(q_ids), bool)
        touched[who[w]] = True
        mine = touched[held[0]]
        new = [np.concatenate([h[mine], x]) for h, x in zip(held, (who[w], near[p], scores[good]), strict=True)]
        keep, rank = _best(*new, k)
        last = keep[rank == k - 1]
        held[:] = [np.concatenate([h[~mine], x[keep]]) for h, x in zip(held, new, strict=True)]
        full, kth[new[0][last]], kth_id[new[0][last]] = new[0][last], new[2][last], new[1][last]
        limits[full] = np.minimum(limits[full], _limits(kth[full], queries[full], norm))

    tree.walk(np.column_stack([queries.astype(np.float64), np.zeros(len(queries))]), limits, take)
    return q_ids[held[0]], held[1], held[2]
