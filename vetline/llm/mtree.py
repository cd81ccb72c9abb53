"""Exact top-k search by inner product: best-first search in M-trees.

An inner product is no metric, so every vector ``y`` gets one more coordinate,
``sqrt(M^2 - |y|^2)`` with ``M`` the longest vector's length, and a query a zero
there. Then ``|q - y|^2 = |q|^2 + M^2 - 2 q.y``: the nearest vectors have the
highest products. An M-tree holds the vectors in leaf pages; each node keeps a
routing object, its covering radius and its distance to the parent's routing
object, each entry its distance to that of its page. The search takes nodes in
the order of their least possible distance; the stored distances and the
triangle inequality rule out children and entries before any distance is
computed. Bounds carry slack for rounding, scores are exact integers, so the
result is exact, ties included.

Shape of the job: distinct vectors are dealt to the nearest of at most
``MOST_PIVOTS`` sampled pivots, large cells are split by hash, and every shard
of about ``SHARD_ROWS`` vectors becomes one tree, written as pages to the shared
folder. Each query first searches one shard of its nearest pivot; the k-th
score found there then rules out whole cells by their radii. The remaining
(query, shard) pairs are dealt in slices of at most about ``SLICE_QUERIES``
queries a shard, so that neither a popular shard nor its queries meet in one
task. Only pivots, their radii and cell sizes are sent to tasks.

Equal vectors are one entry of the tree with its k + 1 smallest ids (kept so
before the shuffle): no result of k can hold more of them.

Defined cases: rows without id or vector, and vectors with null or non-finite
components, take no part. Shorter vectors are filled with zeros. A repeated id
is a candidate once for each of its rows, and each of its rows a query of its
own, which leaves out only itself. Scores beyond 64 bits are clipped. An empty
table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetline.llm.frames import durable

#: Routing pivots at most; vectors of a tree and of a page; queries that share one copy of a tree.
MOST_PIVOTS, SHARD_ROWS, PAGE, SLICE_QUERIES = 512, 4096, 256, 2048
#: Components are clipped here, where doubles still hold every integer.
CLIP = 1 << 53


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit integers, clipped beyond."""
    if not vectors.size:
        return np.zeros(len(vectors), np.int64)
    if float(np.abs(vectors).max()) * float(np.abs(query).max()) * len(query) < CLIP:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    exact = vectors.astype(object) @ query.astype(object)
    return np.array([min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in exact], np.int64)


def lift(vectors: np.ndarray, longest: float) -> np.ndarray:
    """The vectors as doubles with the coordinate that makes all of them ``sqrt(longest)`` long."""
    flat = vectors.astype(np.float64)
    return np.column_stack([flat, np.sqrt(np.maximum(0.0, longest - (flat * flat).sum(axis=1)))])


def gaps(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Distances of lifted points to one of them."""
    away = points - centre
    return np.sqrt((away * away).sum(axis=1))


def _paged(points: np.ndarray, page: int) -> list[np.ndarray]:
    """Indices of the points in pages of ``page`` at most, halved between two far poles until they fit."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        own = todo.pop()
        if len(own) <= page:
            done.append(own)
            continue
        one = own[np.argmax(gaps(points[own], points[own[0]]))]
        near = gaps(points[own], points[one])
        side = np.argsort(near - gaps(points[own], points[own[np.argmax(near)]]), kind="stable")
        todo += [own[side[len(own) // 2:]], own[side[:len(own) // 2]]]
    return done


@dataclass
class Level:
    """Nodes of one level: routing objects, covering radii, distances to the parent's object, and the range of each node's children
    (nodes of the level below, or entries)."""

    routing: np.ndarray
    radius: np.ndarray
    parent: np.ndarray
    low: np.ndarray
    high: np.ndarray


@dataclass
class MTree:
    """Levels from the leaf pages up to the root, and the entries in page order."""

    levels: list[Level]
    vectors: np.ndarray
    gap: np.ndarray
    ids: list[np.ndarray]
    longest: float

    @classmethod
    def build(cls, vectors: np.ndarray, ids: list[np.ndarray], longest: float, page: int = PAGE) -> MTree:
        """Bulk load: pages of near entries, then pages of near pages, up to one root."""
        points = lift(vectors, longest)
        reach = np.zeros(len(points))  # covering radius of what each point stands for
        levels: list[Level] = []
        while True:
            pages = _paged(points, page)
            order = np.concatenate(pages)
            high = np.cumsum([len(p) for p in pages])
            low = high - [len(p) for p in pages]
            centres = [own[np.argmin(gaps(points[own], points[own].mean(axis=0)))] for own in pages]
            away = np.concatenate([gaps(points[own], points[c]) for own, c in zip(pages, centres)])
            if levels:
                below = levels[-1]
                levels[-1] = Level(below.routing[order], below.radius[order], away, below.low[order], below.high[order])
            else:
                vectors, ids, gap = vectors[order], [ids[i] for i in order], away
            radius = np.array([(away[a:b] + reach[order[a:b]]).max() for a, b in zip(low, high)])
            points, reach = points[centres], radius
            levels.append(Level(points, radius, np.zeros(len(pages)), low, high))
            if len(pages) == 1:
                return cls(levels, vectors, gap, ids, longest)

    def search(self, query: np.ndarray, query_id: int, k: int, least: int | None = None) -> list[tuple[int, int]]:
        """The best ``k`` pairs (score, id), or fewer where ``least`` (a score) rules out the rest; the query's own row is left out."""
        flat = np.append(query.astype(np.float64), 0.0)
        own = float(flat @ flat)
        slack = 4e-7 * np.sqrt(len(flat)) * (np.sqrt(own) + np.sqrt(self.longest))
        reach = lambda score: np.sqrt(max(0.0, own + self.longest - 2.0 * float(score))) + slack
        best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst in front
        limit = np.inf if least is None else reach(least)
        root = self.levels[-1]
        far = self._far(root.routing, flat, own)
        queue = [(float(far[0] - root.radius[0]), len(self.levels) - 1, 0, float(far[0]))]
        while queue and queue[0][0] <= limit:
            _, level, node, away = heapq.heappop(queue)
            a, b = self.levels[level].low[node], self.levels[level].high[node]
            if level:
                below = self.levels[level - 1]
                at = a + np.flatnonzero(np.abs(away - below.parent[a:b]) - below.radius[a:b] <= limit)
                far = self._far(below.routing[at], flat, own)
                bound = far - below.radius[at]
                for i in np.flatnonzero(bound <= limit).tolist():
                    heapq.heappush(queue, (float(bound[i]), level - 1, int(at[i]), float(far[i])))
                continue
            at = a + np.flatnonzero(np.abs(away - self.gap[a:b]) <= limit)
            score = products(self.vectors[at], query)
            if len(best) == k:
                some = score >= best[0][0]
                at, score = at[some], score[some]
            for i in np.argsort(-score, kind="stable").tolist():
                if len(best) == k and score[i] < best[0][0]:
                    break
                self._offer(best, k, int(score[i]), at[i], query, query_id)
            if len(best) == k:
                limit = min(limit, reach(best[0][0]))
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))

    def _far(self, routing: np.ndarray, flat: np.ndarray, own: float) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, own + self.longest - 2.0 * (routing @ flat)))

    def _offer(self, best: list[tuple[int, int]], k: int, score: int, entry: int, query: np.ndarray, query_id: int) -> None:
        mine = self.ids[entry].tolist()
        if query_id in mine and np.array_equal(self.vectors[entry], query):
            mine.remove(query_id)
        for i in mine:
            if len(best) < k:
                heapq.heappush(best, (score, -i))
            elif (score, -i) > best[0]:
                heapq.heapreplace(best, (score, -i))
            else:
                break


# --- pages as rows -------------------------------------------------------------------

PAGES = ("shard long, level int, page long, low long, high long, radius double, parent double, routing binary, "
         "vectors binary, gap binary, ids binary, counts binary")


def page_rows(shard: int, tree: MTree) -> list[tuple]:
    """One row a node; leaf pages hold their entries."""
    rows = []
    for number, level in enumerate(tree.levels):
        for i in range(len(level.radius)):
            a, b = int(level.low[i]), int(level.high[i])
            held = [b"", b"", b"", b""]
            if not number:
                held = [tree.vectors[a:b].tobytes(), tree.gap[a:b].tobytes(), np.concatenate(tree.ids[a:b]).tobytes(),
                        np.array([len(x) for x in tree.ids[a:b]], np.int64).tobytes()]
            rows.append((shard, number, i, a, b, float(level.radius[i]), float(level.parent[i]), level.routing[i].tobytes(), *held))
    return rows


def tree_of(rows: list[tuple], dim: int, longest: float) -> MTree:
    """The tree of all rows of a shard, as ``page_rows`` made them, in the order of level and page."""
    levels = []
    for number in sorted({r[1] for r in rows}):
        own = [r for r in rows if r[1] == number]
        levels.append(Level(np.frombuffer(b"".join(r[7] for r in own), np.float64).reshape(-1, dim + 1), np.array([r[5] for r in own]),
                            np.array([r[6] for r in own]), np.array([r[3] for r in own]), np.array([r[4] for r in own])))
    leaves = sorted((r for r in rows if not r[1]), key=lambda r: r[3])  # in the order of their entries
    whole = [np.frombuffer(b"".join(r[c] for r in leaves), kind) for c, kind in ((8, np.int64), (9, np.float64), (10, np.int64), (11, np.int64))]
    return MTree(levels, whole[0].reshape(len(whole[1]), dim), whole[1], np.split(whole[2], np.cumsum(whole[3])[:-1]), longest)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten(), np.int64).reshape(len(col), dim)


# --- the job -----------------------------------------------------------------------------

@dataclass
class Index:
    """Trees as pages, and what routes queries to them: the pivots (lifted), the radius of each one's cell, and each cell's shards."""

    pages: DataFrame
    pivots: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    shards: np.ndarray
    dim: int
    longest: float


def quantised(embedding: Column) -> Column:
    """``floor(1024 * x)`` of each component; null for vectors that are null or hold a null or non-finite component."""
    ok = F.forall(embedding, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    clipped = lambda x: F.least(F.greatest(x.cast("double") * 1024, F.lit(float(-CLIP))), F.lit(float(CLIP)))
    return F.when(ok, F.transform(embedding, lambda x: F.floor(clipped(x)).cast("bigint")))


def build_index(rows: DataFrame, k: int, dim: int, longest: float, shard_rows: int = SHARD_ROWS, page: int = PAGE) -> Index:
    """Index of ``rows(id, vec)``; vectors of ``dim`` integers, none longer than ``sqrt(longest)``."""
    place = Window.partitionBy("vec").orderBy("id")
    classes = durable(rows.select("id", "vec").withColumn("n", F.row_number().over(place)).where(F.col("n") <= k + 1)
                      .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")), "classes")
    wanted = min(MOST_PIVOTS, -(-classes.count() // shard_rows))
    sample = classes.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(wanted).collect()  # at most MOST_PIVOTS
    pivots = lift(np.array([r["vec"] for r in sample], np.int64).reshape(len(sample), dim), longest)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = lift(_matrix(batch.column("vec"), dim), longest)
            far = np.stack([gaps(points, p) for p in pivots])
            cell = far.argmin(axis=0)
            yield pa.RecordBatch.from_arrays([batch.column("vec"), batch.column("ids"), pa.array(cell, pa.int64()),
                                              pa.array(far[cell, np.arange(len(cell))])], names=["vec", "ids", "cell", "away"])

    dealt = durable(classes.mapInArrow(deal, "vec array<long>, ids array<long>, cell long, away double"), "cells")
    size, radius = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for r in dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect():  # a row per pivot
        size[r["cell"]], radius[r["cell"]] = r["n"], r["radius"]
    shards = -(-size // shard_rows)
    first = np.cumsum(shards) - shards

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, vectors, ids = None, [], []

        def pages() -> pa.RecordBatch:
            made = page_rows(shard, MTree.build(np.concatenate(vectors), [i for x in ids for i in x], longest, page))
            return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in made], schema=schema)

        for batch in batches:
            own = np.asarray(batch.column("shard"))
            for part in np.split(np.arange(len(own)), np.flatnonzero(np.diff(own)) + 1) if len(own) else []:
                if own[part[0]] != shard:
                    if vectors:
                        yield pages()
                    shard, vectors, ids = int(own[part[0]]), [], []
                rows = batch.slice(int(part[0]), len(part))
                vectors.append(_matrix(rows.column("vec"), dim))
                ids.append([np.array(x, np.int64) for x in rows.column("ids").to_pylist()])
        if vectors:
            yield pages()

    names = [c.split()[0] for c in PAGES.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in PAGES.split(", ")])
    at = F.lit(first.tolist())[F.col("cell").cast("int")], F.lit(shards.tolist())[F.col("cell").cast("int")]
    sharded = dealt.select((at[0] + F.pmod(F.xxhash64("vec"), at[1])).cast("long").alias("shard"), "vec", "ids") if len(pivots) else \
        dealt.select(F.lit(0).cast("long").alias("shard"), "vec", "ids")
    pages = durable(sharded.repartition("shard").sortWithinPartitions("shard").mapInArrow(trees, PAGES), "pages")
    return Index(pages, pivots, radius, first, shards, dim, longest)


def _routes(index: Index, every: bool):
    """Arrow function from queries ``(row, id, vec, least, done)`` to ``(row, id, vec, least, low, high)``: the ranges of shards to search,
    of the nearest pivot's first shard or of all cells that may hold a score of ``least``."""
    dim, longest, pivots, radius, first, shards = index.dim, index.longest, index.pivots, index.radius, index.first, index.shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 1024):
                part = batch.slice(k, min(1024, len(batch) - k))
                flat = np.column_stack([_matrix(part.column("vec"), dim).astype(np.float64), np.zeros(len(part))])
                own = (flat * flat).sum(axis=1)[:, None]
                far = np.sqrt(np.maximum(0.0, own + longest - 2.0 * flat @ pivots.T))
                if every:
                    least = np.array([-np.inf if x is None else float(x) for x in part.column("least").to_pylist()])[:, None]
                    slack = 8e-7 * np.sqrt(dim + 1) * (np.sqrt(own) + np.sqrt(longest))
                    row, cell = np.nonzero(far - radius <= np.sqrt(np.maximum(0.0, own + longest - 2.0 * least)) + slack)
                    low, high = first[cell], first[cell] + shards[cell] - 1
                else:
                    row = np.arange(len(part))
                    low = high = first[far.argmin(axis=1)]
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("row").take(at), part.column("id").take(at), part.column("vec").take(at),
                                                  part.column("least").take(at), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
                                                 names=["row", "id", "vec", "least", "low", "high"])
    return run


def _searched(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """``row, id, vec_id, score``: the best ``k`` of each (query, shard) pair of ``queries(row, id, vec, least, shard)``."""
    dim, longest = index.dim, index.longest
    slices = queries.groupBy("shard").agg(F.ceil(F.count("*") / SLICE_QUERIES).alias("slices"))
    asked = queries.join(slices, "shard").withColumn("slice", F.pmod(F.xxhash64("row"), F.col("slices")))
    copies = index.pages.join(slices, "shard").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    both = copies.drop("slices").withColumn("kind", F.lit(0)).unionByName(
        asked.select("shard", "slice", F.lit(1).alias("kind"), "row", "id", "vec", "least"), allowMissingColumns=True)
    names = [c.split()[0] for c in PAGES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, tree = None, [], None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if (r["shard"], r["slice"]) != key:
                    key, rows, tree = (r["shard"], r["slice"]), [], None
                if r["kind"] == 0:
                    rows.append(tuple(r[c] for c in names))
                    continue
                if tree is None:
                    tree, rows = tree_of(rows, dim, longest), []
                out += [(r["row"], r["id"], i, s) for s, i in tree.search(np.array(r["vec"], np.int64), r["id"], k, r["least"])]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out) if out else [[]] * 4)], names=["row", "id", "vec_id", "score"])

    return both.repartition("shard", "slice").sortWithinPartitions("shard", "slice", "kind", "level", "page").mapInArrow(
        run, "row long, id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "vec",
          shard_rows: int = SHARD_ROWS, page: int = PAGE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest products with every row that ``is_query`` selects, ties to the smaller id.

    ``vec_col`` holds lists of integers, null for rows that take no part.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    dim = rows.agg(F.max(F.size("vec"))).head()[0]
    if dim is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    filled = F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("vec")))
    rows = durable(rows.select("id", filled.alias("vec"), "asks", F.monotonically_increasing_id().alias("row")), "vectors")
    square = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    longest = float(rows.agg(F.max(square)).head()[0])
    index = build_index(rows, k, dim, longest, shard_rows, page)

    kind = "row long, id long, vec array<long>, least long, low long, high long"
    queries = rows.where("asks").select("row", "id", "vec", F.lit(None).cast("long").alias("least"))
    near = durable(queries.mapInArrow(_routes(index, False), kind), "near").withColumnRenamed("low", "shard")
    start = durable(_searched(index, near.drop("high"), k), "start")
    least = _best(start, k).where(F.col("rank") == k).select("row", F.col("score").alias("least"))
    bounded = near.select("row", "id", "vec", F.col("shard").alias("seen")).join(least, "row", "left")
    rest = (bounded.select("row", "id", "vec", "least").mapInArrow(_routes(index, True), kind)
            .withColumn("shard", F.explode(F.sequence("low", "high"))).drop("low", "high")
            .join(bounded.select("row", "seen"), "row").where("shard <> seen").drop("seen"))
    found = _best(start.unionByName(_searched(index, durable(rest, "rest"), k)), k)
    return found.select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
