"""Exact top-k search by inner product with cover trees over queries and data.

All rows, queries among them, are dealt to cells around pivots of a bounded sample, the top
of the tree; a cell of many rows is cut into blocks. A task builds the cover tree of a block
and then takes the queries, in order of their cells, some hundred at a time, each lot as a
cover tree of its own. Pairs of nodes are visited from the best bound down. With centres c, d
and covering radii r, s no inner product below them exceeds <c,d> + r|d| + s|c| + rs; a pair
is left if that is below the worst k-th score of the queries in it. Scores start from the
sample, so that pruning begins with the first pair: a query is sent only to the blocks of
cells whose pivot and radius leave room for a better score than its own k-th one there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import BATCH_ROWS, map_batches, staged

NEIGHBOURS = 5
SCALE = 256
EVERY = 50
# The sample that pivots and first scores come from: rows by hash order.
SAMPLE = 4096
PIVOTS = 64
# Rows of a block, whose tree a task holds.
BLOCK = 1 << 16
CHILDREN = 16
LEAF = 64
# Float sums of integers are exact below this.
EXACT = float(1 << 53)
NEVER = -(1 << 62)


@dataclass
class Node:
    """Rows below a centre, all within the radius; the first child has the same centre."""

    rows: np.ndarray
    centre: np.ndarray
    radius: float
    children: list[Node] = field(default_factory=list)


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None, centre: int | None = None) -> Node:
    """Centres of children are chosen farthest first, so they lie at least as far apart as
    the radius that they leave."""
    rows = np.arange(len(points)) if rows is None else rows
    centre = int(rows[0]) if centre is None else centre
    away = _distances(points[rows], points[centre])
    node = Node(rows, points[centre], float(away.max()))
    if len(rows) <= LEAF or node.radius == 0:
        return node
    chosen, owner = [centre], np.zeros(len(rows), np.int64)
    while len(chosen) < CHILDREN and away.max() > node.radius / 2:
        far = int(rows[away.argmax()])
        closer = _distances(points[rows], points[far])
        owner[closer < away] = len(chosen)
        away = np.minimum(away, closer)
        chosen.append(far)
    if len(chosen) == 1:
        return node
    parts = [rows[owner == i] for i in range(len(chosen))]
    node.children = [cover_tree(points, part, c) for part, c in zip(parts, chosen) if len(part)]
    return node


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def _bound(query: Node, data: Node) -> float:
    size_q, size_d = np.linalg.norm(query.centre), np.linalg.norm(data.centre)
    found = query.centre @ data.centre + query.radius * size_d + data.radius * size_q + query.radius * data.radius
    return float(found) + 1e-9 * (size_q + query.radius) * (size_d + data.radius) + 1e-6


class Search:
    """The best rows of each query so far."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, seeds: np.ndarray, k: int):
        self.queries, self.ids, self.k = queries, ids, k
        self.worst = seeds.astype(np.float64)  # no k-th score ends below its seed
        # Negative score, id, number of equal rows.
        self.best: list[list[tuple[int, int, int]]] = [[] for _ in ids]

    def visit(self, query: Node, data: Node, points: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        tie = count()
        waiting = [(-_bound(query, data), next(tie), query, data)]
        while waiting:
            negative, _, q, d = heapq.heappop(waiting)
            if -negative < self.worst[q.rows].min():
                continue
            if not q.children and not d.children:
                self._compare(q.rows, points[d.rows], ids[d.rows], counts[d.rows])
                continue
            # Open the wider of the two.
            if d.children and (not q.children or d.radius >= q.radius):
                pairs = [(q, child) for child in d.children]
            else:
                pairs = [(child, d) for child in q.children]
            for a, b in pairs:
                bound = _bound(a, b)
                if bound >= self.worst[a.rows].min():
                    heapq.heappush(waiting, (-bound, next(tie), a, b))

    def _compare(self, rows: np.ndarray, points: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        scores = _products(self.queries[rows], points)
        hopeful = (scores >= self.worst[rows][:, None]) & (self.ids[rows][:, None] != ids[None, :])
        for i in np.flatnonzero(hopeful.any(axis=1)):
            row, which = int(rows[i]), np.flatnonzero(hopeful[i])
            found = [(-int(scores[i, j]), int(ids[j]), int(counts[j])) for j in which]
            self.best[row] = heapq.nsmallest(self.k, self.best[row] + found)
            if len(self.best[row]) == self.k:
                self.worst[row] = max(self.worst[row], -self.best[row][-1][0])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integers, exact: by floats while they are."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < EXACT:
        return a @ b.T
    return a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T


def _by_size(vectors: list[list[int]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    sizes = np.array([len(v) for v in vectors])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield int(size), at, np.array([vectors[i] for i in at], np.float64)


def _pivots(sample: list[list[int]]) -> dict[int, np.ndarray]:
    """Far-apart rows of the sample for each vector length."""
    found: dict[int, np.ndarray] = {}
    for size, _, points in _by_size(sample):
        chosen = [0]
        away = _distances(points, points[0])
        while len(chosen) < PIVOTS and away.max() > 0:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, _distances(points, points[chosen[-1]]))
        found[size] = points[chosen]
    return found


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("e"))
    odd = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    part = rows.filter(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & ~F.coalesce(odd, F.lit(True)))
    floors = F.transform("e", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return part.select("vec_id", floors.alias("v"))


def top_k(points: DataFrame, every: int = EVERY, k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score) from (vec_id, v): the ``k`` highest inner products of
    every row whose id is divisible by ``every`` with the other rows, ties to the smaller id.

    Fewer rows give fewer answers, an empty table none. Rows that share the query's id are
    its own; a query that is repeated is answered once. Other repeated rows are candidates
    of their own and take a rank each: equal rows are searched once and counted. Vectors of
    another length are no candidates of a query.
    """
    spark = points.sparkSession
    # No more than k equal rows can rank.
    counted = points.groupBy("vec_id", "v").agg(F.least(F.count("*"), F.lit(k)).alias("n"))
    points = staged(counted, "topk-points")
    sample = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    spread = spark.sparkContext.broadcast(_pivots([row.v for row in sample]))  # at most SAMPLE rows
    first = spark.sparkContext.broadcast(([row.vec_id for row in sample], [row.v for row in sample]))

    def begin() -> object:
        ids, vectors = first.value
        known = {size: (np.array(ids)[at], values) for size, at, values in _by_size(vectors)}

        def batch(vec_ids: list[int], vs: list[list[int]], ns: list[int]) -> Iterator[tuple]:
            for size, at, values in _by_size(vs):
                cells, away = np.full(len(at), PIVOTS), np.zeros(len(at))
                seeds = np.full(len(at), float(NEVER))
                if size in spread.value:
                    far = [_distances(spread.value[size], v) for v in values]
                    cells, away = np.array([d.argmin() for d in far]), np.array([d.min() for d in far])
                    own = np.array([vec_ids[i] for i in at])
                    asked = np.flatnonzero(own % every == 0)
                    others, there = known[size]
                    scores = np.asarray(_products(values[asked], there), np.float64)
                    scores[own[asked][:, None] == others[None, :]] = NEVER
                    if scores.shape[1] >= k and len(asked):
                        seeds[asked] = np.partition(scores, -k, axis=1)[:, -k]
                for i, cell, seed, distance in zip(at, cells.tolist(), seeds.tolist(), away.tolist()):
                    yield vec_ids[i], vs[i], ns[i], cell, distance, int(seed)

        return batch

    schema = "vec_id long, v array<bigint>, n long, cell int, away double, seed long"
    dealt = staged(map_batches(points, ["vec_id", "v", "n"], schema, begin), "topk-cells")
    # At most PIVOTS + 1 cells for each of a few vector lengths.
    cells = {
        (row["size"], row.cell): (row["count"], row.radius)
        for row in dealt.groupBy(F.size("v").alias("size"), "cell").agg(F.count("*").alias("count"), F.max("away").alias("radius")).collect()
    }
    counts = [sum(count for (_, c), (count, _) in cells.items() if c == cell) for cell in range(PIVOTS + 1)]
    blocks = [-(-count // BLOCK) for count in counts]
    starts = np.cumsum([0, *blocks]).tolist()
    at = F.col("cell") + 1
    block = F.element_at(F.array(*map(F.lit, starts)), at) + F.pmod(
        F.xxhash64("vec_id"), F.greatest(F.element_at(F.array(*map(F.lit, blocks)), at), F.lit(1))
    )
    data = dealt.select(block.cast("int").alias("block"), F.lit(0).alias("kind"), "cell", "vec_id", "v", "n", "seed")

    def begin_queries() -> object:
        def batch(vec_ids: list[int], vs: list[list[int]], own_cells: list[int], seeds: list[int]) -> Iterator[tuple]:
            for size, at, values in _by_size(vs):
                hopeful = hopeful_cells(values, np.array([seeds[i] for i in at]), spread.value.get(size), size, cells)
                for i, chosen in zip(at, hopeful):
                    for cell in np.flatnonzero(chosen).tolist():
                        for number in range(starts[cell], starts[cell + 1]):
                            yield number, 1, own_cells[i], vec_ids[i], vs[i], 1, seeds[i]

        return batch

    queries = map_batches(
        dealt.filter(F.col("vec_id") % every == 0), ["vec_id", "v", "cell", "seed"],
        "block int, kind int, cell int, vec_id long, v array<bigint>, n long, seed long", begin_queries,
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    together = data.unionByName(queries).repartition("block").sortWithinPartitions("block", "kind", "cell", "vec_id")
    found = together.mapInArrow(_search(k), "query_id long, vec_id long, score long, n long")
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        each.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def hopeful_cells(
    queries: np.ndarray, seeds: np.ndarray, pivots: np.ndarray | None, size: int, cells: dict[tuple[int, int], tuple[int, float]]
) -> np.ndarray:
    """For each query the cells that hold vectors of its length and may hold one that scores
    as its seed or better: no product in a cell exceeds that with its pivot by more than the
    cell's radius times the query's length."""
    there = np.array([(size, cell) in cells for cell in range(PIVOTS + 1)])
    if pivots is None:
        return np.tile(there, (len(queries), 1))
    lengths = np.linalg.norm(queries, axis=1)
    radius = np.array([cells.get((size, cell), (0, 0.0))[1] for cell in range(len(pivots))])
    reach = np.linalg.norm(pivots, axis=1) + radius
    bounds = queries @ pivots.T + np.outer(lengths, radius) + 1e-9 * np.outer(lengths, reach) + 1e-6
    chosen = np.tile(there, (len(queries), 1))
    chosen[:, : len(pivots)] &= bounds >= seeds[:, None]
    return chosen


def _search(k: int) -> object:
    target = pa.schema([(name, pa.int64()) for name in ("query_id", "vec_id", "score", "n")])

    def answers(trees: dict, ids: list[int], vectors: list[list[int]], seeds: list[int]) -> Iterator[tuple]:
        for size, at, values in _by_size(vectors):
            if size not in trees:
                continue
            tree, points, point_ids, counts = trees[size]
            own = np.array([ids[i] for i in at])
            search = Search(values, own, np.array([seeds[i] for i in at]), k)
            search.visit(cover_tree(values), tree, points, point_ids, counts)
            for query, best in zip(own.tolist(), search.best):
                for negative, vec_id, n in best:
                    yield query, vec_id, -negative, n

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by block, the data of a block before its queries.
        block, held_ids, held, ns, trees = None, [], [], [], None
        for batch in batches:
            rows = batch.to_pydict()
            places = np.column_stack((rows["block"], rows["kind"]))
            cuts = [0, *(np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1).tolist(), len(places)]
            for a, b in zip(cuts, cuts[1:]):
                if rows["block"][a] != block:
                    block, held_ids, held, ns, trees = rows["block"][a], [], [], [], None
                if rows["kind"][a] == 0:
                    held_ids += rows["vec_id"][a:b]
                    held += rows["v"][a:b]
                    ns += rows["n"][a:b]
                    continue
                if trees is None:
                    trees = {
                        size: (cover_tree(points), points, np.array([held_ids[i] for i in at]), np.array([ns[i] for i in at]))
                        for size, at, points in (_by_size(held) if held else ())
                    }
                    held_ids, held, ns = [], [], []
                found = list(answers(trees, rows["vec_id"][a:b], rows["v"][a:b], rows["seed"][a:b]))
                columns = zip(*found) if found else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=target)

    return work
